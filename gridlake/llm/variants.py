"""Spelling variants: words at one edit from a much more frequent word.

Two words are near if one inserted, deleted or replaced code point turns
one into the other.  Near words are found with a bit-sliced position
index: for a block of words, one bitset for each (position, letter) tells
which of them have that letter there.  Going through the letters of a
query, word-parallel recurrences keep the set of block words that agree so
far (zero errors) and three sets that agree but for one error: a letter
replaced (same positions), one more (positions shifted by one), one less
(shifted back).  Many queries advance together, as rows of one array.

Words meet in buckets.  One edit leaves the first or the last half of the
shorter word as it is, so near words share a bucket named by that half;
a pair that shares both halves counts in the bucket of the first, which
the zero-error set at that position tells.  Lengths of a pair differ by at
most one: a word is in the buckets of its own half length and of the half
length of the next shorter word.

Scale: a text gives its word counts, combined per task before the shuffle;
the vocabulary, not the texts, is bucketed.  Small buckets are answered
many at a time; a bucket of more than ``PIECE`` words is cut into pieces
that meet each other, so no task holds a bucket whole.  What leaves a task
is a count and a best candidate for each query, never pairs.  Roots follow
from pointer doubling: a form is at least twice as frequent as its word,
so chains have at most log2(most frequent count) links.

Edge cases: null and empty texts have no words; a null id is the empty
text in the hash of ``drop_one_in``; repeated rows count each time; ties
between forms go to the smaller word in code-point order; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.staging import stage

#: ASCII letters (lower-cased) and U+00C0 to U+00FF, as UTF-8 bytes.
LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
MIN_LETTERS = 5
MIN_COUNT = 3
PIECE = 4096            # words of a bucket that are indexed together
BLOCK_LETTERS = 1 << 16
HELD = 1 << 17          # distinct words that a task counts before it passes them on
FACTOR = 2


def text_words(text: str | None, ident, drop_one_in: int, min_letters: int) -> Counter:
    """Counts of the words of one text.  ``drop_one_in`` (0: never) makes
    misspellings: where it divides h, the crc32 of ``<id>:<word>``, the word
    loses its letter h % length."""
    counts = Counter(LETTERS.findall((text or "").encode().lower()))      # bytes: only A-Z change
    out: Counter = Counter()
    seed = zlib.crc32(f"{'' if ident is None else ident}:".encode())
    for word, n in counts.items():
        if len(word) < min_letters:
            continue
        if drop_one_in:
            h = zlib.crc32(word, seed)
            if h % drop_one_in == 0:
                letters = word.decode()
                at = h % len(letters)
                word = (letters[:at] + letters[at + 1:]).encode()
        out[word] += n
    return out


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS,
                min_count: int = MIN_COUNT, drop_one_in: int = 0) -> DataFrame:
    """(word, n) of the words of at least ``min_letters`` code points that
    occur at least ``min_count`` times."""
    def over(batches):
        held: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([w.decode() for w in held], pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in text_words(text.as_py(), ident, drop_one_in, min_letters).items():
                    held[word] += n
                if len(held) > HELD:
                    yield flush()
        yield flush()

    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counted = texts.mapInArrow(over, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter((F.col("n") >= min_count) & (F.char_length("word") >= min_letters))


class PositionIndex:
    """Bitsets over a block of words: ``at(position, letters)`` gives, for
    each letter, the words that have it at the position."""

    def __init__(self, letters: list[np.ndarray]):
        self.n = len(letters)
        self.width = -(-self.n // 64)
        self.lengths = np.array([len(x) for x in letters], dtype=np.int64)
        place = np.concatenate([np.arange(len(x)) for x in letters]).astype(np.int64)
        word = np.repeat(np.arange(self.n), self.lengths)
        self.codes, row = np.unique((place << 21) | np.concatenate(letters).astype(np.int64), return_inverse=True)
        # the last row is empty: the answer for a letter that no word has there
        self.sets = np.zeros((len(self.codes) + 1, self.width), dtype=np.uint64)
        bit = np.uint64(1) << (word & 63).astype(np.uint64)
        np.bitwise_or.at(self.sets, (row, word >> 6), bit)

    def at(self, position: int, letters: np.ndarray) -> np.ndarray:
        if position < 0:
            return np.zeros((len(letters), self.width), dtype=np.uint64)
        code = (np.int64(position) << 21) | letters.astype(np.int64)
        row = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return self.sets[np.where(self.codes[row] == code, row, len(self.codes))]

    def of_length(self, length: int) -> np.ndarray:
        return packed(self.lengths == length)


def packed(flags: np.ndarray) -> np.ndarray:
    """A row of booleans as 64-bit words, bit i of the row at bit i % 64 of word i // 64."""
    bits = np.packbits(flags, bitorder="little")
    out = np.zeros(-(-len(flags) // 64) * 8, dtype=np.uint8)
    out[:len(bits)] = bits
    return out.view("<u8")


def one_edit(index: PositionIndex, queries: np.ndarray, half: int | None = None, drop_first_half: bool = False) -> np.ndarray:
    """Bitsets (one row a query) of the words one edit from each query;
    ``queries``: letters, one row a query of the same length m.

    ``half``: only pairs whose shorter word has this half length;
    ``drop_first_half``: of these, not the ones that agree in the first half.
    """
    rows, m = queries.shape
    every = np.broadcast_to(packed(np.ones(index.n, dtype=bool)), (rows, index.width))
    same = every.copy()
    swap = np.zeros_like(same)          # one letter replaced
    more = same.copy()                  # the word has one more: positions shifted by one
    less = np.zeros_like(same)          # the word has one less: shifted back
    prefix = {0: every}
    for i in range(m):
        letter = queries[:, i]
        here = index.at(i, letter)
        less &= index.at(i - 1, letter)
        less |= same                    # letter i of the query is the one too many
        swap &= here
        swap |= same                    # or it is replaced
        same &= here
        more &= index.at(i + 1, letter)
        more |= same                    # or the word's extra letter follows it
        if i + 1 in (m // 2, (m - 1) // 2):
            prefix[i + 1] = same.copy()
    swap &= ~(same & index.of_length(m))            # the query itself
    out = np.zeros_like(same)
    for found, length in ((swap, m), (more, m + 1), (less, m - 1)):
        h = min(m, length) // 2
        if half is not None and h != half:
            continue
        found = found & index.of_length(length)
        if drop_first_half:
            found &= ~prefix[h]
        out |= found
    return out


def letters_of(words: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(w.encode("utf-32-le"), dtype="<u4") for w in words]


def answer(words: list[str], counts: np.ndarray, bucket: np.ndarray, half: np.ndarray, last: np.ndarray,
           asks: np.ndarray, holds: np.ndarray):
    """(word, near, best count, best word) of the asking rows of a block.

    Rows belong to buckets (consecutive numbers); ``asks`` marks queries,
    ``holds`` rows of the index; ``last`` buckets of the last half.
    """
    letters = letters_of(words)
    held = np.flatnonzero(holds)
    if not len(held):
        return
    # best candidates first: the first bit of a row is its form
    held = np.array(sorted(held.tolist(), key=lambda i: (-counts[i], letters[i].tolist())))
    index = PositionIndex([letters[i] for i in held])
    lengths = np.array([len(x) for x in letters])
    where = bucket[held]
    buckets, number = np.unique(where, return_inverse=True)
    mine = np.stack([packed(number == b) for b in range(len(buckets))])
    asking = np.flatnonzero(asks)
    groups = np.lexsort((last[asking], half[asking], lengths[asking]))
    asking = asking[groups]
    cut = np.flatnonzero((np.diff(lengths[asking]) != 0) | (np.diff(half[asking]) != 0) | (np.diff(last[asking].astype(int)) != 0)) + 1
    step = max(1, (1 << 17) // index.width)
    for part in np.split(asking, cut):
        for a in range(0, len(part), step):
            rows = part[a:a + step]
            place = np.minimum(np.searchsorted(buckets, bucket[rows]), len(buckets) - 1)
            found = one_edit(index, np.stack([letters[i] for i in rows]), int(half[rows[0]]), bool(last[rows[0]]))
            found &= np.where((buckets[place] == bucket[rows])[:, None], mine[place], np.uint64(0))
            near = np.bitwise_count(found).sum(axis=1, dtype=np.int64)
            for r in np.flatnonzero(near).tolist():
                word = int(np.flatnonzero(found[r])[0])
                bits = int(found[r, word])
                best = held[64 * word + (bits & -bits).bit_length() - 1]
                yield words[rows[r]], int(near[r]), int(counts[best]), words[best]


def near_words(vocabulary: DataFrame, piece: int = PIECE) -> DataFrame:
    """(word, n_near, best_n, best) of the words of the staged ``vocabulary``
    (word, n) that have near words: how many, and the most frequent one."""
    size = F.char_length("word")
    own, shorter = F.expr("cast(char_length(word) div 2 as int)"), F.expr("cast((char_length(word) - 1) div 2 as int)")
    placed = vocabulary.withColumn("half", F.explode(F.array_distinct(F.array(own, shorter)))) \
        .withColumn("last", F.explode(F.array(F.lit(False), F.lit(True)))) \
        .withColumn("affix", F.when(F.col("last"), F.substring("word", size - F.col("half") + 1, F.col("half")))
                    .otherwise(F.substring("word", F.lit(1), F.col("half"))))
    names = ["half", "last", "affix"]
    sizes = stage(placed.groupBy(*names).agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "variant-buckets")
    met = placed.join(sizes, names)
    parts = F.expr(f"cast((size + {piece - 1}) div {piece} as int)")
    mine = F.pmod(F.xxhash64("word"), parts).cast("int")
    every = F.sequence(F.lit(0), parts - 1)
    small = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(True).alias("asks"), F.lit(True).alias("holds")))
    asked = F.transform(every, lambda j: F.struct(mine.alias("i"), j.alias("j"), F.lit(True).alias("asks"),
                                                  F.lit(False).alias("holds")))
    kept = F.transform(every, lambda i: F.struct(i.alias("i"), mine.alias("j"), F.lit(False).alias("asks"),
                                                 F.lit(True).alias("holds")))
    rows = met.select(*names, "word", "n", F.inline(F.when(F.col("size") <= piece, small).otherwise(F.concat(asked, kept))))
    keys = [*names, "i", "j"]

    def over(batches):
        held, letters = [], 0
        schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

        def flush(items):
            bucket = np.cumsum([0] + [x[:5] != y[:5] for x, y in zip(items, items[1:])])
            found = list(answer([x[5] for x in items], np.array([x[6] for x in items], dtype=np.int64), bucket,
                                np.array([x[0] for x in items]), np.array([x[1] for x in items], dtype=bool),
                                np.array([x[7] for x in items], dtype=bool), np.array([x[8] for x in items], dtype=bool)))
            columns = list(zip(*found)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        def many():
            return len(held) > piece // 2 or letters > BLOCK_LETTERS

        for batch in batches:
            for item in zip(*[c.to_pylist() for c in batch.columns]):
                if held and many() and held[-1][:5] != item[:5]:          # only whole buckets or pieces
                    yield flush(held)
                    held, letters = [], 0
                held.append(item)
                letters += len(item[5])
        if held:
            yield flush(held)

    answers = rows.select("half", "last", "affix", "i", "j", "word", "n", "asks", "holds").repartition(*keys) \
        .sortWithinPartitions(*keys).mapInArrow(over, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return answers.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")) \
        .select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(word, root) of the staged (word, form) links: the end of each chain."""
    now = stage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    for _ in range(max_rounds):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stage(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "variant-roots")
        now = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return now
    raise RuntimeError("forms make a circle")


def variant_groups(vocabulary: DataFrame, factor: int = FACTOR, piece: int = PIECE) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of ``vocabulary``
    (word, n): its most frequent near word, where that is at least
    ``factor`` (two or more) times as frequent, and the end of the chain of forms."""
    if factor < 2:
        raise ValueError("forms must be at least twice as frequent")
    words = stage(vocabulary.select("word", "n"), "variant-words")
    found = words.join(near_words(words, piece), "word", "left")
    has = F.col("best_n") >= factor * F.col("n")
    formed = stage(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")),
                   "variant-forms")
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
