"""Interpolated modified Kneser-Ney model of order 2 or 3, counted in Spark.

    P(w | u) = (c(uw) - D(c(uw))) / c(u) + gamma(u) P(w)
    P(w)     = (k(w) - D'(k(w))) / k + gamma' / (V + 1)

with k(w) the number of distinct words before w, three discounts per level
from the counts of counts, and one unit of the uniform share for unknown
words.  A text is its words (A-Z as a-z) and an end token; the first word's
context is a begin token.

At order 3 the same formula stands above, over c(tuw); the level below then
uses k(uw), the number of distinct words before uw, in place of c(uw), and
the first word's context is two begin tokens.

Counting: tasks combine the bigrams of a few million words and send them,
packed, to shards by hash; each shard is merged by one task, written as a
sorted hash array below the shared folder, and passes on what each word
needs (followers seen once, twice, more; distinct predecessors).  Word
shards are made the same way.  Nothing but the list of files and the
counts of counts comes to the driver.  The number of shards follows the
bytes of the training texts (``SHARD_BYTES`` of text a shard at most), so
what one task merges is bounded at any size and with any number of shuffle
partitions; a frequent word's bigrams are spread over all shards.

Scoring: workers memory-map the arrays (a file system without mapping is
copied to a temporary file that is unlinked at once) and look up the
sorted distinct words and bigrams of each batch.

Words are named by 64-bit hashes, in bigrams by the first 48 bits of them:
of V words about V^2 / 2^49 pairs share a name there (0.002 at a million
words, 18 at a hundred million).  Counts are whole numbers, stored in the
narrowest float that holds them exactly.

Edge cases: null and empty texts are the end token alone; without training
texts every score is that of the uniform distribution; null ids and
repeated rows are texts like others; an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import words as W
from gridlake.session import shared_dir

U64 = np.uint64
END = U64(0x6A09E667F3BCC908)
BEGIN = U64(0xBB67AE8584CAA73B)
SHORT = U64(16)                    # word48 = word64 >> 16
FLUSH = 3_000_000
SHARD_BYTES = 16 << 20


def pack(*columns: np.ndarray) -> bytes:
    """Equal-length uint64 columns as compressed byte planes."""
    planes = [np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(raw: bytes, columns: int) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8)
    planes = flat.reshape(columns, 8, -1)
    return [np.ascontiguousarray(p.T).reshape(-1).view("<u8") for p in planes]


def summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct sorted keys and the sums of each value column."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return [keys[first], *[np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values]]


def tokens(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, context, text number) over a batch, end tokens included."""
    n = len(w.offsets) - 1
    token = np.insert(w.hashes, w.offsets[1:], END)
    owner = np.repeat(np.arange(n), w.counts + 1)
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[w.offsets[:-1] + np.arange(n)] = BEGIN
    return token, context, owner


def older(w: W.Words, context: np.ndarray) -> np.ndarray:
    """The token before each token's context."""
    n = len(w.offsets) - 1
    out = np.empty_like(context)
    out[1:] = context[:-1]
    out[w.offsets[:-1] + np.arange(n)] = BEGIN
    return out


def tri_key(pair: np.ndarray, w48: np.ndarray) -> np.ndarray:
    """Key of a trigram from its context's gram key."""
    return W.mix64(pair * U64(0xC2B2AE3D27D4EB4F) + W.mix64(w48 + U64(1)))


def gram_key(u48: np.ndarray, w48: np.ndarray) -> np.ndarray:
    return W.mix64(u48 * U64(0x9E3779B97F4A7C15) + W.mix64(w48))


def shard_of(keys: np.ndarray, log_shards: int) -> np.ndarray:
    return (keys >> U64(64 - log_shards)).astype(np.int64) if log_shards else np.zeros(len(keys), np.int64)


def by_shard(shards: np.ndarray, log_shards: int):
    """(shard, slice) of sorted shard numbers."""
    edges = np.searchsorted(shards, np.arange((1 << log_shards) + 1))
    for s in range(1 << log_shards):
        if edges[s] < edges[s + 1]:
            yield s, slice(int(edges[s]), int(edges[s + 1]))


ROW = "shard int, kind string, payload binary"
# kinds: w = (word64, count), u = (word48, followers once, twice, more), v = (word48, predecessors), s = gram file;
# at order 3 u ends with the sum of k, k = (u48, w48, predecessors), c = (gram key, followers once, twice, more, count),
# z = trigram file


def _frame(rows) -> pa.RecordBatch:
    shard, kind, payload = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(kind, pa.string()),
                                       pa.array(payload, pa.binary())], names=["shard", "kind", "payload"])


def _flushes(batches, order: int = 2):
    """(token, context), at order 3 also the token before, of about FLUSH tokens at a time."""
    held, size = [], 0
    for batch in batches:
        for a, m in W.text_slices(batch.column(0)):
            w = W.words(batch.column(0).slice(a, m), lower=True)
            token, context, _ = tokens(w)
            held.append((token, context) if order == 2 else (token, context, older(w, context)))
            size += len(token)
            if size >= FLUSH:
                yield tuple(np.concatenate(c) for c in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def word_rows(texts: DataFrame, log_shards: int) -> DataFrame:
    def over(batches):
        for token, _ in _flushes(batches):
            word, count = np.unique(token, return_counts=True)
            yield _frame([(s, "w", pack(np.diff(word[at], prepend=U64(0)), count[at].astype(U64)))
                          for s, at in by_shard(shard_of(word, log_shards), log_shards)])

    return texts.mapInArrow(over, ROW)


def gram_rows(texts: DataFrame, log_shards: int) -> DataFrame:
    def over(batches):
        for token, context in _flushes(batches):
            u, w = context >> SHORT, token >> SHORT
            key, first, count = np.unique(gram_key(u, w), return_index=True, return_counts=True)
            u, w = u[first], w[first]
            rows = []
            for s, at in by_shard(shard_of(key, log_shards), log_shards):
                order = np.argsort(u[at], kind="stable")           # sorted contexts pack into few bytes
                rows.append((s, "g", pack(np.diff(u[at][order], prepend=U64(0)), w[at][order],
                                          count[at][order].astype(U64))))
            yield _frame(rows)

    return texts.mapInArrow(over, ROW)


def tri_rows(texts: DataFrame, log_shards: int) -> DataFrame:
    def over(batches):
        for columns in _flushes(batches, 3):
            w, u, t = (c >> SHORT for c in columns)
            key, first, count = np.unique(tri_key(gram_key(t, u), w), return_index=True, return_counts=True)
            t, u, w = t[first], u[first], w[first]
            rows = []
            for s, at in by_shard(shard_of(key, log_shards), log_shards):
                order = np.argsort(t[at], kind="stable")
                rows.append((s, "t", pack(np.diff(t[at][order], prepend=U64(0)), u[at][order], w[at][order],
                                          count[at][order].astype(U64))))
            yield _frame(rows)

    return texts.mapInArrow(over, ROW)


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder or file."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if urlparse(uri).scheme else (fs.LocalFileSystem(), uri)


def write_arrays(folder: str, name: str, *arrays: np.ndarray) -> str:
    """One file of arrays after each other; its name tells their types and is
    unique to the attempt."""
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)
    file = f"{name}-{uuid.uuid4().hex}.{''.join(a.dtype.str[1:] for a in arrays)}"
    with system.open_output_stream(f"{path}/{file}") as out:
        for a in arrays:
            out.write(np.ascontiguousarray(a).tobytes())
    return file


def exact(counts: np.ndarray) -> np.ndarray:
    """Counts in four bytes where that holds each of them, else in eight."""
    return counts.astype(np.float32 if counts.max(initial=0) <= 1 << 24 else np.float64)


def merge_grams(pdf: pd.DataFrame, folder: str, log_shards: int) -> pd.DataFrame:
    """One gram shard: file of (key, count); rows for its words' shards."""
    parts = [unpack(p, 3) for p in pdf["payload"]]
    u = np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts])
    w, count = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    key = gram_key(u, w)
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
    total = np.add.reduceat(count[order], first)
    key, u, w = key[order][first], u[order][first], w[order][first]
    name = write_arrays(folder, "grams", key, exact(total))
    number = int(pdf["shard"].iloc[0])
    seen = np.bincount(np.minimum(total, 5).astype(np.int64), minlength=6)[1:5]
    rows = [(0, "s", f"{number}:{name}:{len(key)}:{':'.join(map(str, seen))}".encode())]
    one, two, more = (total == 1).astype(U64), (total == 2).astype(U64), (total > 2).astype(U64)
    for kind, columns in (("u", summed(u, one, two, more)), ("v", summed(w, np.ones(len(w), U64)))):
        shards = shard_of(columns[0] << SHORT, log_shards)
        rows += [(s, kind, pack(np.diff(columns[0][at], prepend=U64(0)), *[c[at] for c in columns[1:]]))
                 for s, at in by_shard(shards, log_shards)]
    return pd.DataFrame(rows, columns=["shard", "kind", "payload"])


def thirds(n: np.ndarray) -> list[np.ndarray]:
    return [(n == 1).astype(U64), (n == 2).astype(U64), (n > 2).astype(U64)]


def merge_tris(pdf: pd.DataFrame, folder: str, log_shards: int) -> pd.DataFrame:
    """One trigram shard: file of (key, count); rows for its bigrams' shards."""
    parts = [unpack(p, 4) for p in pdf["payload"]]
    t = np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts])
    u, w, count = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
    pair = gram_key(t, u)
    key, first = np.unique(tri_key(pair, w), return_index=True)
    _, total = summed(tri_key(pair, w), count)
    pair, u, w = pair[first], u[first], w[first]
    name = write_arrays(folder, "tris", key, exact(total))
    seen = np.bincount(np.minimum(total, 5).astype(np.int64), minlength=6)[1:5]
    rows = [(0, "z", f"{int(pdf['shard'].iloc[0])}:{name}:{len(key)}:{':'.join(map(str, seen))}".encode())]
    context, *followers = summed(pair, *thirds(total), total)
    rows += [(s, "c", pack(np.diff(context[at], prepend=U64(0)), *[f[at] for f in followers]))
             for s, at in by_shard(shard_of(context, log_shards), log_shards)]
    end, place, many = np.unique(gram_key(u, w), return_index=True, return_counts=True)
    rows += [(s, "k", pack(u[place][at], w[place][at], many[at].astype(U64)))
             for s, at in by_shard(shard_of(end, log_shards), log_shards)]
    return pd.DataFrame(rows, columns=["shard", "kind", "payload"])


def merge_pairs(pdf: pd.DataFrame, folder: str, log_shards: int) -> pd.DataFrame:
    """One bigram shard at order 3: file of (key, count as a context,
    predecessors, followers once, twice, more); rows for its words' shards."""
    def gathered(kind: str, columns: int):
        parts = [unpack(p, columns) for p in pdf.loc[pdf["kind"] == kind, "payload"]]
        return [np.concatenate([p[i] if kind == "k" or i else np.cumsum(p[0], dtype=U64) for p in parts])
                if parts else np.zeros(0, U64) for i in range(columns)]

    u, w, many = gathered("k", 3)
    key, first = np.unique(gram_key(u, w), return_index=True)
    _, k = summed(gram_key(u, w), many)
    u, w = u[first], w[first]
    context, one, two, more, total = summed(*gathered("c", 5))
    every = np.union1d(key, context)

    def spread(keys, values):
        out = np.zeros(len(every))
        out[np.searchsorted(every, keys)] = values
        return out

    name = write_arrays(folder, "grams", every, exact(spread(context, total)), exact(spread(key, k)),
                        *[exact(spread(context, f)) for f in (one, two, more)])
    seen = np.bincount(np.minimum(k, 5).astype(np.int64), minlength=6)[1:5]
    rows = [(0, "z", p) for p in pdf.loc[pdf["kind"] == "z", "payload"]]
    rows.append((0, "s", f"{int(pdf['shard'].iloc[0])}:{name}:{len(every)}:{':'.join(map(str, seen))}".encode()))
    for kind, columns in (("u", summed(u, *thirds(k), k)), ("v", summed(w, np.ones(len(w), U64)))):
        rows += [(s, kind, pack(np.diff(columns[0][at], prepend=U64(0)), *[c[at] for c in columns[1:]]))
                 for s, at in by_shard(shard_of(columns[0] << SHORT, log_shards), log_shards)]
    return pd.DataFrame(rows, columns=["shard", "kind", "payload"])


MANIFEST = "kind string, shard int, file string, n long, c1 long, c2 long, c3 long, c4 long, total long, types long, more long"


def merge_words(pdf: pd.DataFrame, folder: str, log_shards: int, order: int = 2) -> pd.DataFrame:
    """One word shard: file of (word, count, predecessors, followers once,
    twice, more, at order 3 their sum of k); also forwards the gram files' lines."""
    out = []
    for kind, line in pdf.loc[pdf["kind"].isin(["s", "z"]), ["kind", "payload"]].itertuples(index=False):
        number, name, n, *seen = line.decode().split(":")
        out.append(("gram" if kind == "s" else "tri", int(number), name, int(n), *map(int, seen), 0, 0, 0))

    def gathered(kind: str, columns: int):
        parts = [unpack(p, columns) for p in pdf.loc[pdf["kind"] == kind, "payload"]]
        if not parts:
            return [np.zeros(0, U64)] * columns
        return summed(np.concatenate([np.cumsum(p[0], dtype=U64) for p in parts]),
                      *[np.concatenate([p[i] for p in parts]) for i in range(1, columns)])

    number = int(pdf["shard"].iloc[0])
    word, count = gathered("w", 2)
    if int(shard_of(np.array([BEGIN]), log_shards)[0]) == number:
        at = int(np.searchsorted(word, BEGIN))
        word, count = np.insert(word, at, BEGIN), np.insert(count, at, U64(0))
    u, *followers = gathered("u", order + 2)
    v, before = gathered("v", 2)

    def at_words(keys, values):
        if not len(keys):
            return exact(np.zeros(len(word)))
        spot = np.minimum(np.searchsorted(keys, word >> SHORT), len(keys) - 1)
        return exact(np.where(keys[spot] == word >> SHORT, values[spot], U64(0)))

    k = at_words(v, before)
    name = write_arrays(folder, "words", word, exact(count), k, *[at_words(u, f) for f in followers])
    seen = np.bincount(np.minimum(k, 5).astype(np.int64), minlength=6)
    out.append(("word", number, name, len(word), *map(int, seen[1:5]), int(count.sum()), int((count > 0).sum()),
                int(k.astype(np.float64).sum())))
    return pd.DataFrame(out, columns=[c.split()[0] for c in MANIFEST.split(", ")])


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2, 3 and more; a count
    of counts that is missing leaves half the usual room."""
    if not n1 or not n2:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.clip(d, 0.0, [0, 1, 2, 3])


@dataclass
class Model:
    """Where the arrays are, and the few numbers that are not in them."""

    folder: str
    log_shards: int
    files: dict            # (kind, shard) -> (file name, rows)
    tokens: int            # training tokens, ends included
    types: int             # distinct training tokens
    pairs: int             # distinct bigrams (sum of predecessors)
    gram_discount: np.ndarray
    word_discount: np.ndarray
    word_gamma: float
    order: int = 2
    tri_discount: np.ndarray | None = None


def shard_bits(text_bytes: int) -> int:
    """Logarithm of the number of shards for so many bytes of training text."""
    return (max(1, -(-text_bytes // SHARD_BYTES)) - 1).bit_length()


def train(docs: DataFrame, text_col: str = "text", order: int = 2) -> Model:
    """Count ``docs`` and write the model below the shared folder."""
    if order not in (2, 3):
        raise ValueError("the order must be 2 or 3")
    folder = shared_dir(docs.sparkSession, "llm-lm")
    texts = docs.select(F.col(text_col).alias("text"))
    log_shards = shard_bits(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    if order == 2:
        grams = gram_rows(texts, log_shards).groupBy("shard").applyInPandas(
            lambda pdf: merge_grams(pdf, folder, log_shards), ROW)
    else:
        grams = tri_rows(texts, log_shards).groupBy("shard").applyInPandas(
            lambda pdf: merge_tris(pdf, folder, log_shards), ROW).groupBy("shard").applyInPandas(
            lambda pdf: merge_pairs(pdf, folder, log_shards), ROW)
    # one line per shard comes to the driver
    lines = word_rows(texts, log_shards).union(grams).groupBy("shard").applyInPandas(
        lambda pdf: merge_words(pdf, folder, log_shards, order), MANIFEST).collect()

    def total(kind, column):
        return sum(r[column] for r in lines if r["kind"] == kind)

    counts = [total("word", f"c{i}") for i in (1, 2, 3, 4)]
    word_discount = discounts(*counts)
    pairs = total("word", "more")
    types = total("word", "types")
    left = word_discount[1] * counts[0] + word_discount[2] * counts[1] + word_discount[3] * (types - counts[0] - counts[1])
    return Model(folder, log_shards, {(r["kind"], r["shard"]): (r["file"], r["n"]) for r in lines},
                 total("word", "total"), types, pairs, discounts(*[total("gram", f"c{i}") for i in (1, 2, 3, 4)]),
                 word_discount, left / pairs if pairs else 1.0, order,
                 discounts(*[total("tri", f"c{i}") for i in (1, 2, 3, 4)]) if order == 3 else None)


_OPEN: dict[str, list[np.ndarray]] = {}


def mapped(folder: str, name: str, rows: int) -> list[np.ndarray]:
    """The arrays of one file, memory-mapped (once per worker)."""
    uri = f"{folder}/{name}"
    if uri not in _OPEN:
        system, path = filesystem(uri)
        copy = None
        if system.type_name != "local":
            handle, copy = tempfile.mkstemp(prefix="lm-")
            with system.open_input_stream(path) as src, os.fdopen(handle, "wb") as dst:
                while chunk := src.read(1 << 22):
                    dst.write(chunk)
        raw = np.memmap(copy or path, dtype=np.uint8, mode="r")
        if copy:
            os.unlink(copy)                   # the mapping keeps it alive, nothing stays behind
        arrays, at = [], 0
        types = name.rpartition(".")[2]
        for kind in (f"<{types[i:i + 2]}" for i in range(0, len(types), 2)):
            width = np.dtype(kind).itemsize * rows
            arrays.append(raw[at:at + width].view(kind))
            at += width
        _OPEN[uri] = arrays
    return _OPEN[uri]


def look_up(model: Model, kind: str, keys: np.ndarray, columns: int) -> list[np.ndarray]:
    """Value columns at sorted distinct ``keys``; 0 where a key is absent."""
    out = [np.zeros(len(keys)) for _ in range(columns)]
    for s, at in by_shard(shard_of(keys, model.log_shards), model.log_shards):
        if (kind, s) not in model.files:
            continue
        name, rows = model.files[kind, s]
        if not rows:
            continue
        known, *values = mapped(model.folder, name, rows)
        spot = np.minimum(np.searchsorted(known, keys[at]), rows - 1)
        hit = known[spot] == keys[at]
        for o, v in zip(out, values):
            o[at] = np.where(hit, v[spot], 0.0)
    return out


def score_batch(model: Model, w: W.Words) -> tuple[np.ndarray, ...]:
    """(tokens, known tokens, base score, score) per text, log10."""
    token, context, owner = tokens(w)
    texts = len(w.offsets) - 1
    words, back = np.unique(np.concatenate([token, [BEGIN, END]]), return_inverse=True)
    count, before, *followers = look_up(model, "word", words, model.order + 3)
    of_token = back[:-2]
    # base: add-half unigrams
    base = np.log10((count + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
    # continuation unigrams
    dw = model.word_discount[np.minimum(before, 3).astype(np.int64)]
    p1 = (before - dw) / max(model.pairs, 1) + model.word_gamma / (model.types + 1)
    if model.order == 2:
        seen = count.copy()
        seen[back[-2]] = count[back[-1]]                # the begin token stands before as many texts as end
    else:
        seen = followers[3]
    d = model.gram_discount
    left = d[1] * followers[0] + d[2] * followers[1] + d[3] * followers[2]
    gamma = np.where(seen > 0, left / np.maximum(seen, 1), 1.0)
    at_context = np.searchsorted(words, context)
    keys, gram = np.unique(gram_key(context >> SHORT, token >> SHORT), return_inverse=True)
    if model.order == 2:
        c, = look_up(model, "gram", keys, 1)
    else:
        _, c, *_ = look_up(model, "gram", keys, 5)
    c = c[gram]
    p = (c - d[np.minimum(c, 3).astype(np.int64)]) / np.maximum(seen[at_context], 1) \
        + gamma[at_context] * p1[of_token]
    if model.order == 3:
        pair = gram_key(older(w, context) >> SHORT, context >> SHORT)
        keys, at = np.unique(pair, return_inverse=True)
        total, _, *follow = (x[at] for x in look_up(model, "gram", keys, 5))
        keys, gram = np.unique(tri_key(pair, token >> SHORT), return_inverse=True)
        c = look_up(model, "tri", keys, 1)[0][gram]
        d = model.tri_discount
        left = d[1] * follow[0] + d[2] * follow[1] + d[3] * follow[2]
        p = np.where(total > 0, (c - d[np.minimum(c, 3).astype(np.int64)] + left * p) / np.maximum(total, 1), p)
    n = np.bincount(owner, minlength=texts)
    return (n, np.bincount(owner, count[of_token] > 0, minlength=texts).astype(np.int64),
            np.bincount(owner, base[of_token], minlength=texts), np.bincount(owner, np.log10(p), minlength=texts))


SCORE_SCHEMA = "id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) per text;
    perplexity is 10 ** (-score / n_tokens)."""

    def over(batches):
        for batch in batches:
            for a, m in W.text_slices(batch.column(1)):
                n, known, base, score = score_batch(model, W.words(batch.column(1).slice(a, m), lower=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, m), pa.array(n.astype(np.int64)), pa.array(known),
                     pa.array(np.full(m, model.tokens, dtype=np.int64)), pa.array(base), pa.array(score)],
                    names=["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")) \
        .mapInArrow(over, SCORE_SCHEMA)
