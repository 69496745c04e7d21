"""Substring dedup: repeated windows of words, removed as maximal intervals.

Every run of ``window`` words is a Rabin-Karp hash (64 + 32 bits).  A word
goes if it is covered by a window whose word sequence also starts in a
document with a smaller id; windows are judged on the input.

To count windows in Spark without shuffling one row per word, each window
names its anchor: the smallest hash among its runs of ``RUN`` words.
Equal windows have equal anchors, and neighbouring windows mostly share
one, so (anchor, document) pairs are about 4 % of the words.  Only windows
whose anchor lies in two or more documents can repeat; these, and no
others, are counted.  The anchors' bitmap has a fixed size bound; when it
is too full to filter, more windows are counted, with the same result.

Scale: windows are shuffled once by hash.  Anchors that very many documents
share (there can be few of these) get their windows dealt over salts, the
first window of each salt meeting in a second, small step.  Texts are
shuffled once, to meet their intervals.

Edge cases: null or empty texts have no words; texts shorter than the
window lose nothing; rows with a null id neither lose words nor make
others lose any; rows that share an id do not count against each other;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm import membership
from gridlake.llm import words as W
from gridlake.llm.staging import shuffle_partitions, stage

WINDOW = 50
RUN = 8


def smallest_in(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling spans."""
    span = 1
    while 2 * span <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    rest = width - span
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def anchors(w: W.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, valid) of the window that starts at each word."""
    n = len(w.hashes)
    run = min(RUN, window)
    out = np.zeros(n, dtype=np.uint64)
    _, valid = W.runs(w, window)
    if n >= window:
        h, _ = W.runs(w, run, seed=3)
        least = smallest_in(h[:n - run + 1], window - run + 1)
        out[:len(least)] = least
    return W.mix64(out), valid


def text_marks(w: W.Words) -> np.ndarray:
    """32-bit hash of each text's word sequence: tells rows that share an id apart."""
    total = np.zeros(len(w.hashes) + 1, dtype=np.uint64)
    np.cumsum(w.hashes * W.powers(np.uint64(0x9E3779B97F4A7C15), len(w.hashes)), out=total[1:])
    start = W.powers(np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64)), len(w.hashes) + 1)
    mark = W.mix64((total[w.offsets[1:]] - total[w.offsets[:-1]]) * start[w.offsets[:-1]])
    return (mark >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _batches(batches):
    """(ids, words) of bounded parts of (id, text) batches."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for a, m in W.text_slices(batch.column(1)):
            yield ids[a:a + m].astype(np.int64), W.words(batch.column(1).slice(a, m))


def repeated_starts(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, mark, start) of each window whose word sequence also starts in a
    row with a smaller id; ``texts``: (id bigint not null, text)."""
    spark = texts.sparkSession

    def pairs(batches):
        for ids, w in _batches(batches):
            anchor, valid = anchors(w, window)
            owner = np.repeat(np.arange(len(ids)), w.counts)
            anchor, owner = anchor[valid], owner[valid]
            new = np.ones(len(anchor), dtype=bool)          # neighbours mostly share their anchor
            new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(anchor[new].view(np.int64)), pa.array(ids[owner[new]])],
                                             names=["anchor", "id"])

    held = texts.mapInArrow(pairs, "anchor long, id long").groupBy("anchor").agg(
        F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("n"))
    shared = stage(held.filter("least < most").select("anchor", "n"), "substring-anchors")
    size = shared.agg(F.count(F.lit(1)).alias("keys"), F.sum("n").alias("pairs")).first()
    bitmap = membership.build(shared, "anchor", size["keys"])
    # hot anchors: more pairs than a quarter of an even share; at most 4 x partitions of them exist
    most = -(-(size["pairs"] or 0) // (4 * shuffle_partitions(spark))) + 1
    hot = sorted((r["anchor"] & (1 << 64) - 1, -(-r["n"] // most)) for r in shared.filter(F.col("n") > most).collect())
    sent = spark.sparkContext.broadcast((bitmap, np.array([k for k, _ in hot], dtype=np.uint64),
                                         np.array([s for _, s in hot], dtype=np.int64)))

    def windows(batches):
        bitmap, hot_keys, hot_salts = sent.value
        for ids, w in _batches(batches):
            anchor, valid = anchors(w, window)
            at = np.flatnonzero(valid & bitmap.contains(anchor))
            first, _ = W.runs(w, window, seed=11)
            second, _ = W.runs(w, window, seed=12)
            owner = np.repeat(np.arange(len(ids)), w.counts)[at]
            salt = np.zeros(len(at), dtype=np.int32)
            if len(hot_keys):
                spot = np.minimum(np.searchsorted(hot_keys, anchor[at]), len(hot_keys) - 1)
                is_hot = hot_keys[spot] == anchor[at]
                salt[is_hot] = 1 + (W.mix64(ids[owner].view(np.uint64)).astype(np.uint64)
                                    % hot_salts[spot].astype(np.uint64)).astype(np.int32)[is_hot]
            yield pa.RecordBatch.from_arrays([
                pa.array(first[at].view(np.int64)), pa.array((second[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                pa.array(salt), pa.array(ids[owner]), pa.array(text_marks(w)[owner]),
                pa.array((at - w.offsets[owner]).astype(np.int32))], names=["h1", "h2", "salt", "id", "mark", "start"])

    rows = texts.mapInArrow(windows, "h1 long, h2 int, salt int, id long, mark int, start int")
    least = F.min("id").over(Window.partitionBy("h1", "h2", "salt"))
    judged = stage(rows.withColumn("repeat", least < F.col("id")).filter("repeat or salt > 0")
                   .select("id", "mark", "start", "repeat", F.when(F.expr("not repeat"), F.col("h1")).alias("h1"),
                           F.when(F.expr("not repeat"), F.col("h2")).alias("h2")), "substring-windows")
    # of a hot window, the rows that no smaller id of their own salt precedes
    across = F.min("id").over(Window.partitionBy("h1", "h2"))
    second = judged.filter("not repeat").withColumn("repeat", across < F.col("id")).filter("repeat")
    columns = ["id", "mark", "start"]
    return judged.filter("repeat").select(*columns).union(second.select(*columns))


OUT_SCHEMA = "id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal [from, to) word intervals covered by windows at ``starts``."""
    out: list[tuple[int, int]] = []
    for s in np.sort(starts).tolist():
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + window)
        else:
            out.append((s, s + window))
    return out


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     with_text: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept_text) per row: the words
    that stay, joined by one space (``kept_text`` null unless asked for)."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = repeated_starts(base.filter("id is not null"), window)
    packed = F.shiftleft(F.col("mark").cast("long"), 32).bitwiseOR(F.col("start").cast("long"))
    per_id = found.groupBy(F.col("id").alias("found_id")).agg(F.collect_list(packed).alias("places"))

    def over(batches):
        for batch in batches:
            for a, m in W.text_slices(batch.column(1)):
                part = batch.slice(a, m)
                marks = text_marks(W.words(part.column(1)))
                rows = []
                for i, (ident, text, places) in enumerate(zip(part.column(0).to_pylist(), part.column(1), part.column(2))):
                    kept = (text.as_py() or "").encode().split()      # splits at exactly the six white-space bytes
                    n = len(kept)
                    if places.is_valid:
                        place = places.values.to_numpy()
                        mine = place[(place >> 32) == marks[i]] & 0xFFFFFFFF
                        for start, stop in reversed(intervals(mine, window)):
                            del kept[start:stop]
                    text = b" ".join(kept)
                    rows.append((ident, n, n - len(kept), hashlib.sha256(text).hexdigest(),
                                 text.decode() if with_text else None))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                     pa.array(columns[3], pa.string()), pa.array(columns[4], pa.string())],
                    names=["id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return base.join(per_id, F.col("id") == F.col("found_id"), "left").select("id", "text", "places") \
        .mapInArrow(over, OUT_SCHEMA)
