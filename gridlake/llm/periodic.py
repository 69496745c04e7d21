"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least
``min_exponent`` periods (four or more) and ``min_words`` words long, that
neither neighbouring word extends.  At each dyadic scale t = 4, 8, 16, ...
a position is selected when, among the windows of t words that start at it
and at the t positions after it, the one with the least hash starts at
either end.  Windows that lie in a highly periodic region (period at most
t / 4) take no part.  The choice depends on the 2 t words from a position
on alone, so equal contexts are selected alike, and a stretch without
selected positions is highly periodic.  Hence

* in a run of period q, with t the greatest scale not above q, a selected
  position and the next one with the same context of 2 t words lie exactly
  q apart: such pairs, t <= distance < 2 t, propose the periods;
* periods 1 to 3 are supplied by direct comparison of the words 1 to 3
  apart; together with the runs of smaller scales they are the highly
  periodic regions that a scale leaves out.

A proposal is extended word by word to both sides (in doubling chunks),
once per run, so the found runs are exact up to 64-bit hashes of words.
Of two periods of one stretch the smaller is kept.

Scale: documents are independent; texts stay where they are read (no
shuffle) and go through numpy in bounded parts.  A long text needs its
word hashes in memory; its work is close to linear in its words.

Edge cases: null and empty texts have no words and no runs; null ids and
repeated rows are answered row by row; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import words as W
from gridlake.llm.substring import smallest_in

MIN_EXPONENT = 4        # the least that the selection is complete for
DIRECT = 3              # periods that are compared directly
NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the maximal stretches of True."""
    edge = np.diff(np.concatenate([[0], equal.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def direct_runs(h: np.ndarray, owner: np.ndarray, period: int) -> list[tuple[int, int, int]]:
    """(start, stop, period) of all stretches of at least four periods."""
    if len(h) <= period:
        return []
    a, b = stretches((h[:-period] == h[period:]) & (owner[:-period] == owner[period:]))
    long = b - a >= (MIN_EXPONENT - 1) * period
    return [(int(s), int(e) + period, period) for s, e in zip(a[long], b[long])]


def common(h: np.ndarray, x: int, y: int, stop: int) -> int:
    """Number of equal words from x and y (> x) on, y staying below ``stop``."""
    n, step, most = 0, 32, stop - y
    while n < most:
        m = min(step, most - n)
        differ = np.flatnonzero(h[x + n:x + n + m] != h[y + n:y + n + m])
        if len(differ):
            return n + int(differ[0])
        n, step = n + m, 2 * step
    return most


def common_back(h: np.ndarray, x: int, y: int, start: int) -> int:
    """Number of equal words before x and y (> x), x staying at ``start`` or above."""
    n, step, most = 0, 32, x - start
    while n < most:
        m = min(step, most - n)
        differ = np.flatnonzero(h[x - n - m:x - n] != h[y - n - m:y - n])
        if len(differ):
            return n + m - 1 - int(differ[-1])
        n, step = n + m, 2 * step
    return most


def selected(w: W.Words, t: int, regions: list[tuple[int, int, int]]) -> np.ndarray:
    """Positions of the synchronising set at scale ``t``; ``regions`` are the
    (start, stop, period) stretches of at least four periods known so far."""
    n = len(w.hashes)
    ids, _ = W.runs(w, t, seed=17)
    # all ones marks windows of highly periodic regions
    ids = np.minimum(ids, NEVER - np.uint64(1))
    inside = np.zeros(n + 1, dtype=np.int64)
    for start, stop, period in regions:
        if 4 * period <= t <= stop - start:
            inside[start] += 1
            inside[stop - t + 1] -= 1
    ids[np.cumsum(inside)[:n] > 0] = NEVER
    if n < 2 * t:
        return np.zeros(0, dtype=np.int64)
    least = smallest_in(ids, t + 1)[:n - 2 * t + 1]
    ends = np.repeat(w.offsets[1:], w.counts)[:len(least)]
    at = np.arange(len(least))
    return np.flatnonzero((at + 2 * t <= ends) & (least != NEVER)
                          & ((least == ids[:len(least)]) | (least == ids[t:t + len(least)])))


def proposals(w: W.Words, owner: np.ndarray, t: int, regions) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of neighbouring selected positions with equal
    contexts, t <= distance < 2 t, by distance, then position."""
    at = selected(w, t, regions)
    context, _ = W.runs(w, 2 * t, seed=19)
    key = W.mix64(context[at] ^ (owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    left, right = at[order[:-1]], at[order[1:]]
    gap = right - left
    good = (key[order[:-1]] == key[order[1:]]) & (gap >= t) & (gap < 2 * t) & (owner[left] == owner[right])
    left, gap = left[good], gap[good]
    sort = np.lexsort((left, gap))
    return left[sort], gap[sort]


def extend(w: W.Words, owner: np.ndarray, at: np.ndarray, gap: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, stop, period) of the proposals, each stretch once."""
    out, i, h = [], 0, w.hashes
    while i < len(at):
        x, q = int(at[i]), int(gap[i])
        start, stop = int(w.offsets[owner[x]]), int(w.offsets[owner[x] + 1])
        a = x - common_back(h, x, x + q, start)
        b = x + q + common(h, x, x + q, stop)
        if b - a >= MIN_EXPONENT * q:
            out.append((a, b, q))
        # further proposals of this distance inside the stretch say the same
        last = int(np.searchsorted(gap, q, side="right"))
        i += max(1, int(np.searchsorted(at[i:last], max(b - q, x + 1))))
    return out


def all_runs(w: W.Words) -> list[tuple[int, int, int]]:
    """(start, stop, period) in batch positions of every stretch of at least
    four of its smallest periods, by start, then period."""
    owner = np.repeat(np.arange(len(w.counts)), w.counts)
    found = [r for p in range(1, DIRECT + 1) for r in direct_runs(w.hashes, owner, p)]
    counts, t = w.counts, DIRECT + 1
    while len(counts) and 4 * t <= counts.max():
        keep = np.flatnonzero(counts >= 4 * t)              # a run of period t or more needs 4 t words
        part, back = _only(w, keep)
        where = np.repeat(np.arange(len(keep)), part.counts)
        regions = _shifted(found, w, keep, part)
        at, gap = proposals(part, where, t, regions)
        found += [(int(a + back[where[a]]), int(b + back[where[a]]), q) for a, b, q in extend(part, where, at, gap)]
        t *= 2
    least: dict[tuple[int, int], int] = {}
    for a, b, q in found:
        least[a, b] = min(q, least.get((a, b), q))
    return sorted((a, b, q) for (a, b), q in least.items())


def _only(w: W.Words, keep: np.ndarray) -> tuple[W.Words, np.ndarray]:
    """The texts ``keep`` of a batch, and what to add to a position of each
    to get its position in the batch."""
    if len(keep) == len(w.counts):
        return w, np.zeros(len(keep), dtype=np.int64)
    counts = w.counts[keep]
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    back = w.offsets[keep] - offsets[:-1]
    at = np.arange(offsets[-1]) + np.repeat(back, counts)
    return W.Words(w.hashes[at], offsets, w.starts, w.lengths, w.raw), back


def _shifted(found, w: W.Words, keep: np.ndarray, part: W.Words) -> list[tuple[int, int, int]]:
    """``found`` (batch positions) in positions of ``part``."""
    if not found:
        return []
    starts = np.array([a for a, _, _ in found])
    text = np.searchsorted(w.offsets, starts, side="right") - 1
    place = np.searchsorted(keep, text)
    place[place == len(keep)] = 0
    out = []
    for (a, b, q), i, j in zip(found, text.tolist(), place.tolist()):
        if keep[j] == i:
            shift = int(part.offsets[j] - w.offsets[i])
            out.append((a + shift, b + shift, q))
    return out


def runs_of_texts(w: W.Words, min_words: int, min_exponent: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in w.counts]
    for a, b, q in all_runs(w):
        if b - a >= max(min_words, min_exponent * q):
            i = int(np.searchsorted(w.offsets, a, side="right")) - 1
            out[i].append((a - int(w.offsets[i]), b - a, q))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period (exact), then least start, then period."""
    best = None
    for r in runs:                                          # by start, then period: only a greater one replaces
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


OUT_SCHEMA = ("id long, n_words long, runs array<struct<start:long,length:long,period:long>>, start long, length long, "
              "period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, collapsed_text string")


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 6,
                  min_exponent: int = MIN_EXPONENT, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: all runs, the strongest of them, digests
    of the runs (``start,length,period`` lines) and of the words that stay
    when each run keeps its first period only, and their text joined by one
    space (``collapsed_text``; null unless asked for)."""
    if min_exponent < MIN_EXPONENT:
        raise ValueError(f"runs of fewer than {MIN_EXPONENT} periods are not found")
    schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()),
                        ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                        *[(c, pa.int64()) for c in ("start", "length", "period", "exponent_milli")],
                        *[(c, pa.string()) for c in ("runs_sha256", "collapsed_sha256", "collapsed_text")]])

    def over(batches):
        for batch in batches:
            for a, m in W.text_slices(batch.column(1)):
                part = batch.slice(a, m)
                w = W.words(part.column(1))
                rows = []
                for ident, text, runs in zip(part.column(0).to_pylist(), part.column(1),
                                             runs_of_texts(w, min_words, min_exponent)):
                    split = (text.as_py() or "").encode().split()         # splits at exactly the six white-space bytes
                    kept = b" ".join(collapsed(split, runs))
                    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                    best = strongest(runs)
                    rows.append({
                        "id": ident, "n_words": len(split),
                        "runs": [{"start": s, "length": n, "period": q} for s, n, q in runs],
                        **dict(zip(("start", "length", "period"), best or (None,) * 3)),
                        "exponent_milli": best and 1000 * best[1] // best[2],
                        "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(),
                        "collapsed_sha256": hashlib.sha256(kept).hexdigest(),
                        "collapsed_text": kept.decode() if with_text else None})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(over, OUT_SCHEMA)
