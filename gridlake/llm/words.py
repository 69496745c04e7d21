"""Vectorised words and hashes of Arrow string batches.

A word is a maximal run of bytes other than the six ASCII white-space
bytes (space, 0x09-0x0D), i.e. ``[^\\x20\\x09-\\x0D]+``; in UTF-8 these bytes
never occur inside another character, so bytes can be scanned directly.
Each word becomes a 64-bit polynomial hash of its bytes; shingles and
windows are polynomials over word hashes.  Everything works on blocks of
bounded size, so one very long text needs only its word hashes in memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 1 << 17
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (two xor-shift-multiply rounds)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def _byte_table(separators: np.ndarray, lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=U64)
    if lower:
        codes[65:91] += U64(32)
    table = mix64((codes + U64(1)) * U64(0x9E3779B97F4A7C15)) | U64(1)
    table[separators] = U64(0)
    return table


_BASE = U64(0x5851F42D4C957F2D)   # odd: powers are invertible


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    if n:
        out[0] = U64(1)
    return np.multiply.accumulate(out)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_slices(column: pa.Array, max_bytes: int = 1 << 20):
    """(first row, rows) parts of a string column of about ``max_bytes`` each
    (a longer text is a part of its own): bounds the memory of one step."""
    _, offsets = utf8(column)
    a, n = 0, len(column)
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + max_bytes, side="right")) - 1)
        yield a, min(b, n) - a
        a = min(b, n)


class Words:
    """Words of a batch: ``hashes`` (uint64, all texts after each other),
    ``offsets`` (text i owns hashes[offsets[i]:offsets[i+1]]), and each
    word's first byte and length in ``raw``."""

    def __init__(self, hashes, offsets, starts, lengths, raw):
        self.hashes, self.offsets = hashes, offsets
        self.starts, self.lengths, self.raw = starts, lengths, raw

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.offsets[i]:self.offsets[i + 1]]


def _block_ends(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray):
    """Cut points about BLOCK_BYTES apart, never inside a word."""
    a, n = 0, len(raw)
    while a < n:
        b = a + BLOCK_BYTES
        if b >= n:
            yield a, n
            return
        stop = int(offsets[np.searchsorted(offsets, b)])   # next text boundary
        while b < stop:
            gaps = np.flatnonzero(separators[raw[b:min(b + 4096, stop)]])
            if len(gaps):
                b += int(gaps[0])
                break
            b = min(b + 4096, stop)
        yield a, b
        a = b


def words(column: pa.Array, lower: bool = False, separators: np.ndarray = WHITE) -> Words:
    """Word hashes of each text of ``column`` (``lower``: A-Z count as a-z)."""
    raw, offsets = utf8(column)
    table = _byte_table(separators, lower)
    hashes, starts, lengths = [], [], []
    for a, b in _block_ends(raw, offsets, separators):
        block = raw[a:b]
        gap = separators[block]
        edge = np.empty(len(block), dtype=bool)           # a word cannot continue across these
        edge[0] = True
        edge[1:] = gap[:-1]
        lo, hi = np.searchsorted(offsets, [a, b])
        edge[offsets[lo:hi] - a] = True
        begin = np.flatnonzero(edge & ~gap)
        if not len(begin):
            continue
        owner = np.repeat(begin, np.diff(np.append(begin, len(block))))
        place = np.arange(begin[0], len(block)) - owner    # byte number inside the word
        place[gap[begin[0]:]] = 0
        value = table[block[begin[0]:]]
        value *= powers(_BASE, int(place.max()) + 1)[place]
        hashes.append(mix64(np.add.reduceat(value, begin - begin[0])))
        lengths.append(np.add.reduceat(~gap[begin[0]:], begin - begin[0], dtype=np.int64))
        starts.append(begin + a)
    if not hashes:
        none = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(0, dtype=U64), np.zeros(len(offsets), dtype=np.int64), none, none, raw)
    where = np.concatenate(starts)
    return Words(np.concatenate(hashes), np.searchsorted(where, offsets).astype(np.int64), where,
                 np.concatenate(lengths), raw)


def runs(w: Words, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash, valid) for the run of ``k`` words that starts at each word of
    the batch; ``valid`` is False where the run would leave its text.
    Rabin-Karp: differences of one prefix sum of word hash x power."""
    n = len(w.hashes)
    if n == 0:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=bool)
    base = U64(0xC2B2AE3D27D4EB4F) + U64(2 * seed)
    total = max(n - k + 1, 0)
    out = np.zeros(n, dtype=U64)
    if k <= 8:
        for j, p in enumerate(powers(base, k)):
            out[:total] += w.hashes[j:j + total] * p
    else:
        inverse = U64(pow(int(base), -1, 1 << 64))
        sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(w.hashes * powers(base, n), out=sums[1:])
        out[:total] = (sums[k:k + total] - sums[:total]) * powers(inverse, n)[:total]
    ends = np.repeat(w.offsets[1:], w.counts)
    return mix64(out), np.arange(n) + k <= ends


def shingle_sets(w: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: every run of ``k`` words;
    the whole word sequence where there are fewer; empty without words."""
    h, valid = runs(w, k)
    out = []
    for i in range(len(w.offsets) - 1):
        a, b = int(w.offsets[i]), int(w.offsets[i + 1])
        if b - a >= k:
            out.append(np.unique(h[a:b - k + 1]))
        elif b > a:
            short = (w.hashes[a:b] * powers(U64(0x9E3779B97F4A7C15), b - a)).sum(dtype=U64)
            out.append(mix64(np.array([short ^ U64(b - a)], dtype=U64)))
        else:
            out.append(np.zeros(0, dtype=U64))
    return out


def set_ids(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128-bit identity of each set, as two int64 columns (order-free sums)."""
    a = np.array([mix64(s).sum(dtype=U64) if len(s) else U64(0) for s in sets], dtype=U64)
    b = np.array([mix64(s * U64(0xA0761D6478BD642F)).sum(dtype=U64) if len(s) else U64(0) for s in sets], dtype=U64)
    return a.view(np.int64), b.view(np.int64)
