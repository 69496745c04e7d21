"""Embedding near-dedup by randomised-rotation binary codes.

A unit vector x is rotated by fixed random orthogonal matrices; the signs
of its coordinates are its code, and the factor ``f = <sign(x')/sqrt(d), x'>``
is stored beside it.  For another vector y, ``<sign(x')/sqrt(d), y'> / f`` is
an unbiased estimate of <x, y>, off by more than
``EPSILON * sqrt((1 - f^2) / f^2 / (d - 1))`` only with vanishing probability.
As y every vector also stores y' in 8-bit steps; the bound allows for the
rounding.  Codes and factors are computed once, per node.

1. Equal vectors of a label collapse to one node with a weight.
2. Pairs that may link share a band of code bits.  Bits per band grow with
   the logarithm of the largest label, the number of bands follows from
   the chance that the codes of a pair at the threshold agree, so that such
   a pair is missed with probability ``MISS``.
3. Inside a bucket, the estimates' upper bounds drop pairs, from the stored
   codes alone.  A pair counts in the first band that it shares, so nothing
   has to be compared across buckets.
4. Nodes with an open pair meet once more, with their vectors, and the open
   pairs are recomputed exactly in double precision.

Scale: buckets with two or more shuffle codes (dim + bits / 8 bytes), and
only nodes with open pairs shuffle their vector.  Large buckets are cut into blocks and block pairs; a task gives
back link counts and a spanning set of links, never all pairs.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing; vectors of
different lengths do not link; null ids take the component's smallest id;
rows that repeat an id are vectors of their own; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.components import connected_components
from gridlake.llm.staging import shuffle_partitions, stage

MISS = 1e-9
SPARE_BITS = 5            # bits beyond log2 of the largest label: about 1 in 32 unrelated vectors meet another
EPSILON = 6.0             # standard errors
BLOCK = 512
PAIRS = 1 << 16           # open pairs recomputed at a time
KEYS = 1 << 22            # band keys compared at a time


@lru_cache(maxsize=64)
def rotation(dim: int, number: int) -> np.ndarray:
    """Random orthogonal matrix, the same on every worker."""
    q, r = np.linalg.qr(np.random.default_rng([dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def code_bits(x: np.ndarray, bits: int) -> np.ndarray:
    """Sign bits of unit vectors under as many rotations as ``bits`` need."""
    dim = x.shape[1]
    return np.hstack([x @ rotation(dim, r) > 0 for r in range(max(1, -(-bits // dim)))])


def correction(x: np.ndarray) -> np.ndarray:
    """Inner product of each vector's first code and its rotation."""
    return np.abs(x @ rotation(x.shape[1], 0)).sum(axis=1) / math.sqrt(x.shape[1])


def plan_bands(largest: int, threshold: float) -> tuple[int, int]:
    """(bits, bands) for labels of up to ``largest`` nodes."""
    bits = max(1, (max(largest, 1) - 1).bit_length()) + SPARE_BITS
    agree = (1 - math.acos(min(threshold, 1.0)) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-agree)) if agree < 1 else 1


def band_keys(bits: np.ndarray, width: int, bands: int) -> np.ndarray:
    """(vectors, bands) 64-bit values of each band's bits."""
    powers = np.uint64(1) << np.arange(width - 1, -1, -1, dtype=np.uint64)
    return bits[:, :width * bands].reshape(len(bits), bands, width).astype(np.uint64) @ powers


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat doubles, offsets) of a list column without nulls."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def digests(vectors: DataFrame) -> DataFrame:
    """(row, label, dim, digest): equal vectors have equal digests."""

    def over(batches):
        for batch in batches:
            flat, at = _vectors(batch.column(2))
            flat = flat + 0.0                                  # -0.0 and 0.0 are one value
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int32)),
                 pa.array([hashlib.blake2b(flat[a:b].tobytes(), digest_size=16).digest() for a, b in zip(at, at[1:])],
                          pa.binary())], names=["row", "label", "dim", "digest"])

    return vectors.select("row", "label", "vector").mapInArrow(over, "row long, label string, dim int, digest binary")


def sketches(nodes: DataFrame, width: int, bands: int) -> DataFrame:
    """(node, label, dim, keys, code, factor, scale, spread) of each node: the
    value of each band, all sign bits, the correction factor of the first
    ``dim`` of them, and the rotated vector as ``scale`` times 8-bit numbers."""

    def over(batches):
        for batch in batches:
            flat, at = _vectors(batch.column(2))
            dims = np.diff(at)
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                x = unit(np.stack([flat[at[i]:at[i + 1]] for i in mine]))
                bits = code_bits(x, width * bands)
                turned = x @ rotation(int(dim), 0)
                scale = np.abs(turned).max(axis=1) / 127
                spread = np.rint(turned / scale[:, None]).astype(np.int8)
                keys = band_keys(bits, width, bands).view(np.int64)
                rows = batch.take(pa.array(mine))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(dims[mine].astype(np.int32)),
                     pa.ListArray.from_arrays(np.arange(len(mine) + 1, dtype=np.int32) * bands, keys.reshape(-1)),
                     _packed(np.packbits(bits, axis=1)), pa.array(correction(x)), pa.array(scale), _packed(spread)],
                    names=["node", "label", "dim", "keys", "code", "factor", "scale", "spread"])

    return nodes.select("node", "label", "vector").mapInArrow(
        over, "node long, label string, dim int, keys array<long>, code binary, factor double, scale double, spread binary")


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def upper_bounds(a: tuple, b: tuple) -> np.ndarray:
    """Upper confidence bounds of <a, b> for all pairs of two sides, from the
    codes and factors of a and the 8-bit rotated vectors of b alone.  A side
    is (nodes, codes, factors, scales, spreads, ...)."""
    dim = a[4].shape[1]
    signs = np.where(np.unpackbits(a[1], axis=1, count=dim), np.float32(1), np.float32(-1))
    dots = (signs @ b[4].T.astype(np.float32)).astype(np.float64)          # whole numbers, exact
    f = a[2][:, None]
    wide = EPSILON * np.sqrt(np.maximum(1 - f * f, 0) / (f * f) / max(dim - 1, 1))
    rounding = math.sqrt(dim) * b[3] / 2                                   # at most half a step a component
    return (dots * (b[3] / math.sqrt(dim)) + rounding) / f + wide


def open_pairs(left: tuple, right: tuple | None, band: int, threshold: float, width: int):
    """Pairs (i, j) that the bounds leave open and no earlier band holds;
    ``right`` None compares ``left`` with itself."""
    same = right is None
    right = left if same else right
    left_open = np.ones((len(left[0]), len(right[0])), bool)
    if left[4].shape[1] > 8:
        left_open = (upper_bounds(left, right) >= threshold) & (upper_bounds(right, left).T >= threshold)
    if same:
        left_open &= np.triu(np.ones_like(left_open), 1)
    i, j = np.nonzero(left_open)
    if len(i):
        kx, ky = (band_keys(np.unpackbits(s[1], axis=1), width, band + 1) for s in (left, right))
        step = KEYS // (band + 1) + 1
        first = np.empty(len(i), bool)
        for a in range(0, len(i), step):
            equal = kx[i[a:a + step]] == ky[j[a:a + step]]
            first[a:a + step] = equal[:, band] & ~equal[:, :band].any(axis=1)
        i, j = i[first], j[first]
    return i, j


def block_links(left: tuple, right: tuple | None, band: int, threshold: float, width: int):
    """Links of a block pair that no earlier band holds.

    A side is (nodes, codes, factors, scales, spreads, weights, vectors).
    Returns (nodes, link counts, star centres) for the nodes that link.
    """
    i, j = open_pairs(left, right, band, threshold, width)
    if not len(i):
        return None
    same = right is None
    right = left if same else right
    x, y = unit(left[6]), unit(right[6])
    exact = np.concatenate([np.einsum("ij,ij->i", x[i[a:a + PAIRS]], y[j[a:a + PAIRS]]) >= threshold
                            for a in range(0, len(i), PAIRS)])
    i, j = i[exact], j[exact]
    if not len(i):
        return None
    a, b = i, (j if same else j + len(x))
    nodes = left[0] if same else np.concatenate([left[0], right[0]])
    counts = np.bincount(np.concatenate([a, b]), np.concatenate([right[5][j], left[5][i]]),
                         minlength=len(nodes)).astype(np.int64)
    centre = nodes.copy()
    while True:                                    # smallest node reachable inside the block
        low = np.minimum(centre[a], centre[b])
        new = centre.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == centre).all():
            break
        centre = new
    at = np.flatnonzero(counts)
    return nodes[at], counts[at], centre[at]


GROUP = ["label", "dim", "band", "bits", "lo", "hi"]
GROUP_TYPES = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()]
SKETCH = ["code", "factor", "scale", "spread"]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray | None]:
    """A column's values and, for bytes and lists, where each row starts."""
    if pa.types.is_binary(column.type):
        _, starts, data = column.buffers()
        at = np.frombuffer(starts, np.int32)[column.offset:column.offset + len(column) + 1]
        return np.frombuffer(data, np.uint8), at
    return _vectors(column) if pa.types.is_list(column.type) else (column.to_numpy(), None)


def _rows(flat: np.ndarray, at: np.ndarray | None, a: int, b: int) -> np.ndarray:
    """Rows a to b of a flat column; rows of bytes or doubles as a matrix."""
    return flat[a:b] if at is None else flat[at[a]:at[b]].reshape(b - a, -1)


def _cuts(batch: pa.RecordBatch) -> list[int]:
    """Where the values of the ``GROUP`` columns change, both ends included."""
    change = np.zeros(max(len(batch) - 1, 0), bool)
    for i in range(len(GROUP)):
        column = batch.column(i)
        if pa.types.is_string(column.type):
            column = column.dictionary_encode().indices
        values = column.to_numpy()
        change |= values[1:] != values[:-1]
    return [0, *(np.flatnonzero(change) + 1).tolist(), len(batch)]


def by_block_pair(rows: DataFrame, extra: list[str], solve, schema: str) -> DataFrame:
    """``solve(name, left, right)`` for each block pair of ``rows``, right None
    where a block meets itself; it returns a record batch or None."""
    columns = ["own", "node", *SKETCH, *extra]
    dealt = rows.repartition(4 * shuffle_partitions(rows.sparkSession), *GROUP) \
        .sortWithinPartitions(*GROUP, "own", "node").select(*GROUP, *columns)

    def solved(name, parts):
        own, *arrays = parts[0] if len(parts) == 1 else (np.concatenate(c) for c in zip(*parts))
        arrays[4] = np.ascontiguousarray(arrays[4]).view(np.int8)
        sides = [tuple(c[own == s] for c in arrays) for s in dict.fromkeys(name[4:])]
        found = solve(name, sides[0], sides[1] if len(sides) > 1 else None) if all(len(s[0]) for s in sides) else None
        return [] if found is None else [found]

    def over(batches):
        parts, name = [], None
        for batch in batches:
            if not len(batch):
                continue
            cuts, found = _cuts(batch), []
            names = zip(*(batch.column(i).take(pa.array(cuts[:-1])).to_pylist() for i in range(len(GROUP))))
            flat = [_flat(batch.column(c)) for c in range(len(GROUP), len(GROUP) + len(columns))]
            for a, b, here in zip(cuts, cuts[1:], names):
                if name is not None and here != name:
                    found += solved(name, parts)
                    parts = []
                name = here
                parts.append([_rows(*c, a, b) for c in flat])
            if found:
                yield from pa.Table.from_batches(found).combine_chunks().to_batches()
        if parts:
            yield from solved(name, parts)

    return dealt.mapInArrow(over, schema)


def near_links(nodes: DataFrame, width: int, bands: int, threshold: float) -> DataFrame:
    """(node, links, centre) parts; ``nodes``: (node, label, dim, weight, vector)."""
    codes = stage(sketches(nodes, width, bands), "embedding-codes")
    keyed = codes.select("label", "dim", F.posexplode("keys").alias("band", "bits"), "node")
    place = ["label", "dim", "band", "bits"]
    sizes = keyed.groupBy(*place).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int")
    dealt = keyed.join(sizes, place).withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")) \
        .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select(*place, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "node")
    sketch = codes.select("node", *SKETCH)

    def keep_open(name, left, right):
        """The rows of a block pair that are in an open pair."""
        i, j = open_pairs(left, right, name[2], threshold, width)
        if right is None:
            own, node = np.full(len(left[0]), name[4]), left[0]
            hit = np.union1d(i, j)
        else:
            own, node = np.repeat(name[4:], [len(left[0]), len(right[0])]), np.concatenate([left[0], right[0]])
            hit = np.union1d(i, j + len(left[0]))
        if not len(hit):
            return None
        same = [pa.array([v] * len(hit), t) for v, t in zip(name, GROUP_TYPES)]
        return pa.RecordBatch.from_arrays([*same, pa.array(own[hit], pa.int32()), pa.array(node[hit])],
                                          names=[*GROUP, "own", "node"])

    def link(name, left, right):
        done = block_links(left, right, name[2], threshold, width)
        return done and pa.RecordBatch.from_arrays([pa.array(c) for c in done], names=["node", "links", "centre"])

    found = stage(by_block_pair(dealt.join(sketch, "node"), [], keep_open,
                                "label string, dim int, band int, bits long, lo int, hi int, own int, node long"),
                  "embedding-open")
    rows = found.join(sketch, "node").join(nodes.select("node", "weight", "vector"), "node")
    return by_block_pair(rows, ["weight", "vector"], link, "node long, links long, centre long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = 0.98) -> DataFrame:
    """(id, n_links, component_id, kept) per row."""
    base = stage(vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                                F.col(vector_col).cast("array<double>").alias("vector"))
                 .withColumn("row", F.monotonically_increasing_id()), "embedding-rows")
    usable = base.filter(F.col("label").isNotNull() & F.col("vector").isNotNull()) \
        .filter(F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
                & F.exists("vector", lambda v: v != 0))
    digest = stage(digests(usable), "embedding-digests")
    groups = stage(digest.groupBy("label", "dim", "digest").agg(F.min("row").alias("node"),
                                                                F.count(F.lit(1)).alias("weight")), "embedding-nodes")
    nodes = groups.select("node", "label", "dim", "weight").join(base.select(F.col("row").alias("node"), "vector"), "node")
    largest = groups.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 1
    parts = stage(near_links(nodes, *plan_bands(largest, threshold), threshold), "embedding-links")
    links = parts.groupBy("node").agg(F.sum("links").alias("links"))
    near = connected_components(parts.select(F.col("node").alias("a"), F.col("centre").alias("b")))
    member = digest.join(groups, ["label", "dim", "digest"]).select("row", "node", "weight") \
        .join(links, "node", "left").join(near, "node", "left") \
        .select("row", F.coalesce("component", "node").alias("component"),
                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    rows = base.select("row", "id").join(member, "row", "left")
    least = rows.filter("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    none = F.lit(0).cast("long")
    return rows.join(least, "component", "left").select(
        "id", F.coalesce("n_links", none).alias("n_links"),
        F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")) \
        .withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
