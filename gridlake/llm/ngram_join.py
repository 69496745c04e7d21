"""N-gram Jaccard join by token-combination prefixes.

A text is the set of its distinct word shingles.  Two sets link when
``den * |x & y| >= num * |x | y|`` (exactly, on integers).  Sets are put in
one order, rare shingles first, and indexed by their prefixes:

* the smallest shared shingle of two linked sets lies in the first
  ``n - ceil(t n) + 1`` shingles of both.  If it is rare, it is indexed on
  its own;
* if it is frequent, so is the second smallest shared one, and both lie in
  the prefix extended by one: frequent shingles are indexed in pairs, which
  are far rarer than they are.  Sets whose prefix would make too many pairs
  index frequent shingles singly; sets near that size do both, so that any
  two that can link share a key.

Frequency classes come from a table of 2**24 hashed counters over all
texts (the same for every set, so the order is consistent; its size does
not depend on the corpus).  Keys that two or more sets share propose pairs:
first each set against a few leaders of its keys, then, where sets are still
in different components, the pairs across components.  That is enough for
components; ``jaccard_links`` verifies every pair that shares a key and
gives all links between different sets.  For these pairs, keys with the
same least set are one circle: a set that shares hundreds of keys with a
group of near copies is in a few circles of it, and meets the group a few
times, in blocks, not once for each key.  A
proposed pair must pass an exact bound first: each set carries the parities
of its shingles' counts in hash places, and the places in which two
sets differ cannot outnumber the shingles that only one of them has.  What
passes is verified on the whole sets.

Scale: copies (equal sets) collapse to one node before anything is joined;
texts are never shuffled, only keys and, for sets that share a key, the
sets; groups of copies never become all their pairs.  A node is named by a
64-bit hash of its set; shingles are compared by their 64-bit hashes.

Edge cases: null texts and texts without words have the empty set, link
with nothing and are their own component; fewer words than a shingle make
one shingle of the whole sequence; null ids get the component's smallest
non-null id; repeated rows give repeated result rows; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import membership
from gridlake.llm import words as W
from gridlake.llm.components import connected_components
from gridlake.llm.memory import giving_back, small_batches
from gridlake.llm.staging import stage

COUNTER_BITS = 24
CHUNK = 1 << 17
FREQUENT = 2            # class from which shingles are frequent: 4 times an even share
MIN_PLACES = 512
PAIR_PREFIX = 24        # longest extended prefix that is indexed in pairs
BLOCK = 1024            # sets of a circle that meet in one piece


def nodes_of(sets: list[np.ndarray]) -> np.ndarray:
    """64-bit name of each set (0 for the empty one)."""
    return np.array([int(W.mix64(s ^ np.uint64(0x5BF0A8B1)).sum(dtype=np.uint64)) | 1 if len(s) else 0 for s in sets],
                    dtype=np.uint64)


def _sets(batches, shingle: int):
    """(ids, sets) of bounded parts of (id, text) batches."""
    for batch in batches:
        for a, m in W.text_slices(batch.column(1)):
            part = batch.slice(a, m)
            yield part.column(0), W.shingle_sets(W.words(part.column(1), lower=True), shingle)


def squeeze(counters: np.ndarray) -> bytes:
    """Counters (uint64) as compressed byte planes."""
    planes = np.ascontiguousarray(counters.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def frequency_classes(texts: DataFrame, shingle: int, log_counters: int = COUNTER_BITS) -> np.ndarray:
    """Class of each hashed counter: log2 of its count over an even share
    (at least 8), 0 for counts below twice that.  One byte a counter."""
    size = 1 << log_counters

    def count(batches):
        total = np.zeros(size, dtype=np.uint32)
        for _, sets in _sets(batches, shingle):
            if sets:
                places = np.concatenate(sets) >> np.uint64(64 - log_counters)
                np.add.at(total, places.astype(np.int64), np.uint32(1))
        chunks = [i for i in range(size // CHUNK) if total[i * CHUNK:(i + 1) * CHUNK].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunks, pa.int32()),
             pa.array([squeeze(total[i * CHUNK:(i + 1) * CHUNK]) for i in chunks], pa.binary())],
            names=["chunk", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, dtype=np.uint64)
        for packed in pdf["counts"]:
            total += unsqueeze(packed)
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "counts": [squeeze(total)]})

    rows = texts.mapInArrow(giving_back(count), "chunk int, counts binary").groupBy("chunk") \
        .applyInPandas(add, "chunk int, counts binary").collect()           # the counters, whatever the corpus
    share = max(sum(int(unsqueeze(r["counts"]).sum()) for r in rows) / size, 8.0)
    classes = np.zeros(size, dtype=np.uint8)
    for r in rows:
        ratio = np.maximum(unsqueeze(r["counts"]) / share, 1.0)
        classes[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.floor(np.log2(ratio)).astype(np.uint8)
    return classes


def index_keys(s: np.ndarray, classes: np.ndarray, num: int, den: int, frequent: int = FREQUENT) -> np.ndarray:
    """Prefix keys of one sorted distinct set; linked sets share a key."""
    n = len(s)
    least = -(-num * n // den)                  # shared shingles that a link needs
    first, extended = n - least + 1, min(n, n - least + 2)
    cls = classes[(s >> np.uint64(65 - len(classes).bit_length())).astype(np.int64)]
    order = np.lexsort((s, cls))[:extended]
    head, cls = s[order], cls[order]
    rare = int(np.searchsorted(cls, frequent))
    keys = [W.mix64(head[:min(rare, first)] ^ np.uint64(0x1))]
    often = head[rare:]
    if len(often):
        limit = PAIR_PREFIX * den // (den - num)               # sets up to this size are indexed in pairs
        if n * num <= limit * den:
            i, j = np.triu_indices(len(often), 1)
            keys.append(W.mix64(often[i] * np.uint64(0x9E3779B97F4A7C15) + often[j] * np.uint64(0xC2B2AE3D27D4EB4F)))
        if n > limit:
            keys.append(W.mix64(head[rare:first] ^ np.uint64(0x2)))
    return np.unique(np.concatenate(keys))


def parities(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Is the number of shingles in each hash place odd?  Four places (a power
    of two, at least MIN_PLACES) for each shingle by which a linked set may
    differ, as int64 words."""
    apart = 2 * len(s) * (den - num) // (den + num)
    places = max(MIN_PLACES, 1 << max(4 * apart - 1, 0).bit_length())
    place = (W.mix64(s) & np.uint64(places - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=places) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def indexed(texts: DataFrame, shingle: int, num: int, den: int, frequent: int = FREQUENT,
            log_counters: int = COUNTER_BITS) -> DataFrame:
    """(id, node, n, parity, keys) of each text."""
    sent = texts.sparkSession.sparkContext.broadcast(frequency_classes(texts, shingle, log_counters))

    def over(batches):
        for ids, sets in _sets(batches, shingle):
            keys = [index_keys(s, sent.value, num, den, frequent).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets]
            parity = [parities(s, num, den) for s in sets]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(nodes_of(sets).view(np.int64)), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(parity, longs), pa.array(keys, longs)], names=["id", "node", "n", "parity", "keys"])

    return texts.mapInArrow(giving_back(over), "id long, node long, n long, parity array<long>, keys array<long>")


def whole_sets(texts: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, tokens) of the wanted (node, id) rows: the sets recomputed from
    their texts.  A bitmap of the wanted rows keeps other texts out of the
    shuffle."""
    stamp = F.xxhash64("node", F.coalesce("id", F.lit(-1)))
    marked = stage(wanted.select("node", F.coalesce("id", F.lit(-1)).alias("id")).withColumn("stamp", stamp), "join-wanted")
    sent = texts.sparkSession.sparkContext.broadcast(membership.build(marked, "stamp", marked.count()))

    def over(batches):
        for ids, sets in _sets(batches, shingle):
            names = nodes_of(sets)
            known = np.array([-1 if i is None else i for i in ids.to_pylist()], dtype=np.int64)
            stamps = np.array([row_stamp(n, i) for n, i in zip(names.tolist(), known.tolist())], dtype=np.uint64)
            at = np.flatnonzero(sent.value.contains(stamps))
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[at]), pa.array(names.view(np.int64)[at]),
                 pa.array([sets[i].view(np.int64) for i in at.tolist()], pa.list_(pa.int64()))],
                names=["id", "node", "tokens"])

    found = texts.mapInArrow(giving_back(over), "id long, node long, tokens array<long>")
    return found.join(marked.select("node", "id"), ["node", "id"], "left_semi").groupBy("node") \
        .agg(F.first("tokens").alias("tokens"))


def row_stamp(node: int, ident: int) -> int:
    """Spark's ``xxhash64(node, id)`` of two longs, as unsigned."""
    seed = xxhash.xxh64_intdigest(node.to_bytes(8, "little"), seed=42)
    return xxhash.xxh64_intdigest((ident & (1 << 64) - 1).to_bytes(8, "little"), seed=seed)


def links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """(a, b) of the proposed (a, b, na, nb) pairs that link."""
    pairs = stage(pairs, "join-passing")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stage(whole_sets(texts, nodes.select("node", "id").join(wanted, "node", "left_semi"), shingle), "join-sets")
    met = pairs.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb")), "b") \
        .withColumn("both", F.size(F.array_intersect("ta", "tb")).cast("long"))
    return met.filter(F.lit(den) * F.col("both") >= F.lit(num) * (F.col("na") + F.col("nb") - F.col("both"))) \
        .select("a", "b")


def may_link(num: int, den: int):
    """Condition on (pa, pb, na, nb): of a linked pair, at most
    ``(na + nb) (den - num) / (den + num)`` shingles are in one set only.
    Sizes differ by less than twice, so one parity is at most twice as long
    as the other; the longer one is folded."""
    def level(long: str, short: str):
        half = F.call_function("div", F.size(long), F.lit(2)).cast("int")
        return F.when(F.size(long) > F.size(short),
                      F.zip_with(F.slice(long, F.lit(1), half), F.slice(long, half + 1, half),
                                 lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(long))

    apart = F.aggregate(F.zip_with(level("pa", "pb"), level("pb", "pa"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                        F.lit(0), lambda t, n: t + n)
    return apart * F.lit(den + num) <= (F.col("na") + F.col("nb")) * F.lit(den - num)


def passing(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, na, nb) of the (a, b) pairs whose sizes, then parities allow a link."""
    size, parity = nodes.select("node", "n"), nodes.select("node", "parity")
    close = pairs.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b").filter(sizes_allow(num, den))
    return close.join(parity.toDF("a", "pa"), "a").join(parity.toDF("b", "pb"), "b").filter(may_link(num, den)) \
        .select("a", "b", "na", "nb")


def sizes_allow(num: int, den: int):
    return F.lit(den) * F.least("na", "nb") >= F.lit(num) * F.greatest("na", "nb")


# Flips that give each class of keys an order of its own for choosing leaders: a set meets a leader
# of each class, so that few sets of a group of near copies stay outside its component.
FLIPS = W.mix64(np.arange(8, dtype=np.uint64)).view(np.int64).tolist()


def shared_keys(nodes: DataFrame) -> DataFrame:
    """Staged (key, node, size, leader, circle) of the keys that two or more
    sets share; the circle of a key is named by the least of its sets."""
    index = nodes.select("node", F.explode("keys").alias("key"))
    flip = F.element_at(F.array(*[F.lit(f).cast("long") for f in FLIPS]), F.pmod("key", F.lit(len(FLIPS))).cast("int") + 1)
    # a key's leader is its least node in the key's order; keys with the same sets (told by two
    # sums over them) say the same, one of them is enough
    lists = index.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.col("node").bitwiseXOR(flip)).alias("low"),
        F.bit_xor(F.xxhash64("node")).alias("mark"), F.sum(F.col("node").bitwiseAND(0xFFFF)).alias("check"),
        F.min("node").alias("circle")) \
        .filter("size > 1").groupBy("size", "mark", "check").agg(F.min(F.struct("key", "low", "circle")).alias("one")) \
        .select("one.key", "one.low", "one.circle", "size")
    return stage(index.join(lists, "key").select("key", "node", "size", F.col("low").bitwiseXOR(flip).alias("leader"),
                                                 "circle"), "join-index")


def folded(parity: np.ndarray, words: int) -> np.ndarray:
    """Parities (one row a set) over fewer places: halves are added up."""
    while parity.shape[1] > words:
        half = parity.shape[1] // 2
        parity = parity[:, :half] ^ parity[:, half:]
    return parity


def block_pairs(node, n, component, parity, first, second, num: int, den: int):
    """(a, b, na, nb) arrays of the pairs between the rows ``first`` and
    ``second`` (arrays of row numbers) that differ in component and whose
    sizes, then parities allow a link.  ``parity``: one array a row."""
    words = np.array([len(p) for p in parity])
    for la in np.unique(words[first]):
        x = first[words[first] == la]
        px = np.stack([parity[i] for i in x])
        for lb in np.unique(words[second]):
            if max(la, lb) > 2 * min(la, lb):          # their sizes are too far apart
                continue
            y = second[words[second] == lb]
            py, least = np.stack([parity[i] for i in y]), min(la, lb)
            fx, fy = folded(px, least), folded(py, least)
            apart = np.zeros((len(x), len(y)), dtype=np.int32)
            for k in range(least):
                apart += np.bitwise_count(fx[:, k][:, None] ^ fy[:, k][None, :])
            na, nb = n[x][:, None], n[y][None, :]
            may = (apart * (den + num) <= (na + nb) * (den - num)) & (den * np.minimum(na, nb) >= num * np.maximum(na, nb)) \
                & (component[x][:, None] != component[y][None, :])
            i, j = np.nonzero(may)
            i, j = x[i], y[j]
            swap = node[i] > node[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            yield node[i], node[j], n[i], n[j]


def circle_pairs(members: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, na, nb) of the pairs that share a circle of the (circle, node,
    size, component) ``members``, differ in component and may link; each pair
    once.

    A circle of more than ``BLOCK`` sets is cut into blocks that meet each
    other; a row carries the parity of its set, not its keys, and goes to as
    many pieces as its circle has blocks.
    """
    parts = F.expr(f"cast((size + {BLOCK - 1}) div {BLOCK} as int)")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    rows = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))) \
        .join(nodes.select("node", "n", "parity"), "node") \
        .select("circle", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "n",
                "component", "parity")

    def answer(i, j, parts):
        own, node, n, component = (np.concatenate([p[k] for p in parts]) for k in range(4))
        parity, at = [x for p in parts for x in p[4]], np.arange(len(node))
        found = list(block_pairs(node, n, component, parity, at if i == j else at[own == i],
                                 at if i == j else at[own == j], num, den))
        columns = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(4)]
        once = np.unique(np.stack(columns), axis=1) if i == j else columns
        return pa.RecordBatch.from_arrays([pa.array(c) for c in once], names=["a", "b", "na", "nb"])

    def over(batches):
        held, piece = [], None                              # parts of one piece: arrays, and views of the parities
        for batch in batches:
            circle, i, j, own, node, n, component = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:7])
            ends, bits = batch.column(7).offsets.to_numpy(), batch.column(7).values.to_numpy(zero_copy_only=False)
            new = np.flatnonzero((np.diff(circle) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            for a, b in zip([0, *new.tolist()], [*new.tolist(), len(circle)]):
                if a == b:
                    continue
                now = int(circle[a]), int(i[a]), int(j[a])
                if held and now != piece:
                    yield answer(*piece[1:], held)
                    held = []
                piece = now
                held.append((own[a:b], node[a:b], n[a:b], component[a:b], [bits[ends[r]:ends[r + 1]] for r in range(a, b)]))
        if held:
            yield answer(*piece[1:], held)

    keys = ["circle", "i", "j"]
    return rows.repartition(*keys).sortWithinPartitions(*keys) \
        .mapInArrow(giving_back(over), "a long, b long, na long, nb long").distinct()


def similar_sets(nodes: DataFrame, texts: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """(node, component) of the nodes that link with another one.

    ``nodes``: staged (node, n, id, parity, keys), one row per distinct set.
    """
    listed = shared_keys(nodes)
    proposed = stage(listed.filter("leader <> node").select(
        F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct(), "join-pairs")
    edges = stage(links(passing(proposed, nodes, num, den), nodes, texts, shingle, num, den), "join-links")
    # keys of three and more sets may hide pairs that no leader was part of; keys with the same
    # least set are one circle, so a set comes once for many keys
    near = connected_components(edges)
    circles = stage(listed.filter("size > 2").select("circle", "node").distinct(), "join-circles")
    placed = circles.join(near, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("circle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                         F.count(F.lit(1)).alias("size")).filter("lo < hi").select("circle", "size")
    open_rows = stage(placed.join(mixed, "circle"), "join-mixed")
    rest = circle_pairs(open_rows, nodes, num, den).join(proposed, ["a", "b"], "left_anti")
    more = links(rest, nodes, texts, shingle, num, den)
    return connected_components(edges.union(more))


def indexed_nodes(docs: DataFrame, id_col: str, text_col: str, shingle: int, num: int, den: int,
                  frequent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, text) of the documents, their staged index rows, and one staged
    row per distinct set."""
    if not den < 2 * num <= 2 * den:
        raise ValueError("the similarity must be above 1/2 and at most 1")
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stage(indexed(texts, shingle, num, den, frequent), "join-rows")
    nodes = stage(rows.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.min("id").alias("id"),
                                                           F.first("parity").alias("parity"),
                                                           F.first("keys").alias("keys")), "join-nodes")
    return texts, rows, nodes


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  num: int = 90, den: int = 100, frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """Every link between different sets as (a, b), a < b, each once, and the
    membership (id, n_shingles, node) of the rows; equal sets are one node
    and link with each other without a row."""
    texts, rows, nodes = indexed_nodes(docs, id_col, text_col, shingle, num, den, frequent)
    circles = stage(shared_keys(nodes).select("circle", "node").distinct(), "join-circles")
    sizes = circles.groupBy("circle").agg(F.count(F.lit(1)).alias("size"))
    members = stage(circles.join(sizes, "circle").withColumn("component", F.col("node")), "join-members")
    found = stage(links(circle_pairs(members, nodes, num, den), nodes, texts, shingle, num, den), "join-all-links")
    return found, rows.select("id", F.col("n").alias("n_shingles"), "node")


def link_counts(docs: DataFrame, **options) -> DataFrame:
    """(id, n_shingles, node, n_links) per row: the number of other sets that
    the row's set links with (see ``jaccard_links``)."""
    found, members = jaccard_links(docs, **options)
    counts = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    return members.join(counts, "node", "left").select(
        "id", "n_shingles", "node", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       num: int = 90, den: int = 100, frequent: int = FREQUENT) -> DataFrame:
    """(id, n_shingles, node, component_id) per row; ``num / den`` (above a
    half) is the similarity that links."""
    texts, rows, nodes = indexed_nodes(docs, id_col, text_col, shingle, num, den, frequent)
    near = similar_sets(nodes, texts, shingle, num, den)
    placed = nodes.select("node", "id").join(near, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    names = placed.select("node", "component").join(least, "component").select("node", "component_id")
    return rows.select("id", "n", "node").join(names, "node", "left").select(
        "id", F.col("n").alias("n_shingles"), "node",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
