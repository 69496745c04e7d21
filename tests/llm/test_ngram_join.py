"""N-gram Jaccard join against brute force."""

import random
import re

import numpy as np
import pytest

from gridlake.llm import ngram_join as NJ
from gridlake.llm.components import connected_components
from gridlake.llm.queries import QUERIES, table
from tests.conftest import SF_ORACLE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, num, den):
    """All pairs of rows, then components by repeated relabelling."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * den >= max(len(a), len(b)) * num:
                both = len(a & b)
                if den * both >= num * (len(a) + len(b) - both):
                    parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (ident, _) in enumerate(rows):
        if ident is not None:
            r = find(i)
            least[r] = min(least.get(r, ident), ident)
    return sorted(((ident, len(sets[i]), least.get(find(i)) if sets[i] else ident) for i, (ident, _) in enumerate(rows)), key=str)


def result(df):
    return sorted([(r["id"], r["n_shingles"], r["component_id"]) for r in df.collect()], key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_ORACLE, "documents").select("doc_id", "text").collect()]
    got = sorted([tuple(r) for r in QUERIES["op7_ngram_jaccard_join"](spark, SF_ORACLE).collect()], key=str)
    assert got == brute(rows, 3, 90, 100)
    assert len({r[2] for r in got}) < len(got)


@pytest.mark.parametrize("num,den,k", [(8, 10, 5), (90, 100, 3)])
def test_near_copies_and_edge_rows(make_docs, odd_rows, num, den, k):
    rng = random.Random(num)
    rows = [(i, t, s) for i, t, s in odd_rows]
    for g, size in ((0, 40), (1, 12), (2, 25)):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range((60, 300, 14)[g])]
        for c in range(size):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"new{rng.randint(0, 10**6)}"
            rows.append((1000 * (g + 1) + c, " ".join(words), "g"))
    got = result(NJ.jaccard_components(make_docs(rows), shingle=k, num=num, den=den))
    assert got == brute([(i, t) for i, t, _ in rows], k, num, den)


def test_frequent_classes_give_the_same_links(make_docs):
    """All shingles frequent: only pairs and long-set singles are left."""
    rng = random.Random(3)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randint(0, 10**6)}" for _ in range((20, 60, 200, 225, 245, 400)[g])]
        for c in range(6):
            words = list(base)
            for _ in range(rng.randint(0, 1 + len(words) // 50)):
                words[rng.randrange(len(words))] = f"new{rng.randint(0, 10**6)}"
            rows.append((100 * g + c, " ".join(words), "g"))
    got = result(NJ.jaccard_components(make_docs(rows), frequent=0))
    assert got == brute([(i, t) for i, t, _ in rows], 3, 90, 100)


def test_every_link_between_different_sets_is_given(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(NJ, "BLOCK", 7)
    rng = random.Random(8)
    rows = [(i, t, s) for i, t, s in odd_rows]
    base = [f"w{i}" for i in range(80)]
    for c in range(30):
        words = list(base)
        words[rng.randrange(80)] = f"new{c % 20}"
        rows.append((1000 + c, " ".join(words), "g"))
    sets = [shingles(t, 3) for _, t, _ in rows]
    distinct = set(sets) - {frozenset()}
    linked = {x: sum(x != y and 100 * len(x & y) >= 90 * len(x | y) for y in distinct) for x in distinct}
    docs = make_docs(rows)
    found, members = NJ.jaccard_links(docs)
    pairs = [tuple(r) for r in found.collect()]
    assert len(pairs) == len(set(pairs)) == sum(linked.values()) // 2 > 0 and all(a < b for a, b in pairs)
    got = sorted(((r["id"], r["n_shingles"], r["n_links"]) for r in NJ.link_counts(docs).collect()), key=str)
    assert got == sorted(((i, len(s), linked.get(s, 0)) for (i, _, _), s in zip(rows, sets)), key=str)
    assert members.count() == len(rows)


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(1)
    for frequent in (0, 1, 9):
        classes = rng.integers(0, frequent + 1, 1 << 12).astype(np.uint8)
        for n in (9, 30, 210, 240, 262, 270, 900):
            x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64) << np.uint64(1))
            drop = rng.permutation(len(x))[:int(0.05 * len(x))]
            y = np.unique(np.concatenate([np.delete(x, drop), rng.integers(0, 2**63, len(drop)).astype(np.uint64)]))
            both, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
            if 100 * both >= 90 * union:
                keys = [NJ.index_keys(s, classes, 90, 100) for s in (x, y)]
                assert len(np.intersect1d(*keys))


def test_parities_bound_the_difference(spark):
    """The condition never drops a linked pair, across all size steps."""
    rng = np.random.default_rng(2)
    rows = []
    for n in (9, 500, 1000, 1024, 1030, 1100, 2050, 5000):
        for change in (0.0, 0.02, 0.05, 0.5):
            x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            y = np.unique(np.concatenate([x[int(change * n):], rng.integers(0, 2**63, int(change * n / 2)).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            linked = 100 * both >= 90 * (len(x) + len(y) - both)
            px, py = NJ.parities(x, 90, 100), NJ.parities(y, 90, 100)
            rows.append((px.tolist(), py.tolist(), len(x), len(y), linked, change))
    df = spark.createDataFrame(rows, "pa array<long>, pb array<long>, na long, nb long, linked boolean, change double")
    for r in df.withColumn("may", NJ.may_link(90, 100)).collect():
        assert r["may"] or not r["linked"]
        assert not (r["may"] and r["change"] == 0.5 and r["na"] > 100)


def test_row_stamp_is_sparks_hash(spark):
    rows = [(0, 0), (-5, 7), (2**62, -1), (-2**63, 2**63 - 1)]
    df = spark.createDataFrame(rows, "node long, id long").selectExpr("node", "id", "xxhash64(node, id) AS h")
    for r in df.collect():
        assert NJ.row_stamp(r["node"] & (1 << 64) - 1, r["id"]) == r["h"] & (1 << 64) - 1


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(30)] + [(500, 501), (501, 500)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(30)} | {500: 500, 501: 500}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
