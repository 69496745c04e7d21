"""Embedding near-dedup against brute force."""

import numpy as np
import pyarrow as pa
import pytest

from gridlake.llm import embeddings as E
from gridlake.llm.queries import QUERIES, table


def brute(rows, threshold):
    """rows: (id, vector, label) -> sorted (id, n_links, component_id, kept)."""
    def usable(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    good = [usable(v, lab) for _, v, lab in rows]
    links = [set() for _ in rows]
    groups = {}
    for i, (_, v, lab) in enumerate(rows):
        if good[i]:
            groups.setdefault((lab, len(v)), []).append(i)
    for members in groups.values():
        x = E.unit(np.array([rows[i][1] for i in members], dtype=float))
        for a, b in zip(*np.nonzero(x @ x.T >= threshold)):
            if a != b:
                links[members[a]].add(members[b])
    component = [None] * n
    for i in range(n):
        if component[i] is None:
            todo, seen = [i], {i}
            while todo:
                for j in links[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            ids = [rows[j][0] for j in seen if rows[j][0] is not None]
            for j in seen:
                component[j] = (min(ids) if ids else None,)
    return sorted(((r[0], len(links[i]), component[i][0], r[0] == component[i][0]) for i, r in enumerate(rows)), key=str)


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_equals_brute_force(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").collect()]
    got = result(QUERIES["op6_embedding_near_dedup"](spark, sf_dir))
    want = brute(rows, 0.98)
    assert got == want


def test_hot_groups_blocks_and_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 16)
    rng = np.random.default_rng(4)
    base = rng.standard_normal((4, 24))
    rows = [(i, (base[0] + 0.05 * rng.standard_normal(24)).tolist(), 1) for i in range(120)]
    rows += [(200 + i, base[1].tolist(), 1) for i in range(40)]
    rows += [(300 + i, (base[2] + 0.11 * rng.standard_normal(24)).tolist(), 2) for i in range(60)]
    rows += [(400 + i, rng.standard_normal(24).tolist(), 2) for i in range(60)]
    rows += [(500, None, 1), (501, [0.0] * 24, 1), (502, [float("nan")] * 24, 1), (503, [None] * 24, 1),
             (504, [float("inf")] + [1.0] * 23, 1), (505, base[1].tolist(), None), (506, base[1].tolist()[:20], 1),
             (507, [], 1), (None, base[1].tolist(), 1), (508, (base[1] * 3).tolist(), 1), (200, base[1].tolist(), 1),
             (None, rng.standard_normal(24).tolist(), 3), (509, [1e300] * 24, 4), (510, [1e299] * 24, 4)]
    schema = "vec_id long, embedding array<double>, label int, weight int, node string"
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    got = result(E.near_duplicates(df))
    assert got == brute(rows, 0.98)
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x = E.unit(rng.standard_normal((400, 64)))
    y = E.unit(x + 0.5 * rng.standard_normal((400, 64)) / 8)
    f = E.correction(x)
    signs = np.where(x @ E.rotation(64, 0) > 0, 1, -1) / 8
    estimate = ((signs * (y @ E.rotation(64, 0))).sum(axis=1)) / f
    exact = (x * y).sum(axis=1)
    assert abs((estimate - exact).mean()) < 0.01
    assert (np.abs(estimate - exact) <= E.EPSILON * np.sqrt((1 - f * f) / (f * f) / 63)).all()


def sides(x, width=12, bands=6):
    """The stored side (nodes, codes, factors, scales, spreads) of unit vectors."""
    turned = x @ E.rotation(x.shape[1], 0)
    scale = np.abs(turned).max(axis=1) / 127
    return (np.arange(len(x)), np.packbits(E.code_bits(x, width * bands), axis=1), E.correction(x), scale,
            np.rint(turned / scale[:, None]).astype(np.int8))


def test_bounds_from_stored_codes_hold():
    """No pair's bound is below its inner product; most unrelated pairs fall
    below the threshold without their vectors."""
    rng = np.random.default_rng(1)
    x = E.unit(rng.standard_normal((300, 128)))
    y = E.unit(x + rng.uniform(0, 1, (300, 1)) * rng.standard_normal((300, 128)) / 11)
    bounds = E.upper_bounds(sides(x), sides(y))
    assert (bounds >= x @ y.T).all()
    unrelated = ~np.eye(300, dtype=bool)
    assert (bounds[unrelated] >= 0.98).mean() < 0.01


def test_only_open_nodes_fetch_vectors(spark, tmp_path, monkeypatch):
    """One pair of near copies among unrelated vectors that share a bucket:
    the table of rows that fetch a vector holds little else."""
    rng = np.random.default_rng(2)
    x = E.unit(rng.standard_normal((400, 96)))
    x[1] = E.unit(x[:1] + 0.001)[0]
    kept = {}
    real = E.stage
    monkeypatch.setattr(E, "stage", lambda df, label: kept.setdefault(label, real(df, label)))
    nodes = spark.createDataFrame([(i, "a", 96, 1, v.tolist()) for i, v in enumerate(x)],
                                  "node long, label string, dim int, weight long, vector array<double>")
    links = E.near_links(nodes, 2, 3, 0.98).collect()
    assert sorted(r["node"] for r in links) == [0, 1]
    assert {0, 1} <= {r["node"] for r in kept["embedding-open"].collect()}
    assert kept["embedding-open"].count() < 40
    assert {"code", "factor"} <= set(kept["embedding-codes"].columns)


def test_band_keys_spell_the_bits():
    bits = np.random.default_rng(3).random((50, 90)) < 0.5
    keys = E.band_keys(bits, 17, 5)
    for row, got in zip(bits, keys):
        assert [int("".join("1" if v else "0" for v in row[b * 17:(b + 1) * 17]), 2) for b in range(5)] == got.tolist()
    assert E.band_keys(bits[:0], 17, 5).shape == (0, 5)


def test_groups_of_a_batch_are_cut_where_a_name_changes():
    names = [("a", 2, 0, 5, 0, 0)] * 3 + [("b", 2, 0, 5, 0, 0)] + [("b", 3, 0, 5, 0, 0), ("b", 3, 0, 5, 0, 1)]
    columns = [pa.array(c, t) for c, t in zip(zip(*names), E.GROUP_TYPES)]
    codes = pa.array([b"ab", b"cd", b"ef", b"gh", b"ijk", b"lmn"], pa.binary())
    batch = pa.RecordBatch.from_arrays([*columns, codes], names=[*E.GROUP, "code"])
    assert E._cuts(batch) == [0, 3, 4, 5, 6]
    part = batch.slice(1)                                   # a slice keeps the buffers of the whole
    assert E._cuts(part) == [0, 2, 3, 4, 5]
    flat = E._flat(part.column(6))
    assert [E._rows(*flat, a, b).tobytes() for a, b in ((0, 2), (2, 3), (3, 5))] == [b"cdef", b"gh", b"ijklmn"]
    assert E._rows(*flat, 0, 2).shape == (2, 2)
