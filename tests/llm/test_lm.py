"""The language model against brute force, and as a distribution."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from gridlake.llm import lm
from gridlake.llm import words as W
from gridlake.llm.queries import QUERIES, table
from tests.conftest import SF_ORACLE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END, BEGIN = "</end>", "<begin>"


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


class Brute:
    def __init__(self, texts):
        self.unigrams, self.grams = Counter(), Counter()
        for t in texts:
            row = split(t) + [END]
            self.unigrams.update(row)
            self.grams.update(zip([BEGIN, *row], row))
        self.n, self.v = sum(self.unigrams.values()), len(self.unigrams)
        self.before = Counter(w for _, w in self.grams)
        self.follow = defaultdict(lambda: [0, 0, 0])
        self.total = Counter()
        for (u, _), c in self.grams.items():
            self.follow[u][min(c, 3) - 1] += 1
            self.total[u] += c
        self.d = self.discounts(self.grams)
        self.dk = self.discounts(self.before)
        cc = Counter(min(c, 3) for c in self.before.values())
        self.gamma = sum(self.dk[i] * cc[i] for i in (1, 2, 3)) / max(len(self.grams), 1) if self.grams else 1.0

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        if not n[1] or not n[2]:
            return [0, .5, .5, .5]
        y = n[1] / (n[1] + 2 * n[2])
        d = [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        return [min(max(x, 0), i) for i, x in enumerate(d)]

    def p(self, u, w):
        k, c = self.before[w], self.grams[u, w]
        p1 = (k - self.dk[min(k, 3)]) / max(len(self.grams), 1) + self.gamma / (self.v + 1)
        if not self.total[u]:
            return p1
        left = sum(self.d[i + 1] * f for i, f in enumerate(self.follow[u])) / self.total[u]
        return (c - self.d[min(c, 3)]) / self.total[u] + left * p1

    def score(self, text):
        row = split(text) + [END]
        base = sum(math.log10((self.unigrams[w] + .5) / (self.n + .5 * (self.v + 1))) for w in row)
        return (len(row), sum(self.unigrams[w] > 0 for w in row), self.n, base,
                sum(math.log10(self.p(u, w)) for u, w in zip([BEGIN, *row], row)))


def check(got, want):
    assert got[:3] == want[:3]
    assert got[3] == pytest.approx(want[3], rel=1e-9) and got[4] == pytest.approx(want[4], rel=1e-5)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_ORACLE, "documents").select("doc_id", "text").collect()]
    model = Brute([t for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1])
    got = {r["doc_id"]: r for r in QUERIES["op8_kneser_ney_lm"](spark, SF_ORACLE).collect()}
    assert len(got) == len(rows)
    gain = 0
    for i, t in rows:
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1)
        check(tuple(r)[2:], model.score(t))
        gain += (r["score"] - r["base_score"]) * r["held_out"]
    assert gain > 0


def test_probabilities_sum_to_one():
    model = Brute(["a b a c", "a b", "c c d a", "b"])
    for u in [BEGIN, "a", "b", "zzz"]:
        assert sum(model.p(u, w) for w in [*model.unigrams, "unknown"]) == pytest.approx(1.0)


def test_edge_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    model = lm.train(docs)
    want = Brute([t for _, t, _ in odd_rows])
    got = sorted((tuple(r) for r in lm.score_documents(docs, model).collect()), key=str)
    for g, w in zip(got, sorted(((i, *want.score(t)) for i, t, _ in odd_rows), key=str)):
        assert g[0] == w[0]
        check(g[1:], w[1:])
    assert lm.score_documents(make_docs([]), model).count() == 0
    nothing = lm.score_documents(docs, lm.train(make_docs([]))).collect()
    assert all(r["score"] == 0.0 and r["train_tokens"] == 0 for r in nothing)


class Brute3(Brute):
    """Order 3 over continuation counts of bigrams."""

    def __init__(self, texts):
        super().__init__(texts)
        self.tris = Counter()
        for t in texts:
            row = split(t) + [END]
            self.tris.update(zip([BEGIN, BEGIN, *row], [BEGIN, *row], row))
        self.grams = Counter((u, w) for _, u, w in self.tris)
        self.follow, self.total = defaultdict(lambda: [0, 0, 0]), Counter()
        for grams in (self.grams, self.tris):
            for (*u, _), c in grams.items():
                u = u[0] if len(u) == 1 else tuple(u)
                self.follow[u][min(c, 3) - 1] += 1
                self.total[u] += c
        self.d, self.d3 = self.discounts(self.grams), self.discounts(self.tris)

    def p3(self, t, u, w):
        c, total = self.tris[t, u, w], self.total[t, u]
        if not total:
            return self.p(u, w)
        left = sum(self.d3[i + 1] * f for i, f in enumerate(self.follow[t, u]))
        return (c - self.d3[min(c, 3)] + left * self.p(u, w)) / total

    def score(self, text):
        row = split(text) + [END]
        return (*super().score(text)[:4], sum(math.log10(self.p3(t, u, w)) for t, u, w in
                                              zip([BEGIN, BEGIN, *row], [BEGIN, *row], row)))


def test_order_three_equals_brute_force(spark, make_docs, odd_rows):
    texts = ["a b a c", "a b a b", "c c d a", "b a c c d", "a b a c d a b", "d a b a c"]
    rows = odd_rows + [(50 + i, t, "a") for i, t in enumerate(texts)]
    docs, want = make_docs(rows), Brute3([t for _, t, _ in rows])
    model = lm.train(docs, order=3)
    got = sorted((tuple(r) for r in lm.score_documents(docs, model).collect()), key=str)
    for g, w in zip(got, sorted(((i, *want.score(t)) for i, t, _ in rows), key=str)):
        assert g[0] == w[0]
        check(g[1:], w[1:])
    for t, u in [(BEGIN, BEGIN), (BEGIN, "a"), ("a", "b"), ("zzz", "b")]:
        assert sum(want.p3(t, u, w) for w in [*want.unigrams, "unknown"]) == pytest.approx(1.0)
    nothing = lm.score_documents(docs, lm.train(make_docs([]), order=3)).collect()
    assert all(r["score"] == 0.0 for r in nothing)


def test_packing_round_trip():
    a = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000).astype(np.uint64))
    b = np.arange(1000, dtype=np.uint64)
    x, y = lm.unpack(lm.pack(a, b), 2)
    assert (x == a).all() and (y == b).all()
    w = W.words(pa.array(["x y", "", None, "z"], pa.string()))
    token, context, owner = lm.tokens(w)
    assert owner.tolist() == [0, 0, 0, 1, 2, 3, 3] and (context[[0, 3, 4, 5]] == lm.BEGIN).all()
    assert (token[[2, 3, 4, 6]] == lm.END).all()


def test_counts_are_stored_exactly(tmp_path):
    big = np.array([1, 2 ** 24 + 1, 2 ** 40 + 3], dtype=np.uint64)
    small = np.array([0, 7, 2 ** 24], dtype=np.uint64)
    keys = np.array([3, 5, 9], dtype=np.uint64)
    name = lm.write_arrays(str(tmp_path), "grams", keys, lm.exact(big), lm.exact(small))
    assert name.endswith(".u8f8f4")
    got = lm.mapped(str(tmp_path), name, 3)
    assert [g.astype(np.uint64).tolist() for g in got] == [keys.tolist(), big.tolist(), small.tolist()]


def test_shards_follow_the_text(spark, make_docs, monkeypatch):
    """The shards of a corpus hold a bounded share of it, whatever the
    session's partitions, and a model of many shards scores as one of one."""
    assert [lm.shard_bits(n) for n in (0, 1, lm.SHARD_BYTES, lm.SHARD_BYTES + 1, 1000 * lm.SHARD_BYTES)] == [0, 0, 0, 1, 10]
    docs = make_docs([(i, "the " * 30 + " ".join(f"w{(i * j) % 301}" for j in range(40)), "a") for i in range(60)])
    one = lm.train(docs)
    monkeypatch.setattr(lm, "SHARD_BYTES", 500)
    many = lm.train(docs)
    assert one.log_shards == 0 and many.log_shards == 6
    rows = [n for (kind, _), (_, n) in many.files.items() if kind == "gram"]
    assert sum(rows) == one.files["gram", 0][1] and max(rows) <= 3 * sum(rows) / 64
    a, b = ([tuple(r) for r in lm.score_documents(docs, m).orderBy("id").collect()] for m in (one, many))
    for x, y in zip(a, b, strict=True):
        check(x[1:], y[1:])
