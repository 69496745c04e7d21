"""Token counts, fingerprints, toxicity: against brute force and held-out rows."""

import hashlib
import math
import os
import random
import re
import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlake.llm import fingerprints as FP
from gridlake.llm import token_counts as TC
from gridlake.llm import toxicity as TX
from gridlake.llm.queries import QUERIES, held_out, table, tokenizer_path
from tests.conftest import SF_ORACLE


def greedy(word, pieces):
    n, i = 0, 0
    while i < len(word):
        j = next((j for j in range(len(word), i, -1) if word[i:j] in pieces), None)
        if j is None:
            return 0
        n, i = n + 1, j
    return n


def test_automaton_equals_greedy_longest_match():
    rng = random.Random(5)
    for _ in range(200):
        pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        counter = TC.PieceCounter(sorted(pieces))
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            assert counter.count(word) == greedy(word, pieces)


def test_token_counts_edge_rows(spark, make_docs, odd_rows):
    pieces = set(TC.byte_level_pieces(tokenizer_path()))
    got = TC.token_counts(make_docs(odd_rows), tokenizer_path()).collect()
    assert len(got) == len(odd_rows)
    want = sorted((i or -1, len((t or "").split()), sum(greedy(b" " + w.encode(), pieces) for w in (t or "").split()), 0)
                  for i, t, _ in odd_rows)
    assert sorted((r[0] or -1, *r[1:]) for r in got) == want
    assert TC.token_counts(make_docs([]), tokenizer_path()).count() == 0


def test_fingerprint_query_equals_brute_force(spark):
    rows = sorted(table(spark, SF_ORACLE, "documents").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in QUERIES["op3_scaled_fingerprints"](spark, SF_ORACLE).collect()}
    assert len(got) == len(rows)
    for i, (ident, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        r = got[ident]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == FP.encode(brute_sketch(text))
        assert r["edited_fingerprint"] == FP.encode(brute_sketch(edited))
        assert r["near_next"] == pytest.approx(jac(brute_sketch(text), brute_sketch(after)))
        assert r["near_edited"] == pytest.approx(jac(brute_sketch(text), brute_sketch(edited)))


def brute_sketch(text):
    import pyarrow as pa
    return FP.sketches(pa.array([text], pa.string()))[0]


def jac(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    if a == b:
        return 1.0
    a, b = ({x for x in s if x < 1 << 47} for s in (a, b))
    return len(a & b) / min(len(a), len(b)) if a and b else 0.0


def test_sketch_round_trip_and_merge():
    import pyarrow as pa
    a, b = (" ".join(f"{p}{i}" for i in range(400)) for p in "xy")
    sa, sb = brute_sketch(a), brute_sketch(b)
    assert FP.decode(FP.encode(sa)).tolist() == sa.tolist()
    union = FP.merge([sa, sb])
    assert set(union.tolist()) == set(sa.tolist()) | set(sb.tolist())
    assert 140 < len(sa) < 260                    # about 396 / 2
    assert len(FP.sketches(pa.array(["one"], pa.string()))[0]) == 1


@pytest.mark.parametrize("length,most_missed,error", [(5, 0.7, 0.0), (8, 0.2, 0.0), (12, 0.05, 0.0), (24, 0.0, 0.0)])
def test_short_text_inside_a_long_one_is_contained(make_docs, length, most_missed, error):
    """Sketches of texts of 1, 4, 8 and 20 shingles: contained (1), or without a hash to compare (0)."""
    rng = random.Random(length)
    rows, missed = [], []
    for i in range(0, 160, 2):
        words = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
        rows += [(i, " ".join(words[500:500 + length]), "a"), (i + 1, " ".join(words), "a")]
    got = {r["id"]: r for r in FP.fingerprint_documents(make_docs(rows)).collect()}
    for i, text, _ in rows[::2]:
        bare = FP.below(brute_sketch(text)).size == 0
        missed.append(bare)
        assert got[i]["near_next"] == (0.0 if bare else 1.0 - error)
        assert got[i]["near_next"] == FP.containment(FP.decode(got[i]["fingerprint"]), FP.decode(got[i + 1]["fingerprint"]))
    assert sum(missed) <= most_missed * len(missed)


@pytest.mark.parametrize("length", [30, 100, 400])
def test_containment_error_by_length(make_docs, length):
    """Texts of which a part lies in the next one: estimates against exact shingle sets."""
    rng = random.Random(length)
    rows, exact = [], {}
    for i in range(0, 120, 2):
        part = rng.randrange(5, length)
        words = [f"w{rng.randrange(10**6)}" for _ in range(length)]
        after = words[:part] + [f"v{rng.randrange(10**6)}" for _ in range(1500)]
        rows += [(i, " ".join(words), "a"), (i + 1, " ".join(after), "a")]
        exact[i] = (part - 4) / (length - 4)
    got = {r["id"]: r["near_next"] for r in FP.fingerprint_documents(make_docs(rows)).collect()}
    errors = [abs(got[i] - c) for i, c in exact.items()]
    assert sum(errors) / len(errors) < 0.5 / (length - 4) ** 0.5 and max(errors) < 2.0 / (length - 4) ** 0.5


def test_fingerprint_edge_rows(make_docs, odd_rows):
    got = FP.fingerprint_documents(make_docs(odd_rows)).collect()
    assert sorted((r["id"] or -1, r["n_chars"]) for r in got) == sorted((i or -1, len(t or "")) for i, t, _ in odd_rows)
    same = [r["fingerprint"] for r in got if r["id"] in (9, 10)]
    assert same[0] == same[1]
    alone = FP.fingerprint_documents(make_docs([(4, "just one text of more than five words", "a")])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert FP.fingerprint_documents(make_docs([])).count() == 0


def ftrl_by_the_formula(rows, labels, epochs, alpha, beta, l1, l2, min_rows):
    """Weight of each feature, one coordinate at a time; None is the intercept."""
    held = {}
    for r in rows:
        for f in r:
            held[f] = held.get(f, 0) + 1
    z, n = {}, {}

    def weight(f):
        penalty = 0.0 if f is None else l1
        if abs(z.get(f, 0.0)) <= penalty:
            return 0.0
        return -(z[f] - math.copysign(penalty, z[f])) / ((beta + math.sqrt(n[f])) / alpha + l2)

    for _ in range(epochs):
        for r, y in zip(rows, labels):
            here = {f: weight(f) for f in [*(f for f in r if held[f] >= min_rows), None]}
            g = 1 / (1 + math.exp(-sum(here.values()))) - y
            for f, w in here.items():
                old = n.get(f, 0.0)
                n[f] = old + g * g
                z[f] = z.get(f, 0.0) + g - (math.sqrt(n[f]) - math.sqrt(old)) / alpha * w
    return {f: weight(f) for f in z}


@pytest.mark.parametrize("l1", [0.0, 0.3, 2.0])
def test_ftrl_equals_the_formula(l1):
    rng = random.Random(8)
    rows = [sorted(rng.sample(range(40), rng.randint(0, 12))) + [100 + i] for i in range(60)]
    labels = [float(3 in r or rng.random() < 0.2) for r in rows]
    args = (4, 0.5, 1.0, l1, 1e-3, 2)
    places, weights, intercept = TX.ftrl([np.array(r, np.int32) for r in rows], np.array(labels), *args)
    want = ftrl_by_the_formula(rows, labels, *args)
    assert intercept == pytest.approx(want.pop(None), abs=1e-9)
    want = {f: w for f, w in want.items() if w}
    assert dict(zip(places.tolist(), weights.tolist())) == pytest.approx(want, abs=1e-9)
    assert max(want, default=0) < 100                       # places of a single row are left out


def test_a_shard_holds_its_features_once():
    """With the rows before and after the filter side by side, or the weights of all places at once, a
    worker holds some 150 MB here."""
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 1 << TX.BITS, 4000)).astype(np.int32) for _ in range(1500)]
    held = sum(r.nbytes for r in rows) + 2 * 8 * (1 << TX.BITS)
    tracemalloc.start()
    try:
        TX.ftrl(rows, (np.arange(1500) % 2).astype(float), 1, 0.5, 1.0, 4.0, 1e-3, 1)
        assert tracemalloc.get_traced_memory()[1] < held + (60 << 20)
    finally:
        tracemalloc.stop()
    assert not rows


def test_ftrl_trains_in_the_given_order():
    rows, labels = [np.array(r, np.int32) for r in ([1, 2], [2, 3], [1, 3], [4])], np.array([1.0, 0.0, 0.0, 1.0])
    args, order = (3, 0.5, 1.0, 0.1, 1e-3, 1), np.array([2, 0, 3, 1])
    want = TX.ftrl([rows[i] for i in order], labels[order], *args)
    got = TX.ftrl(list(rows), labels, *args, order)
    assert all(np.array_equal(a, b) for a, b in zip(got, want))


IDLE = """
import numpy as np, pyarrow as pa, re
from pyspark.sql import SparkSession
from gridlake.llm import toxicity as TX

def held(batches):
    list(batches)
    found = re.findall(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())
    yield pa.RecordBatch.from_arrays([pa.array([sum(map(int, found)) // 1024])], names=["mb"])

spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
rng = np.random.default_rng(4)
rows = [(i, " ".join(map(str, rng.integers(0, 20000, 300))), i % 2) for i in range(6000)]
docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
TX.train(docs, docs.select("doc_id", "toxic"), epochs=1).count()
print("HELD", spark.range(1).mapInArrow(held, "mb long").first()["mb"])
"""


def test_training_leaves_no_memory_in_an_idle_worker(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = os.environ | {"PYTHONPATH": os.pathsep.join([root, os.environ.get("PYTHONPATH", "")]), "PYSPARK_PYTHON": sys.executable}
    ran = subprocess.run([sys.executable, "-c", IDLE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert int(re.search(r"HELD (\d+)", ran.stdout)[1]) < 100


def test_scores_are_the_sum_of_distinct_features(spark, make_docs, odd_rows):
    texts = [(100 + i, f"bad words {i % 3} and bad words again " * (i + 1), "s") for i in range(12)]
    docs = make_docs(odd_rows + texts)
    labels = spark.createDataFrame([(100 + i, int(i % 3 == 0)) for i in range(12)], "doc_id long, toxic int")
    model = TX.train(docs, labels, l1=0.1)
    weight = {r["place"]: r["weight"] for r in model.collect()}
    assert len(weight) > 1
    for r in TX.score_documents(docs, model).collect():
        found = TX.features(pa.array([r["text"]], pa.string()))[0] if r["text"] else []
        margin = weight[TX.INTERCEPT] + sum(weight.get(int(f), 0.0) for f in found)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-5)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    scored = QUERIES["op1_toxicity"](spark, sf)
    toxic = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = scored.filter("held_out").join(toxic, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in rows}
    assert n.get((1, 1), 0) >= 0.7 * (n.get((1, 1), 0) + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * (n.get((0, 0), 0) + n.get((0, 1), 0))


def test_toxicity_edge_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    labels = spark.createDataFrame([(3, 1), (3, None), (9, 0), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = TX.train(docs, labels)
    got = TX.score_documents(docs, model).collect()
    assert len(got) == len(odd_rows) and all(0.0 <= r["score"] <= 1.0 for r in got)
    assert TX.score_documents(make_docs([]), model).count() == 0
    untrained = TX.score_documents(docs, TX.train(docs, labels.filter("false"))).collect()
    assert {r["score"] for r in untrained} == {0.0}


def test_held_out_fold(spark):
    import zlib
    rows = spark.createDataFrame([(i,) for i in range(50)], "doc_id long").select("doc_id", held_out(3).alias("h"))
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows.collect())
