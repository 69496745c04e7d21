"""The five stages against brute force, and on odd rows."""

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as CP
from gridlake.llm import secret_scan
from gridlake.llm.queries import quality_weights, table, tokenizer_path
from gridlake.llm.staging import stage
from tests.conftest import SF_ORACLE
from tests.llm.test_ngram_join import brute

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, SF_ORACLE, "documents")]
    for name, work in CP.STAGES:
        docs.append(stage(work(spark, docs[-1], SF_ORACLE), f"test-{name}"))
    return docs


def test_stage_order_and_columns(steps):
    assert [n for n, _ in CP.STAGES] == ["toxicity", "near_duplicates", "secrets", "mix", "packing"]
    assert all(d.columns == CP.COLUMNS for d in steps[1:5]) and CP.ORACLE_SQL is None


def test_toxic_documents_go_and_clean_ones_stay(spark, steps):
    labels = table(spark, SF_ORACLE, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = steps[0].join(labels, "doc_id").join(steps[1].select("doc_id", F.lit(1).alias("kept")), "doc_id", "left") \
        .groupBy("toxic", "kept").count().collect()
    n = Counter({(r["toxic"], r["kept"]): r["count"] for r in rows})
    assert n[0, None] <= 0.02 * (n[0, 1] + n[0, None]) and n[1, None] > n[1, 1]


def test_one_document_of_each_group_stays(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[1].collect()]
    want = sorted(i for i, _, c in brute(rows, 5, 8, 10) if i == c)
    assert sorted(r["doc_id"] for r in steps[2].collect()) == want and len(want) < len(rows)


def test_live_secrets_are_replaced(steps):
    before = {r["doc_id"]: r for r in steps[2].collect()}
    after = {r["doc_id"]: r for r in steps[3].collect()}
    found = {r["id"]: r["found"] for r in secret_scan.find_secrets(steps[2]).collect()}
    assert before.keys() == after.keys()
    changed = 0
    for i, r in before.items():
        live = [s for s in found[i] or [] if s["live"]]
        hidden = set()
        for s in live:
            hidden.update(range(s["start"], s["end"]))
        runs = [p for p in hidden if p - 1 not in hidden]
        assert after[i]["text"].count(CP.MARK) - r["text"].count(CP.MARK) <= max(len(runs), len(live))
        assert len(after[i]["text"]) <= len(r["text"]) - len(hidden) + len(CP.MARK) * len(live)
        assert not any(s["live"] and r["text"][s["start"]:s["end"]] in after[i]["text"] for s in live)
        assert after[i]["n_chars"] == len(after[i]["text"])
        changed += bool(live)
        assert live or after[i] == r
    assert changed > 0


def test_short_and_plain_secrets_are_replaced(spark, make_docs):
    plain = {1: "password=hunter2", 2: "token: correcthorsebattery", 3: "secret = 123456", 4: "0123456789" * 3,
             5: "AKIA" + "A" * 16, 6: "abcdef" * 4}
    rows = [(i, f"before {t} after", f"s{i}") for i, t in plain.items()]
    rows += [(10 + i, "set password=changeme first", f"s{i}") for i in range(3)]
    got = {r["doc_id"]: r["text"] for r in CP.redact_secrets(spark, make_docs(rows), "").collect()}
    assert all(got[i] == f"before {CP.MARK} after" for i in plain)
    assert all(got[10 + i] == "set password=changeme first" for i in range(3))


def test_mix_meets_targets_with_whole_words(spark, steps):
    from gridlake.llm.mixing import mix
    sizes = {i: len(WORD.findall(t)) for i, t in steps[3].select("doc_id", "text").collect()}
    taken = Counter()
    for r in steps[4].collect():
        taken[r["doc_id"]] += len(WORD.findall(r["text"]))
    mixed = mix(steps[3], quality=quality_weights(spark, SF_ORACLE)).collect()
    assert {r["id"]: r["taken"] for r in mixed if r["taken"]} == dict(taken)
    assert all(n <= 2 * sizes[i] for i, n in taken.items())


def test_packed_ids_are_those_of_the_mixed_texts(steps):
    exact = Tokenizer.from_file(tokenizer_path())
    want, got = Counter(), Counter()
    for r in steps[4].collect():
        ids = exact.encode(r["text"], add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        for k, (a, b) in enumerate(zip([0, *range(first, len(ids), 2048)], [*range(first, len(ids), 2048), len(ids)])):
            want[r["doc_id"], k, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))] += 1
    for r in steps[5].collect():
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
    assert got == want


def test_run_on_odd_rows(spark, make_docs, odd_rows, scratch):
    folder = scratch("pipeline-in")
    rows = odd_rows + [(9, "the same five words again and again", "a"), (None, None, None),
                       (40, "password = abc123def456 here", "z"), (41, "a text of seven words that is alone", "z")]
    make_docs(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(3, 1, 1), (None, None, None), (9, 1, 0)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    docs = table(spark, folder, "documents")
    kept = CP.drop_near_duplicates(spark, docs, folder)
    got = sorted(str(r["doc_id"]) for r in kept.collect())
    # one each of the copies of "one" and of the same five words; all texts without words stay
    assert got == sorted(["1", "2", "3", "None", "None", "5", "6", "8", "9", "11", "40", "41"])
    assert CP.run(spark, folder).count() > 0
    empty = scratch("pipeline-empty")
    make_docs([]).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert CP.run(spark, empty).count() == 0
