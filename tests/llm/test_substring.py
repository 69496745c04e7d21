"""Substring dedup against brute force."""

import hashlib
import re

import pyarrow as pa

from gridlake.llm import words as W
from gridlake.llm.queries import QUERIES, table
from gridlake.llm.substring import dedup_substrings, text_marks
from tests.conftest import SF_ORACLE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """rows: (doc_id, text); ids not null count, rows of one id together."""
    first = {}
    for ident, text in rows:
        if ident is None:
            continue
        w = WORD.findall(text or "")
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, ident), ident)
    out = []
    for ident, text in rows:
        w = WORD.findall(text or "")
        gone = set()
        for i in range(len(w) - window + 1):
            if ident is not None and first[tuple(w[i:i + window])] < ident:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((ident, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r)[:4] for r in df.collect()], key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_ORACLE, "documents").select("doc_id", "text").collect()]
    got = result(QUERIES["op9_substring_dedup"](spark, SF_ORACLE))
    want = brute(rows, 50)
    assert got == want and sum(r[2] for r in want) > 1000


def test_hot_passage_and_edge_rows(make_docs, odd_rows):
    passage = " ".join(f"p{i}" for i in range(9))
    rows = odd_rows + [(100 + i, f"own{i} {passage} tail{i} " + ("a b a b a b a b" if i % 2 else ""), "h")
                       for i in range(60)] + [(100, "another text of an id that is there already", "h")]
    docs = make_docs(rows)
    got = result(dedup_substrings(docs, window=6))
    assert got == brute([(i, t) for i, t, _ in rows], 6)
    assert dedup_substrings(make_docs([]), window=6).count() == 0
    kept = {r["id"]: r["kept_text"] for r in dedup_substrings(docs, window=6).collect()}
    assert kept[101].startswith("own1 tail1")


def test_marks_do_not_depend_on_the_batch():
    """A text's mark is the same beside other texts, wherever it stands."""
    texts = [" ".join(f"w{(i * j) % 91}" for j in range(20 + i)) for i in range(60)] + ["", "one"]
    alone = [int(text_marks(W.words(pa.array([t])))[0]) for t in texts]
    assert text_marks(W.words(pa.array(texts))).tolist() == alone
    assert text_marks(W.words(pa.array(texts[::-1]))).tolist() == alone[::-1]
    assert len(set(alone)) == len(set(texts))


def test_rows_that_move_between_batches(spark, make_docs):
    """Many partitions and a hot passage: texts are marked in one order and met in another."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"own{i} {passage if i % 3 == 0 else ' '.join(f'q{i}x{k}' for k in range(40))} tail{i}", "h")
            for i in range(900)] + [(1000 + i, f"{passage} {passage}", "h") for i in range(100)]
    docs = make_docs(rows).repartition(13)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = result(dedup_substrings(docs, with_text=False))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert got == brute([(i, t) for i, t, _ in rows], 50)
