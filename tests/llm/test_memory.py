"""What Python workers are sent."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as CP
from gridlake.llm import memory, ngram_join, packing, secret_scan, toxicity
from gridlake.llm.queries import tokenizer_path

WORK = {
    "score": lambda spark, docs: toxicity.score_documents(docs, spark.createDataFrame([(-1, 0.5)], "place long, weight double")),
    "train": lambda spark, docs: toxicity.train(docs, docs.select("doc_id", F.expr("cast(doc_id % 2 as int)").alias("toxic")), epochs=1),
    "join": lambda spark, docs: ngram_join.jaccard_components(docs),
    "scan": lambda spark, docs: secret_scan.find_secrets(docs),
    "redact": lambda spark, docs: CP.redact_secrets(spark, docs, ""),
    "pack": lambda spark, docs: packing.token_pieces(docs, tokenizer_path()),
}


def sent(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "b"])


def sizes(spark, rows: int) -> tuple[int, int]:
    """Rows in all and bytes of the largest batch, of 4 KB texts."""
    wide = spark.range(0, rows, 1, 1).select(F.repeat(F.lpad(F.col("id").cast("string"), 8, "0"), 512).alias("text"))
    return tuple(wide.mapInArrow(sent, "n long, b long").agg(F.sum("n"), F.max("b")).first())


@pytest.mark.parametrize("name", WORK)
def test_an_operator_is_sent_small_batches(spark, name):
    """Of the default 10,000 rows, these would be one batch of 16 MB."""
    session = spark.newSession()
    docs = session.createDataFrame([(i, f"word {i} of a text {i % 3}", "en", "s", 9) for i in range(8)],
                                   "doc_id long, text string, lang string, source string, n_chars long")
    WORK[name](session, docs).count()
    n, most = sizes(session, 4000)
    assert n == 4000 and most < 2 * memory.BATCH_BYTES


@pytest.mark.parametrize("given, kept", [("100k", "100k"), ("64m", None), ("67108864b", None), ("1g", None)])
def test_a_smaller_bound_stays(spark, given, kept):
    session = spark.newSession()
    session.conf.set(memory.BATCH_CONF, given)
    memory.small_batches(session.range(1))
    assert memory.in_bytes(session.conf.get(memory.BATCH_CONF)) == memory.in_bytes(kept or str(memory.BATCH_BYTES))


def test_a_text_above_the_bound_is_sent_whole(spark):
    text = "".join(chr(97 + i % 26) for i in range(3 * memory.BATCH_BYTES)) + " password=abcdef0123"
    docs = spark.createDataFrame([(1, text, "s"), (2, None, "s"), (3, "password=abcdef0123", "s")],
                                 "doc_id long, text string, source string").coalesce(1)
    found = {r["id"]: r for r in secret_scan.scan(docs, "doc_id", "text", "source").collect()}
    assert [found[i]["n_assign"] for i in (1, 2, 3)] == [1, 0, 1]
    assert found[1]["spans"][0]["start"] == len(text) - 19
