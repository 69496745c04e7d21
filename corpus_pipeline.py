"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage
before kept; all but the last return the columns of ``documents``.  ``run``
writes every stage as Parquet below the shared folder and reads it back.

* toxicity: documents that score 0.7 or more go;
* near_duplicates: 5-word shingles, Jaccard 0.8 or more; of each group the
  document with the smallest id stays;
* secrets: live secrets (all but widely copied examples) are replaced by a
  mark, documents stay;
* mix: documents are repeated, kept or left out (one per source is cut) to
  meet the sources' targets;
* packing: token pieces of at most 2048 in as few sequences as possible.

Rows are told apart by a hash of all their columns, so null or repeated
ids are safe; rows that are equal in every column are one document for
near_duplicates, and share evenly (rounded down) what mix takes of them.
Null texts are empty, score low, link with nothing, hold no secrets and
have size 0, so mix leaves them out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.llm import mixing, ngram_join, packing, secret_scan, toxicity
from gridlake.llm.memory import give_back, small_batches
from gridlake.llm.queries import learnable, quality_weights, table, tokenizer_path
from gridlake.llm.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REJECT = 0.7
MARK = "[secret]"


def keyed(docs: DataFrame) -> DataFrame:
    """The columns of ``documents`` and ``row_key``, a hash of all of them."""
    null = F.array(*[F.col(c).isNull() for c in COLUMNS])
    return docs.select(*COLUMNS).withColumn("row_key", F.xxhash64(*COLUMNS, null))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, learnable(table(spark, sf_dir, "labels"), 3))
    scored = toxicity.score_documents(docs.select(*COLUMNS), model, out_col="toxicity")
    return scored.filter(F.col("toxicity") < REJECT).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = keyed(docs)
    joined = ngram_join.jaccard_components(rows, id_col="row_key", shingle=5, num=8, den=10)
    placed = stage(joined.filter("n_shingles > 0").groupBy("id", "component_id").agg(F.count(F.lit(1)).alias("copies")),
                   "pipeline-groups")
    ids = rows.select("doc_id", F.col("row_key").alias("id")).distinct()
    first = placed.join(ids, "id").groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id"))["id"].alias("first"))
    dropped = stage(placed.join(first, "component_id").filter("id <> first").select(F.col("id").alias("row_key")),
                    "pipeline-dropped")
    kept = rows.join(dropped, "row_key", "left_anti")
    repeated = stage(placed.filter("copies > 1").select(F.col("id").alias("row_key")), "pipeline-repeated")
    if repeated.isEmpty():
        return kept.select(*COLUMNS)
    return kept.join(repeated, "row_key", "left_anti") \
        .union(kept.join(repeated, "row_key", "left_semi").dropDuplicates(["row_key"])).select(*COLUMNS)


def redacted(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Each text with its (start, end) spans, merged where they overlap,
    replaced by the mark."""
    out = []
    for text, found in zip(texts.to_pylist(), spans.to_pylist()):
        parts, at = [], 0
        for s in sorted(found or [], key=lambda s: s["start"]):
            if s["start"] >= at:
                parts += [text[at:s["start"]], MARK]
            at = max(at, s["end"])
        out.append(text if text is None else "".join([*parts, text[at:]]))
    return pa.array(out, pa.string())


@F.arrow_udf(T.StringType())
def redact(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, spans in batches:
        yield redacted(texts, spans)
    give_back()


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = keyed(docs)
    found = secret_scan.find_secrets(rows, id_col="row_key")
    live = F.transform(F.filter("found", lambda s: s["live"]), lambda s: F.struct(s["start"], s["end"]))
    spans = stage(found.filter("n_live > 0").select(F.col("id").alias("row_key"), live.alias("spans"))
                  .dropDuplicates(["row_key"]), "pipeline-secrets")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.col("clean"))
    return small_batches(rows).join(spans, "row_key", "left").withColumn("clean", redact("text", "spans")).select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.char_length("clean").cast("long")).alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = keyed(docs)
    size = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)).cast("long")
    sized = rows.select(F.col("doc_id").alias("id"), "source", size.alias("size"), "row_key")
    mixed = mixing.mix_sized(sized, quality_weights(spark, sf_dir))
    taken = stage(mixed.groupBy("row_key").agg(F.first("size").alias("size"),
                                               F.expr("sum(taken) div count(1)").alias("taken"))
                  .filter("taken > 0"), "pipeline-taken")
    full = F.expr("repeat_full").cast("int")
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0)), F.lit(1), F.col("words")), " ")
    parts = F.concat(F.array_repeat(F.lit(0), full),
                     F.when(F.col("rest") > 0, F.array(F.col("rest"))).otherwise(F.array().cast("array<int>")))
    return rows.join(taken, "row_key") \
        .withColumn("repeat_full", F.expr("taken div size")) \
        .withColumn("rest", F.expr("cast(taken % size as int)")) \
        .withColumn("words", F.explode(parts)) \
        .withColumn("new_text", F.when(F.col("words") > 0, cut).otherwise(F.col("text"))) \
        .select("doc_id", F.col("new_text").alias("text"), "lang", "source",
                F.when(F.col("words") > 0, F.char_length("new_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("secrets", redact_secrets),
          ("mix", mix_sources), ("packing", pack_sequences)]

#: No SQL: the stages train, join by similarity, scan and pack; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
