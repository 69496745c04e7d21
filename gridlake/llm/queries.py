"""Catalog of the training-data operators: one query per operator over its
whole table, with the SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary files are (the same on every worker)."""
    from public_tokenizers import path
    return str(path(name))


MIX_SQL = r"""
WITH q AS (SELECT doc_id, max(CASE quality WHEN 1 THEN 1.0 WHEN 0 THEN 0.25 END) AS w FROM labels GROUP BY doc_id),
d AS (SELECT documents.doc_id, source,
        CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
        -ln((CAST('0x' || substr(md5('0:' || coalesce(CAST(documents.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 1)
            / 4503599627370496.0::DOUBLE)
          / CAST(coalesce(w, 1.0) AS DOUBLE) AS key
      FROM documents LEFT JOIN q ON documents.doc_id = q.doc_id),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
               WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
             source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget FROM s),
r AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source ASC NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
             / sum(weight) OVER (ORDER BY cap / weight, source ASC NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM w),
f AS (SELECT rate AS free_rate FROM r WHERE rate * weight <= cap
      ORDER BY cap / weight, source ASC NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, coalesce(least(cap, (SELECT free_rate FROM f) * weight), cap) AS target FROM r),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target,
        CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.doc_id, d.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CAST(round(target) AS BIGINT) AS want,
        CASE WHEN source_size > 0 THEN CAST(floor(CAST(round(target) AS BIGINT) / source_size) AS BIGINT) ELSE 0 END AS epochs
      FROM p)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, want - epochs * source_size - before)) AS BIGINT) AS taken
FROM e
"""


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling weight by the quality label: 1 for good, a quarter for poor."""
    return table(spark, sf_dir, "labels").select(
        "doc_id", F.expr("CASE quality WHEN 1 THEN 1.0D WHEN 0 THEN 0.25D END").alias("weight"))


@register("op4_source_mix", MIX_SQL)
def op4(spark, sf_dir):
    from gridlake.llm.mixing import mix
    mixed = mix(table(spark, sf_dir, "documents"), quality=quality_weights(spark, sf_dir))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@register("op5_secret_scan")
def op5(spark, sf_dir):
    from gridlake.llm.secret_scan import find_secrets
    found = find_secrets(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans",
                        "n_live", "n_example")


@register("op10_best_fit_packing")
def op10(spark, sf_dir):
    from gridlake.llm.packing import pack_documents
    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.withColumnRenamed("id", "doc_id")


def learnable(df: DataFrame, parts: int) -> DataFrame:
    """Rows outside the held-out fold (crc32 of the id's text modulo ``parts`` is 1)."""
    return df.filter(~held_out(parts))


def held_out(parts: int, id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == 1, F.lit(False))


@register("op1_toxicity")
def op1(spark, sf_dir):
    from gridlake.llm.toxicity import score_documents, train
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, learnable(table(spark, sf_dir, "labels"), 3))
    return score_documents(docs, model).select(
        "doc_id", held_out(3).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op2_token_counts")
def op2(spark, sf_dir):
    from gridlake.llm.token_counts import token_counts
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path()).withColumnRenamed("id", "doc_id")


@register("op3_scaled_fingerprints")
def op3(spark, sf_dir):
    from gridlake.llm.fingerprints import fingerprint_documents
    return fingerprint_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@register("op9_substring_dedup")
def op9(spark, sf_dir):
    from gridlake.llm.substring import dedup_substrings
    kept = dedup_substrings(table(spark, sf_dir, "documents"), with_text=False)
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@register("op7_ngram_jaccard_join")
def op7(spark, sf_dir):
    from gridlake.llm.ngram_join import jaccard_components
    joined = jaccard_components(table(spark, sf_dir, "documents"))
    return joined.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@register("op7_ngram_jaccard_links")
def op7_links(spark, sf_dir):
    from gridlake.llm.ngram_join import link_counts
    counted = link_counts(table(spark, sf_dir, "documents"))
    return counted.select(F.col("id").alias("doc_id"), "n_shingles", F.col("node").alias("class_id"), "n_links")


@register("op8_kneser_ney_lm")
def op8(spark, sf_dir):
    from gridlake.llm.lm import score_documents, train
    docs = table(spark, sf_dir, "documents")
    model = train(learnable(docs, 5))
    return score_documents(docs, model).select(
        F.col("id").alias("doc_id"), held_out(5, "id").alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


@register("op8_kneser_ney_trigram")
def op8_trigram(spark, sf_dir):
    from gridlake.llm.lm import score_documents, train
    docs = table(spark, sf_dir, "documents")
    model = train(learnable(docs, 5), order=3)
    return score_documents(docs, model).select(
        F.col("id").alias("doc_id"), held_out(5, "id").alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


@register("op6_embedding_near_dedup")
def op6(spark, sf_dir):
    from gridlake.llm.embeddings import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@register("op11_spelling_variants")
def op11(spark, sf_dir):
    from gridlake.llm.variants import count_words, variant_groups
    grouped = variant_groups(count_words(table(spark, sf_dir, "documents"), drop_one_in=97))
    return grouped.select("word", "form", "root", "n", "n_near", "form_n")


EXACT_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS plain FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY plain) AS group_size,
       first_value(doc_id) OVER g IS NOT DISTINCT FROM doc_id AND first_value(n) OVER g = n AS kept,
       sha256(plain) AS text_sha256
FROM d WINDOW g AS (PARTITION BY plain ORDER BY n DESC, doc_id ASC NULLS LAST)
"""


@register("op12_exact_dedup", EXACT_SQL)
def op12(spark, sf_dir):
    from gridlake.llm.exact_dedup import exact_groups
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def with_repeated_tail(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten, by the crc32 h of its id's text,
    repeats a piece of itself: with g = h div 10, a = g % n and p = 1 + (n - a)
    div (3 + g % 8), each of its n words i >= a becomes word a + (i - a) % p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = docs.select("doc_id", "text", F.expr("0L").alias("zero"), F.call_function("div", h, F.lit(10)).alias("g"),
                      F.explode(F.array(words)).alias("w")).withColumn("n", F.size("w").cast("long")) \
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))) \
        .withColumn("p", 1 + F.call_function("div", F.col("n") - F.col("a"), 3 + F.col("g") % 8))
    word = F.transform(F.sequence(F.col("zero"), F.col("n") - 1), lambda i: F.get(
        "w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(word, " ")).otherwise(F.col("text")).alias("text"))


@register("op13_periodic_runs")
def op13(spark, sf_dir):
    from gridlake.llm.periodic import periodic_runs
    found = periodic_runs(with_repeated_tail(table(spark, sf_dir, "documents")), with_text=False)
    return found.select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "start", "length",
                        "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
