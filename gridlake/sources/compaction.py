"""Compaction of bronze days (A10, L1): many batch folders into one.

A stream writes one ``batch=`` folder per micro-batch and day.  Compaction
copies the live rows of a day into one ``batch=compact-<id>`` folder and
files in a manifest which batches went into it; then the folders go.  The
manifest decides what counts, not the folders: a compacted copy counts once
it is filed, a folded batch no longer does.  So a failure at any step
loses and repeats nothing, and a batch that is replayed after it was folded
is recognised: its rows lie in its folder again and are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.sources import lake
from gridlake.sources.ledger import read_or_empty
from gridlake.sources.storage import remove

FOLDED = "event_date date, batch string, into string, compaction string"
PREFIX = "compact-"


def folded(spark: SparkSession, manifest_root: str) -> DataFrame:
    """(event_date, batch, into) of the batches that were folded."""
    return read_or_empty(spark, manifest_root, FOLDED).drop("compaction")


def live(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """The bronze rows that count; ``rows`` has year, month, day and batch."""
    gone = manifest.select(F.year("event_date").alias("year"), F.month("event_date").alias("month"),
                           F.dayofmonth("event_date").alias("day"), "batch").distinct()
    filed = manifest.select(F.year("event_date").alias("year"), F.month("event_date").alias("month"),
                            F.dayofmonth("event_date").alias("day"), F.col("into").alias("batch"),
                            F.lit(True).alias("_filed")).distinct()
    keys = ["year", "month", "day", "batch"]
    return rows.join(gone, keys, "left_anti").join(filed, keys, "left") \
        .where(F.col("_filed") | ~F.coalesce(F.col("batch").startswith(PREFIX), F.lit(False))).drop("_filed")


def compact(spark: SparkSession, bronze_root: str, manifest_root: str, start: str, end: str,
            min_batches: int = 2, max_rows_per_file: int = 20_000_000) -> dict[str, int]:
    """Fold the days of ``[start, end)`` that hold at least ``min_batches``
    live batches; texts are copied as they are.  Returns counts."""
    schema = lake.BRONZE_TEXT
    text = lake.read_day_range(spark, bronze_root, start, end, "text", schema)
    manifest = folded(spark, manifest_root)
    day = F.make_date("year", "month", "day")
    batches = live(text, manifest).groupBy(day.alias("event_date"), "batch").agg(F.count(F.lit(1)).alias("rows"))
    many = batches.groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_batches)
    chosen = batches.join(many.select("event_date"), "event_date", "left_semi")
    ident = uuid.uuid4().hex[:12]
    into = f"{PREFIX}{ident}"
    entries = [(r["event_date"], r["batch"], into) for r in chosen.collect()]         # folders of the range
    if not entries:
        return {"days": 0, "batches": 0}
    plan = spark.createDataFrame(entries, "event_date date, batch string, into string")
    fold = plan.select(F.year("event_date").alias("year"), F.month("event_date").alias("month"),
                       F.dayofmonth("event_date").alias("day"), "batch")
    rows = live(text, manifest).join(F.broadcast(fold) if len(entries) < 10_000 else fold,
                                     ["year", "month", "day", "batch"], "left_semi") \
        .withColumn("batch", F.lit(into))
    rows.hint("rebalance", "year", "month", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .option("maxRecordsPerFile", max_rows_per_file).partitionBy("year", "month", "day", "batch").text(bronze_root)
    plan.coalesce(1).write.mode("overwrite").parquet(f"{manifest_root}/compaction={ident}")     # from here on it counts
    remove_folded(spark, bronze_root, plan)
    return {"days": len({e[0] for e in entries}), "batches": len(entries)}


def remove_folded(spark: SparkSession, bronze_root: str, entries: DataFrame) -> int:
    """Delete the folders of folded (event_date, batch) rows, replayed ones too."""
    removed = 0
    for r in entries.select("event_date", "batch").distinct().collect():
        d = r["event_date"]
        removed += remove(spark, f"{bronze_root}/year={d.year}/month={d.month}/day={d.day}/batch={r['batch']}")
    return removed
