"""Stream -> bronze with quarantine.

``land_stream`` decodes every micro-batch, writes valid records to bronze
partitioned by their *event* date (late data lands in its own date,
L5), and rejected records with a reason to the quarantine folder.  Each
batch writes into partitions tagged with its stream and batch id using
dynamic overwrite, so a batch replayed after a failure replaces its own
output and no other stream's: the checkpoint plus this makes the landing
exactly-once (L3 is at-least-once in the source system).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridlake.operators import records
from gridlake.sources.lake import JSON_TIMESTAMP_FORMAT, observed_rows
from gridlake.sources.ledger import Ledger, days_of


def _typed(kind: str) -> Callable[[DataFrame], DataFrame]:
    return records.decode_energy if kind == "energy" else records.decode_weather


def stream_tag(checkpoint: str) -> str:
    """Short name of a stream: batch ids are unique within its checkpoint only."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:10]


def land_batch(batch: DataFrame, batch_id: int, kind: str, bronze_root: str,
               quarantine_root: str, report_root: str | None = None, stream: str = "stream",
               lake_root: str | None = None) -> None:
    tag = f"{stream}-{batch_id}"
    typed = _typed(kind)(batch).persist()
    try:
        written, rejected = Observation(f"written_{kind}_{batch_id}"), Observation(f"rejected_{kind}_{batch_id}")
        valid = records.valid_rows(typed).observe(written, F.count(F.lit(1)).alias("rows"))
        dated = (valid.withColumn("year", F.year("time")).withColumn("month", F.month("time"))
                 .withColumn("day", F.dayofmonth("time")).withColumn("batch", F.lit(tag)))
        # one writer per date (AQE splits a date that is too big): a batch
        # writes one file per date it touches, not one per task and date
        dated = dated.hint("rebalance", "year", "month", "day")
        (dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("timestampFormat", JSON_TIMESTAMP_FORMAT)
         .partitionBy("year", "month", "day", "batch").json(bronze_root))
        if lake_root:
            # days that the next run has to rebuild; a replayed batch files them again, under the same mark
            Ledger(batch.sparkSession, lake_root).touch(kind, days_of(records.valid_rows(typed), F.to_date("time")), tag, tag)
        bad = (records.quarantine_rows(typed, kind).observe(rejected, F.count(F.lit(1)).alias("rows"))
               .withColumn("batch", F.lit(tag)))
        (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(quarantine_root))
        if report_root:
            # A5: what the batch delivered, one row per batch (a replay replaces it)
            report = batch.sparkSession.createDataFrame(
                [(kind, tag, observed_rows(written), observed_rows(rejected))],
                "source string, batch string, written long, rejected long")
            (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch").parquet(report_root))
    finally:
        typed.unpersist()


def land_stream(source: DataFrame, kind: str, bronze_root: str, quarantine_root: str,
                checkpoint: str, available_now: bool = True,
                processing_time: str = "5 seconds", report_root: str | None = None,
                lake_root: str | None = None) -> StreamingQuery:
    """Start the landing query (L2: 5 s trigger; batch runs: availableNow).

    ``report_root`` receives one row per micro-batch: rows written to bronze
    and rows rejected to the quarantine (A5).  ``lake_root`` (the root of the
    lake that bronze belongs to) has the touched days filed in its ledger, so
    that ``plans.incremental.run_pending`` rebuilds them.
    """
    writer = (source.writeStream
              .foreachBatch(lambda df, bid: land_batch(df, bid, kind, bronze_root, quarantine_root,
                                                       report_root, stream_tag(checkpoint), lake_root))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def dedup_stream(typed: DataFrame, key: list[str], arrival_col: str = "ingest_ts",
                 delay: str = "7 days") -> DataFrame:
    """Drop replays of a record that arrive within ``delay`` of it.

    The watermark runs on the *arrival* time (topic timestamp), not on the
    event time: a replay arrives within the topic retention (7 days), and
    a genuinely new record is never older than the arrival watermark, so
    late events are kept (they land in their own date, L5) instead of being
    dropped as late.  State holds the keys of the last ``delay`` of
    arrivals.
    """
    return typed.withWatermark(arrival_col, delay).dropDuplicatesWithinWatermark(key)
