"""The quarantine as a keyed table (N3): merge, read, replay.

A rejected record is one row by (origin, hash of its text): where it was
seen first and last and how many copies there are.  The origin is what was
judged when it was rejected: a landed file, or a bronze day.  A run merges
the rejects of everything it judged (its scope): records seen again keep
their first time, new ones are added, and rows of the scope that are no
longer rejected go.  So overlapping runs file a record once, and none stays
once its source is mended.

The table is partitioned by a hash of the origin; a merge rewrites the
partitions of its scope only, from a staged copy.  ``replay`` decodes the
kept texts again, as they are or mended, and hands on what is valid now.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.sources.ledger import read_or_empty
from gridlake.sources.storage import remove

ROWS = ("source string, origin string, record_hash string, raw string, reason string, event_date date, "
        "first_seen timestamp, last_seen timestamp, copies long, part int")
PARTS = 16


def part_of(origin) -> "F.Column":
    return F.pmod(F.xxhash64(origin), F.lit(PARTS)).cast("int")


def open_rows(spark: SparkSession, root: str) -> DataFrame:
    """All rows in quarantine."""
    return read_or_empty(spark, root, ROWS)


def merge(spark: SparkSession, root: str, rejects: DataFrame, scope: DataFrame, staging: str, seen_at) -> None:
    """Merge ``rejects`` (source, origin, raw, reason, event_date) of the
    origins in ``scope`` (origin) into the table; rejects outside the scope
    are added to it."""
    new = rejects.withColumn("record_hash", F.sha2(F.concat_ws("\u001f", "source", F.coalesce("raw", F.lit(""))), 256)) \
        .groupBy("source", "origin", "record_hash").agg(
            F.min("raw").alias("raw"), F.min("reason").alias("reason"), F.min("event_date").alias("event_date"),
            F.count(F.lit(1)).alias("copies"))
    judged = scope.select("origin").union(rejects.select("origin")).distinct()
    parts = sorted(r["part"] for r in judged.select(part_of("origin").alias("part")).distinct().collect())   # at most PARTS
    if not parts:
        return
    old = open_rows(spark, root).where(F.col("part").isin(parts))
    untouched = old.join(judged, "origin", "left_anti")
    before = old.select("origin", "record_hash", F.col("first_seen").alias("_first"))
    now = F.lit(seen_at).cast("timestamp")
    again = new.join(before, ["origin", "record_hash"], "left") \
        .withColumn("first_seen", F.coalesce("_first", now)).withColumn("last_seen", now) \
        .withColumn("part", part_of("origin"))
    columns = [c.split()[0] for c in ROWS.split(", ")]
    untouched.select(*columns).unionByName(again.select(*columns)).write.mode("overwrite").parquet(staging)
    merged = spark.read.schema(ROWS).parquet(staging)
    merged.hint("rebalance", "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("part").parquet(root)
    filled = {r["part"] for r in merged.select("part").distinct().collect()}
    for part in set(parts) - filled:           # overwriting leaves partitions alone that get no rows
        remove(spark, f"{root}/part={part}")


def replay(spark: SparkSession, root: str, source: str, decode: Callable[[DataFrame], DataFrame],
           mend: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Decode the quarantined texts of ``source`` again.

    ``mend`` may rewrite ``value`` (the text) of the rows (origin, value)
    first.  Returns (valid typed rows, closed): hand the valid rows on, then
    ``close`` the closed ones.
    """
    rows = open_rows(spark, root).where(F.col("source") == source) \
        .select("origin", "record_hash", F.col("raw").alias("value"))
    typed = decode(mend(rows) if mend else rows)
    good = typed.where("reason is null")
    return good.drop("origin", "record_hash", "raw", "reason"), good.select("origin", "record_hash").distinct()


def close(spark: SparkSession, root: str, closed: DataFrame, staging: str) -> None:
    """Take the ``closed`` (origin, record_hash) rows out."""
    parts = sorted(r["part"] for r in closed.select(part_of("origin").alias("part")).distinct().collect())
    old = open_rows(spark, root).where(F.col("part").isin(parts))
    old.join(closed, ["origin", "record_hash"], "left_anti").write.mode("overwrite").parquet(staging)
    left = spark.read.schema(ROWS).parquet(staging)
    left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(root)
    filled = {r["part"] for r in left.select("part").distinct().collect()}
    for part in set(parts) - filled:
        remove(spark, f"{root}/part={part}")
