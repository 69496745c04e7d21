"""Merge of new readings into date-partitioned silver.

Instead of rebuilding a day from all of its bronze, the new readings of a
batch are merged into the stored ones by key: of copies the one that
arrived last stays, then the greater measure.  Only the partitions that the
batch touches are read and rewritten, from a staged copy, so a failure
leaves each partition as it was or as it will be.  Arrival times are kept
in the table (``ingest_ts``, which readers with the silver schema do not
see), so a batch that comes late or twice changes nothing that is newer.

A merge cannot take readings away; days whose source files were replaced
are rebuilt (``plans.incremental``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.operators.clean import KEY, with_date_parts
from gridlake.operators.dedup import keep_one
from gridlake.sources import lake

ARRIVAL = T.StructField("ingest_ts", T.TimestampType())


def merge_silver(spark: SparkSession, root: str, typed: DataFrame, schema: T.StructType, measure: str, staging: str) -> list[dt.date]:
    """Merge typed valid readings (with ``ingest_ts``) into the silver table
    at ``root``; returns the rewritten days."""
    stored = T.StructType(schema.fields + [ARRIVAL])
    new = with_date_parts(typed.dropna(subset=[*KEY, measure])).select(*stored.fieldNames())
    days = sorted(r["d"] for r in new.select(F.make_date("year", "month", "day").alias("d")).distinct().collect())   # days of the batch
    if not days:
        return []
    old = lake.read_days(spark, root, days, "parquet", stored)
    merged = keep_one(old.select(*stored.fieldNames()).unionByName(new), KEY, ["ingest_ts", measure])
    merged.write.mode("overwrite").parquet(staging)
    lake.write_partitioned(spark.read.schema(stored).parquet(staging), root)
    return days
