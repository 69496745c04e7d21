"""Bronze and silver folders.

* Bronze: NDJSON partitioned by the event date (``year/month/day``).
* Silver: Parquet partitioned the same way, one level only (Q1), written
  with dynamic partition overwrite so a rerun of a day replaces exactly
  that day (idempotent, N6) instead of appending a second copy.

Writes ask for a ``REBALANCE`` on the partition columns: AQE then groups
rows of a date into few files but still splits a date that holds most of
the data over many tasks (no single hot writer).
"""

from __future__ import annotations

import datetime as dt
import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.functions.timefmt import parse_iso
from gridlake.sources.storage import exists, located

PARTS = ["year", "month", "day"]
BRONZE_TEXT = T.StructType([T.StructField("value", T.StringType())]
                           + [T.StructField(c, T.IntegerType()) for c in PARTS]
                           + [T.StructField("batch", T.StringType())])
# JSON text keeps microseconds and the offset (the default drops to millis).
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def observed_rows(observation: Observation) -> int:
    """Row count of a finished write (F6); 0 if its plan was empty, in which
    case Spark runs no job and delivers no metrics."""
    try:
        return observation.get["rows"]
    except Py4JJavaError as exc:
        if "AssertionError" not in str(exc.java_exception):
            raise
        return 0


def _rebalanced(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.hint("rebalance", *cols)


def write_partitioned(df: DataFrame, root: str, fmt: str = "parquet", mode: str = "overwrite",
                      partition_cols: list[str] | None = None,
                      observation: Observation | None = None) -> None:
    """Write partitioned by the date parts with dynamic overwrite.

    ``observation`` receives the row count of the same job (F6), so the
    data is not computed twice for a log line.
    """
    cols = partition_cols or PARTS
    out = df.observe(observation, F.count(F.lit(1)).alias("rows")) if observation else df
    writer = _rebalanced(out, cols).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if fmt == "json":
        writer = writer.option("timestampFormat", JSON_TIMESTAMP_FORMAT).option("timestampNTZFormat", JSON_NTZ_FORMAT)
    writer.partitionBy(*cols).format(fmt).save(root)


def write_bronze(df: DataFrame, root: str, time_col: str = "time", mode: str = "append",
                 batch: str | None = None) -> None:
    """NDJSON by event date; late records land in their own date.

    ``time_col`` may hold ISO text (records as received) or a timestamp.
    ``batch`` names a sub-partition of each day for this writer, so that
    several writers (streams, batch landings) share a bronze folder and an
    overwrite replaces only the writer's own rows.
    """
    t = parse_iso(time_col) if dict(df.dtypes)[time_col] == "string" else F.col(time_col)
    dated = (df.withColumn("year", F.year(t)).withColumn("month", F.month(t))
             .withColumn("day", F.dayofmonth(t)))
    if batch is None:
        write_partitioned(dated, root, fmt="json", mode=mode)
    else:
        write_partitioned(dated.withColumn("batch", F.lit(batch)), root, fmt="json", mode=mode,
                          partition_cols=PARTS + ["batch"])


def range_days(start: str, end: str) -> list[dt.date]:
    """The dates of ``[start, end)``."""
    lo, hi = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return [lo + dt.timedelta(days=i) for i in range((hi - lo).days)]


def drop_empty_days(spark: SparkSession, root: str, kept: DataFrame, days: list[dt.date], sub: str = "") -> list[str]:
    """Remove the folders of ``days`` that ``kept`` (the rows just written,
    with ``event_date``) does not hold: dynamic overwrite leaves days alone
    that a rerun no longer fills.  The folders that exist are listed with one
    pattern; returns the removed days."""
    held = {r["event_date"] for r in kept.select("event_date").distinct().collect()}   # at most the days
    empty = {d for d in days if d not in held}
    if not empty:
        return []
    fs, pattern = located(spark, days_glob(root, sorted(empty)) + sub)
    gone = []
    for status in fs.globStatus(pattern) or []:
        y, m, d = re.search(r"year=(\d+)/month=(\d+)/day=(\d+)", status.getPath().toString()).groups()
        day = dt.date(int(y), int(m), int(d))
        if day in empty and fs.delete(status.getPath(), True):
            gone.append(day.isoformat())
    return sorted(gone)


def read_bronze(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Bronze with an explicit schema; partition columns come from paths."""
    full = T.StructType(schema.fields + [T.StructField(p, T.IntegerType(), True) for p in PARTS])
    return spark.read.schema(full).json(root)


def read_bronze_day(spark: SparkSession, root: str, schema: T.StructType, day: str) -> DataFrame:
    """One date: only its folder is listed, plus the partition filter."""
    full = T.StructType(schema.fields + [T.StructField(p, T.IntegerType(), True) for p in PARTS])
    nxt = (dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat()
    return read_day_range(spark, root, day, nxt, "json", full)


def read_silver(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The whole partitioned tree (partition discovery)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(root)


def days_glob(root: str, days: list[dt.date]) -> str:
    """One glob over the ``year=/month=/day=`` folders of ``days``.

    Only matching folders are listed (not the whole history); the glob may
    match a few extra days of the same months, which the exact date filter
    of ``read_days`` removes.
    """
    if not days:
        raise ValueError("no days")
    if len(days) == 1:  # the daily case: the folder itself, no pattern
        d = days[0]
        return f"{root.rstrip('/')}/year={d.year}/month={d.month}/day={d.day}"

    def alt(values):
        return "{" + ",".join(str(v) for v in sorted(set(values))) + "}"

    return (f"{root.rstrip('/')}/year={alt(d.year for d in days)}/month={alt(d.month for d in days)}"
            f"/day={alt(d.day for d in days)}")


def day_glob(root: str, start: str, end: str) -> str:
    """``days_glob`` of the dates ``[start, end)``."""
    return days_glob(root, range_days(start, end))


def read_days(spark: SparkSession, root: str, days: list[dt.date], fmt: str = "parquet",
              schema: T.StructType | None = None) -> DataFrame:
    """Rows of some dates of a date-partitioned folder.

    Lists only their folders; ``schema`` (data + partition columns) is used
    where there are none.
    """
    reader = spark.read.format(fmt).option("basePath", root.rstrip("/"))
    if schema is not None and fmt != "text":
        reader = reader.schema(schema)
    if schema is not None and not exists(spark, days_glob(root, days)):
        return spark.createDataFrame([], schema)
    df = reader.load(days_glob(root, days))
    if schema is not None and "year" not in df.columns:     # the day's folder is there, but empty
        return spark.createDataFrame([], schema)
    d, lo, hi = F.make_date("year", "month", "day"), min(days), max(days)
    if (hi - lo).days + 1 == len(set(days)):
        return df.where((d >= F.lit(lo)) & (d <= F.lit(hi)))
    return df.where(d.isin(list(days)))


def read_day_range(spark: SparkSession, root: str, start: str, end: str, fmt: str = "parquet",
                   schema: T.StructType | None = None) -> DataFrame:
    """Rows of the dates ``[start, end)`` of a date-partitioned folder."""
    days = range_days(start, end)
    if not days:
        raise ValueError(f"empty date range [{start}, {end})")
    return read_days(spark, root, days, fmt, schema)


def read_silver_range(spark: SparkSession, root: str, start: str, end: str,
                      schema: T.StructType | None = None) -> DataFrame:
    """Silver rows of the dates ``[start, end)`` (listing only those days)."""
    return read_day_range(spark, root, start, end, "parquet", schema)
