"""Landed API payloads.

The HTTP pulls of the source system are replaced by payload files that a
landing step drops into a folder; these readers parse them with explicit
schemas (no inference scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake import schemas
from gridlake.functions.timefmt import parse_iso


CORRUPT = "_corrupt_record"


def read_weather_payloads(spark: SparkSession, path: str | list[str], with_corrupt: bool = False) -> DataFrame:
    """One JSON payload per line (context columns + ``hourly`` arrays) of
    a folder, or of some files.

    ``with_corrupt`` adds the text of lines that are no such payload as
    ``_corrupt_record``, the file's time as ``ingest_ts`` and its name as
    ``source_file``.
    """
    if not with_corrupt:
        return spark.read.schema(schemas.WEATHER_PAYLOAD).json(path)
    full = T.StructType(schemas.WEATHER_PAYLOAD.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    lines = spark.read.text(path).where(F.trim("value") != "") \
        .select("value", F.col("_metadata.file_modification_time").alias("ingest_ts"),
                F.col("_metadata.file_path").alias("source_file"))
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # generator boundary: the line is parsed once, whatever is filtered later
    return lines.select("ingest_ts", "source_file", F.explode(F.array(parsed)).alias("_p")) \
        .select("_p.*", "ingest_ts", "source_file")


def file_origin(df: DataFrame):
    """Where a rejected record of a landed file comes from (quarantine key)."""
    return (F.concat(F.lit("file:"), F.col("source_file")) if "source_file" in df.columns
            else F.lit(None).cast("string")).alias("origin")


def rejected_weather(payloads: DataFrame, rows: DataFrame) -> DataFrame:
    """Quarantine rows of a weather landing: payload lines that do not
    parse, and hours whose time does not."""
    lines = payloads.where(F.col(CORRUPT).isNotNull()).select(
        F.lit("weather").alias("source"), F.col(CORRUPT).alias("raw"), F.lit("malformed_payload").alias("reason"),
        F.lit(None).cast("date").alias("event_date"), file_origin(payloads))
    hours = rows.where(parse_iso("time").isNull()).select(
        F.lit("weather").alias("source"), F.to_json(F.struct("city_name", "country", "time", "temperature")).alias("raw"),
        F.when(F.col("time").isNull(), F.lit("missing_time")).otherwise(F.lit("bad_time")).alias("reason"),
        F.lit(None).cast("date").alias("event_date"), file_origin(rows))
    return lines.unionByName(hours)


def restrict_hours(rows: DataFrame, start_date: str, end_date: str, time_col: str = "time",
                   inclusive_end: bool = True) -> DataFrame:
    """Keep hours of ``[start_date, end_date]`` (the service sends both
    days); ``inclusive_end=False`` gives the half-open ``[start, end)``."""
    t = parse_iso(time_col) if dict(rows.dtypes)[time_col] == "string" else F.col(time_col)
    d, hi = F.to_date(t), F.lit(end_date).cast("date")
    return rows.where((d >= F.lit(start_date).cast("date")) & ((d <= hi) if inclusive_end else (d < hi)))


def read_load_payloads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed load documents as ``country, city_name, xml`` JSON lines,
    with the file's time as ``ingest_ts`` and its name as ``source_file``."""
    return spark.read.schema(schemas.LOAD_LANDED).json(path) \
        .withColumn("ingest_ts", F.col("_metadata.file_modification_time")) \
        .withColumn("source_file", F.col("_metadata.file_path"))


def write_landed(df: DataFrame, path: str) -> None:
    """Land payload rows as JSON lines (used by tests and backfills)."""
    df.write.mode("overwrite").json(path)


def read_load_xml_files(spark: SparkSession, root: str) -> DataFrame:
    """A7 on raw load documents laid out as ``country=<c>/city_name=<n>/*.xml``.

    Spark's XML source reads every ``Period`` element as a row (namespace
    ignored, fixed schema); country and city come from the folders.  A
    file that is not well-formed XML yields no periods - use the landed
    ``(country, city_name, xml)`` rows when each document needs its own
    quarantine row.
    """
    return (spark.read.format("xml").option("rowTag", "Period").option("ignoreNamespace", "true")
            .schema(schemas.LOAD_PERIOD).load(root))


def write_load_xml_files(periods: DataFrame, root: str) -> None:
    """Write ``country, city_name`` + ``Period`` columns as XML documents."""
    (periods.write.mode("overwrite").format("xml").option("rowTag", "Period")
     .option("rootTag", "TimeSeries").partitionBy("country", "city_name").save(root))
