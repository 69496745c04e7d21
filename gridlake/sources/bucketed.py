"""Co-partitioned silver for the hourly join.

``write_bucketed`` stores a source bucketed and sorted on (city, hour); two
sources with the same number of buckets join without a shuffle: bucket i
meets bucket i.  The bucket count is fixed when the tables are made, so it
is sized for the largest side (``bucket_count``).  A hot city is spread over
its hours, since the hour is part of the bucketing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlake.operators.join import JOINED_COLUMNS, hour_of

KEYS = ["city_name", "hour"]


def bucket_count(rows: int, bytes_per_row: int = 64, bucket_bytes: int = 256 * 2**20, least: int = 8) -> int:
    """Buckets of about ``bucket_bytes`` for the larger side of the join."""
    return max(least, -(-rows * bytes_per_row // bucket_bytes))


def write_bucketed(rows: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Store ``rows`` (with ``city_name`` and ``time``) as ``table`` at ``path``.

    Rows are dealt by the bucket key first, so a bucket is one sorted file
    and its scan needs no sort either.
    """
    keyed = rows.withColumn("hour", hour_of("time"))
    keyed.repartition(buckets, *KEYS).write.mode("overwrite").format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS) \
        .option("path", path).saveAsTable(table)
    return rows.sparkSession.table(table)


def join_bucketed(spark: SparkSession, weather_table: str, energy_table: str) -> DataFrame:
    """E1 over two bucketed tables; same rows as ``join_hourly``.

    The merge hint keeps the co-located sort-merge plan whatever the sizes
    (a broadcast would exchange one side again).
    """
    w = spark.table(weather_table).select("city_name", "country", "time", "temperature", "humidity", "wind_speed",
                                          "precipitation", "weather_code", "hour")
    e = spark.table(energy_table).select("city_name", "hour", "load_mw")
    return w.hint("merge").join(e, KEYS).select(*JOINED_COLUMNS)
