"""Shared helpers of the operators: staged tables and rank slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import shared_dir


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the cluster's shared checkpoint folder and read it
    back: cuts lineage, survives lost executors, and gives the planner the
    real size of the table (so that joins broadcast only what is small)."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slice_rows(spark: SparkSession, total: int, per_partition: int = 4) -> int:
    """Rows per slice such that ``total`` rows make about ``per_partition``
    slices for each shuffle partition: hot groups are cut into that many."""
    return max(1, -(-total // (per_partition * shuffle_partitions(spark))))


def uniform01(*cols, salt: int = 0):
    """Reproducible number in (0, 1] per value: the first 52 bits of an MD5
    (the same text in every engine), never 0 so that its logarithm exists."""
    text = F.concat_ws(":", F.lit(str(salt)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (bits + F.lit(1)).cast("double") / F.lit(float(1 << 52))
