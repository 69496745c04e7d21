"""Model materialisation (A15-A17): table, view and reference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def materialise_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Full rebuild as a Parquet table at ``path`` registered as ``name``."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def materialise_view(df: DataFrame, name: str) -> DataFrame:
    """A view; evaluated by whoever reads it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def ref(spark: SparkSession, name: str) -> DataFrame:
    """Read another model's output by name."""
    return spark.table(name)
