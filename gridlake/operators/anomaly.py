"""Anomalous load days per country.

A day is anomalous when its mean load lies more than two sample standard
deviations from its country's mean.  Countries with a single day (sd NULL)
or a constant load (sd 0) never flag; the score is ``|x - mean| / sd``.

Mean and sd come from exact decimal moments (count, sum, sum of squares),
so they do not depend on partitioning or summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.numeric import mean_and_sd_from_sums

ANOMALY_COLUMNS = ["country", "activity_date", "avg_load_mw", "mean_load", "stddev_load",
                   "deviation_score"]


def _flag(stats: DataFrame, threshold: float) -> DataFrame:
    dev = F.abs(F.col("avg_load_mw").cast("double") - F.col("mean_load"))
    return (stats
            .where((F.col("stddev_load") > 0) & (dev > threshold * F.col("stddev_load")))
            .withColumn("deviation_score", dev / F.col("stddev_load"))
            .select(*ANOMALY_COLUMNS))


def anomaly_days(daily: DataFrame, by: str = "country", threshold: float = 2.0) -> DataFrame:
    """Window form of the model: whole-partition frame per country."""
    w = Window.partitionBy(by)
    x = F.col("avg_load_mw")
    mean, sd = mean_and_sd_from_sums(F.count(x).over(w), F.sum(x).over(w), F.sum(x * x).over(w))
    stats = daily.select(by, "activity_date", "avg_load_mw",
                         mean.alias("mean_load"), sd.alias("stddev_load"))
    return _flag(stats, threshold)


def country_load_stats(daily: DataFrame, by: str = "country") -> DataFrame:
    """One row per country: mean and sample sd of the daily mean load.

    A plain aggregation: partial sums are combined map-side, so even a
    country holding most of the days never lands whole in one task.
    """
    x = F.col("avg_load_mw")
    agg = daily.groupBy(by).agg(F.count(x).alias("_n"), F.sum(x).alias("_s"), F.sum(x * x).alias("_ss"))
    mean, sd = mean_and_sd_from_sums(F.col("_n"), F.col("_s"), F.col("_ss"))
    return agg.select(by, mean.alias("mean_load"), sd.alias("stddev_load"))


def anomaly_days_grouped(daily: DataFrame, by: str = "country", threshold: float = 2.0) -> DataFrame:
    """Aggregate-then-join form; same rows as ``anomaly_days``.

    The stats side has one row per country; the join is planned by the
    optimizer (AQE broadcasts it once its runtime size is known to be
    small), so nothing is broadcast on an unchecked size.
    """
    stats = daily.select(by, "activity_date", "avg_load_mw").join(country_load_stats(daily, by), by)
    return _flag(stats, threshold)
