"""Country statistics from mergeable moments (G1, G2, C6), kept up to date.

A (country, day) is summed up as count, exact sum, exact sum of squares,
least and greatest of its daily means.  Country totals are sums of these;
replacing days subtracts their old moments and adds the new ones.  Sums are
exact decimals, so totals after any number of replacements equal totals
built at once.

Flags follow from totals and moments: only (country, day) whose least or
greatest mean lies outside the country's band can hold an anomalous row,
so of the daily mart only those days are read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.numeric import mean_and_sd_from_sums
from gridlake.operators.anomaly import ANOMALY_COLUMNS

MOMENTS = ("country string, activity_date date, n long, s decimal(30,2), ss decimal(38,4), lo decimal(10,2), "
           "hi decimal(10,2), month string")
TOTALS = "country string, n long, s decimal(30,2), ss decimal(38,4)"
SUMS = {"n": "long", "s": "decimal(30,2)", "ss": "decimal(38,4)"}


def month_of(day):
    return F.date_format(day, "yyyy-MM")


def day_moments(daily: DataFrame) -> DataFrame:
    """Moments of each (country, day) of the daily mart."""
    x = F.col("avg_load_mw")
    out = daily.groupBy("country", "activity_date").agg(
        F.count(x).alias("n"), F.sum(x).cast(SUMS["s"]).alias("s"), F.sum(x * x).cast(SUMS["ss"]).alias("ss"),
        F.min(x).alias("lo"), F.max(x).alias("hi"))
    return out.withColumn("month", month_of("activity_date"))


def totals_of(moments: DataFrame) -> DataFrame:
    return _summed(moments.select("country", *SUMS))


def _summed(rows: DataFrame) -> DataFrame:
    sums = [F.sum(c).cast(t).alias(c) for c, t in SUMS.items()]
    return rows.groupBy("country").agg(*sums).where("n > 0")


def replaced_totals(totals: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """``totals`` after the days with moments ``old`` got moments ``new``."""
    minus = old.select("country", *[(-F.col(c)).cast(t).alias(c) for c, t in SUMS.items()])
    return _summed(totals.select("country", *SUMS).unionByName(minus).unionByName(new.select("country", *SUMS)))


def country_bands(totals: DataFrame) -> DataFrame:
    """(country, mean_load, stddev_load) from totals."""
    mean, sd = mean_and_sd_from_sums(F.col("n"), F.col("s"), F.col("ss"))
    return totals.select("country", mean.alias("mean_load"), sd.alias("stddev_load"))


def _outside(x, threshold: float):
    return F.abs(x.cast("double") - F.col("mean_load")) > threshold * F.col("stddev_load")


def candidate_days(moments: DataFrame, totals: DataFrame, threshold: float = 2.0) -> DataFrame:
    """(country, activity_date, mean_load, stddev_load) that can hold an anomalous row."""
    met = moments.join(country_bands(totals), "country").where("stddev_load > 0")
    return met.where(_outside(F.col("lo"), threshold) | _outside(F.col("hi"), threshold)) \
        .select("country", "activity_date", "mean_load", "stddev_load")


def flagged(daily: DataFrame, candidates: DataFrame, threshold: float = 2.0) -> DataFrame:
    """The anomaly mart's rows among the candidate days of ``daily``."""
    rows = daily.select("country", "activity_date", "avg_load_mw").join(candidates, ["country", "activity_date"])
    rows = rows.where(_outside(F.col("avg_load_mw"), threshold))
    dev = F.abs(F.col("avg_load_mw").cast("double") - F.col("mean_load"))
    return rows.withColumn("deviation_score", dev / F.col("stddev_load")).select(*ANOMALY_COLUMNS)
