"""Invariants on the driver tables (sf0.01)."""

from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_ORACLE


def _q(spark, name):
    return entry.queries()[name](spark, SF_ORACLE)


def test_min_le_avg_le_max(spark):
    daily = _q(spark, "daily_summary")
    for m in ("temperature", "humidity", "load_mw"):
        bad = daily.where((F.col(f"min_{m}") > F.col(f"avg_{m}")) | (F.col(f"avg_{m}") > F.col(f"max_{m}")))
        assert bad.count() == 0, m


def test_hourly_sum_equals_daily_total(spark):
    joined = _q(spark, "join_hourly")
    sums = (joined.groupBy("city_name", "country", F.to_date("time").alias("activity_date"))
            .agg(F.sum(F.col("load_mw").cast("decimal(18,2)")).cast("decimal(10,2)").alias("s")))
    daily = _q(spark, "daily_summary")
    diff = daily.join(sums, ["city_name", "country", "activity_date"], "full_outer").where(
        ~F.col("s").eqNullSafe(F.col("total_load_mw")))
    assert diff.count() == 0


def test_anomalies_are_daily_rows(spark):
    anomalies = _q(spark, "anomaly_days_grouped").select("country", "activity_date", "avg_load_mw")
    daily = _q(spark, "daily_summary").select("country", "activity_date", "avg_load_mw")
    assert anomalies.count() > 0
    assert anomalies.exceptAll(daily).count() == 0


def test_valid_plus_quarantined_is_input(spark):
    counts = _q(spark, "quarantine_counts").agg(F.sum("records")).first()[0]
    assert counts == spark.read.parquet(f"{SF_ORACLE}/events.parquet").count()


def test_block_mean_times_n_is_block_sum(spark):
    """Mean x n stays within n half-cents of the block sum (brute force in DuckDB)."""
    import duckdb
    sums = dict(((r[0], str(r[1]), r[2]), r[3]) for r in duckdb.sql(f"""
        SELECT event_type, CAST(date_trunc('day', ts) AS DATE), i // 4, sum(CAST(value AS DECIMAL(18,2)))
        FROM (SELECT *, row_number() OVER (PARTITION BY event_type, date_trunc('day', ts)
                                           ORDER BY ts, event_id) - 1 AS i
              FROM '{SF_ORACLE}/events.parquet')
        GROUP BY 1, 2, 3 HAVING count(*) = 4""").fetchall())
    blocks = _q(spark, "block_mean").collect()
    assert len(blocks) == len(sums)
    for b in blocks:
        total = sums[(b.event_type, str(b.day.date()), b.block)]
        assert abs(Decimal(str(b.load_mw)) * 4 - total) <= Decimal("0.02")
