"""Catalog entries for lake folders, tables, topics and date ranges
(A3-A5, A12-A17, C3-C5, D4, D20, F6, F7, I1, I2, N6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridlake.operators import records
from gridlake.operators.clean import SILVER_ENERGY_COLUMNS
from gridlake.plans import testbed as tb
from gridlake.plans.catalog import ANOMALY_SQL, FLAGSHIP_CTES, register
from gridlake.plans.catalog_common import E_SQL, W_SQL, YMD_SQL, energy_silver
from gridlake.session import shared_dir
from gridlake.sources import lake, messages, tables


# -- A14 / D13 ---------------------------------------------------------------
@register("stage_scan", "SELECT *, CAST(ts AS DATE) AS event_date FROM events")
def q_stage_scan(spark, sf_dir):
    df = lake.read_silver(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    return df.select("*", F.to_date("ts").alias("event_date"))

# -- A12 / A13 / C3 / D4 -----------------------------------------------------
@register("partition_day", f"SELECT *, {YMD_SQL} FROM ({E_SQL}) WHERE CAST(time AS DATE) = DATE '2024-01-15'")
def q_partition_day(spark, sf_dir):
    root = shared_dir(spark, "silver-energy")
    lake.write_partitioned(energy_silver(spark, sf_dir), root)
    return lake.read_day_range(spark, root, "2024-01-15", "2024-01-16").select(*SILVER_ENERGY_COLUMNS)

# -- I2 / N6 -------------------------------------------------------------------
@register("rerun_idempotent", f"SELECT *, {YMD_SQL} FROM ({E_SQL})")
def q_rerun_idempotent(spark, sf_dir):
    root = shared_dir(spark, "silver-rerun")
    silver = energy_silver(spark, sf_dir)
    lake.write_partitioned(silver, root)
    lake.write_partitioned(silver, root)  # same days again: replaced, not appended
    return lake.read_silver(spark, root).select(*SILVER_ENERGY_COLUMNS)

# -- C4 / C5 / D20 -------------------------------------------------------------
WINDOW_SQL = f"""
SELECT * FROM ({E_SQL})
WHERE time >= DATE '2024-01-10' AND time < DATE '2024-01-10' + INTERVAL 5 DAY
"""


@register("window_range", WINDOW_SQL)
def q_window_range(spark, sf_dir):
    start = F.lit("2024-01-10").cast("date")
    e = tb.stage_energy(spark, sf_dir)
    return e.where((F.col("time") >= start) & (F.col("time") < F.date_add(start, 5)))

# -- F6 / F7 / A3-A5 ------------------------------------------------------------
@register("row_counts", f"SELECT country, count(*) AS messages FROM ({E_SQL}) GROUP BY country")
def q_row_counts(spark, sf_dir):
    topic = shared_dir(spark, "topic-energy")
    msgs = records.encode_records(tb.stage_energy(spark, sf_dir), "country")
    messages.write_topic(msgs, fmt="parquet", path=topic)
    return (spark.read.parquet(topic).groupBy(F.col("key").alias("country"))
            .agg(F.count(F.lit(1)).alias("messages")))


@register("sink_rows", f"SELECT city_name AS key, city_name, country, time, temperature, weather_code FROM ({W_SQL})")
def q_sink_rows(spark, sf_dir):
    topic = shared_dir(spark, "topic-weather")
    msgs = records.encode_records(tb.stage_weather(spark, sf_dir), "city_name")
    messages.write_topic(msgs, fmt="parquet", path=topic)
    back = spark.read.parquet(topic)
    typed = records.decode_weather(back)
    return records.valid_rows(typed).select(
        "key", "city_name", "country", "time", "temperature", "weather_code")

# -- I1 ---------------------------------------------------------------------------
@register("append_union", f"""
SELECT *, 'backfill' AS run FROM ({E_SQL}) WHERE time < DATE '2024-01-20'
UNION ALL
SELECT *, 'incremental' AS run FROM ({E_SQL}) WHERE time >= DATE '2024-01-15'
""")
def q_append_union(spark, sf_dir):
    e = tb.stage_energy(spark, sf_dir)
    back = e.where(F.col("time") < F.lit("2024-01-20").cast("date")).withColumn("run", F.lit("backfill"))
    inc = e.where(F.col("time") >= F.lit("2024-01-15").cast("date")).withColumn("run", F.lit("incremental"))
    return back.unionByName(inc)

# -- A15 / A16 / A17 --------------------------------------------------------------
@register("table_view_refs", f"{FLAGSHIP_CTES} {ANOMALY_SQL}")
def q_table_view_refs(spark, sf_dir):
    from gridlake.functions.numeric import STORED_TOTAL_DECIMAL
    from gridlake.operators.aggregate import daily_summary_from_load_rollup
    from gridlake.operators.anomaly import anomaly_days_grouped
    suffix = uuid.uuid4().hex[:8]
    daily = daily_summary_from_load_rollup(tb.stage_weather(spark, sf_dir), tb.stage_energy(spark, sf_dir),
                                           STORED_TOTAL_DECIMAL)
    tables.materialise_table(daily, f"mart_daily_demand_summary_{suffix}",
                             shared_dir(spark, "mart-daily"))
    tables.materialise_view(anomaly_days_grouped(tables.ref(spark, f"mart_daily_demand_summary_{suffix}")),
                            f"mart_anomaly_days_{suffix}")
    return tables.ref(spark, f"mart_anomaly_days_{suffix}")
