"""The query catalog: one Spark job per inventory item, each with the
DuckDB SQL text that must produce the same rows on the same tables.

Every query reads the driver's parquet tables (whole tables, no row caps)
through ``gridlake.plans.testbed``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.plans import testbed as tb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def naive_utc(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock ``timestamp_ntz``, the type of a SQL
    ``TIMESTAMP`` (without time zone) in the oracle."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def register(name: str, sql: str | None):
    def wrap(fn):
        @functools.wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return naive_utc(fn(spark, sf_dir))
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return wrap


# ---------------------------------------------------------------------------
# Flagship: hourly join -> daily summary -> anomaly days (E1, F*, G*, C6)

W_CTE = f"w AS ({tb.STAGE_WEATHER_SQL})"
E_CTE = f"e AS ({tb.STAGE_ENERGY_SQL})"

JOIN_SQL = """
SELECT w.city_name, w.country, w.time, w.temperature, w.humidity, w.wind_speed,
       w.precipitation, w.weather_code, e.load_mw
FROM w JOIN e
  ON year(w.time) = year(e.time) AND month(w.time) = month(e.time)
 AND day(w.time) = day(e.time) AND datepart('hour', w.time) = datepart('hour', e.time)
 AND w.city_name = e.city_name
"""


def total_sql(c: str) -> str:
    """SQL twin of ``functions.numeric.exact_total``."""
    return f"sum(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,16)))"


def half_up_sql(total: str, n: str) -> str:
    """SQL twin of ``functions.numeric.half_up_mean``, on integers."""
    units = f"CAST(replace(CAST({total} AS VARCHAR), '.', '') AS HUGEINT)"
    unit = "10000000000000000::HUGEINT"
    q = f"((200 * abs({units}) + ({n}) * {unit}) // (2 * ({n}) * {unit}))"
    return (f"(CASE WHEN ({n}) > 0 THEN CAST(CASE WHEN ({total}) < 0 THEN -{q} ELSE {q} END AS DOUBLE)"
            f" / 100 END)")


def _mean_sql(c: str) -> str:
    return f"CAST({half_up_sql(total_sql(c), f'count({c})')} AS DECIMAL(10,2))"


DAILY_SQL = f"""
SELECT city_name, country, CAST(time AS DATE) AS activity_date,
  {_mean_sql('temperature')} AS avg_temperature,
  CAST(min(temperature) AS DECIMAL(10,2)) AS min_temperature,
  CAST(max(temperature) AS DECIMAL(10,2)) AS max_temperature,
  {_mean_sql('humidity')} AS avg_humidity,
  CAST(min(humidity) AS DECIMAL(10,2)) AS min_humidity,
  CAST(max(humidity) AS DECIMAL(10,2)) AS max_humidity,
  {_mean_sql('wind_speed')} AS avg_wind_speed,
  {_mean_sql('precipitation')} AS avg_precipitation,
  CAST(min(load_mw) AS DECIMAL(10,2)) AS min_load_mw,
  CAST(max(load_mw) AS DECIMAL(10,2)) AS max_load_mw,
  {_mean_sql('load_mw')} AS avg_load_mw,
  CAST({total_sql('load_mw')} AS DECIMAL(10,2)) AS total_load_mw
FROM joined
GROUP BY city_name, country, CAST(time AS DATE)
"""

ANOMALY_SQL = """
SELECT country, activity_date, avg_load_mw, mean_load, stddev_load,
       abs(CAST(avg_load_mw AS DOUBLE) - mean_load) / stddev_load AS deviation_score
FROM (
  SELECT country, activity_date, avg_load_mw,
         CAST(s AS DOUBLE) / n AS mean_load,
         CASE WHEN n > 1 THEN sqrt(CAST(CAST(n AS DECIMAL(20,0)) * ss - s * s AS DOUBLE)
                                   / (CAST(n AS DOUBLE) * (n - 1))) END AS stddev_load
  FROM (
    SELECT country, activity_date, avg_load_mw,
           count(avg_load_mw) OVER (PARTITION BY country) AS n,
           sum(avg_load_mw) OVER (PARTITION BY country) AS s,
           sum(avg_load_mw * avg_load_mw) OVER (PARTITION BY country) AS ss
    FROM daily) moments) stats
WHERE stddev_load > 0 AND abs(CAST(avg_load_mw AS DOUBLE) - mean_load) > 2 * stddev_load
"""

FLAGSHIP_CTES = f"WITH {W_CTE}, {E_CTE}, joined AS ({JOIN_SQL}), daily AS ({DAILY_SQL})"


@register("join_hourly", f"WITH {W_CTE}, {E_CTE} {JOIN_SQL}")
def q_join_hourly(spark, sf_dir):
    from gridlake.operators.join import join_hourly
    return join_hourly(tb.stage_weather(spark, sf_dir), tb.stage_energy(spark, sf_dir))


@register("daily_summary", f"{FLAGSHIP_CTES} SELECT * FROM daily")
def q_daily_summary(spark, sf_dir):
    from gridlake.operators.aggregate import daily_summary_from_load_rollup
    return daily_summary_from_load_rollup(tb.stage_weather(spark, sf_dir), tb.stage_energy(spark, sf_dir))


@register("daily_summary_rollups", f"{FLAGSHIP_CTES} SELECT * FROM daily")
def q_daily_summary_rollups(spark, sf_dir):
    from gridlake.operators.aggregate import daily_summary_from_sides
    return daily_summary_from_sides(tb.stage_weather(spark, sf_dir), tb.stage_energy(spark, sf_dir))


@register("daily_summary_joined", f"{FLAGSHIP_CTES} SELECT * FROM daily")
def q_daily_summary_joined(spark, sf_dir):
    from gridlake.operators.aggregate import daily_summary
    from gridlake.operators.join import join_hourly
    return daily_summary(join_hourly(tb.stage_weather(spark, sf_dir), tb.stage_energy(spark, sf_dir)))


@register("anomaly_days", f"{FLAGSHIP_CTES} {ANOMALY_SQL}")
def q_anomaly_days(spark, sf_dir):
    from gridlake.operators.anomaly import anomaly_days
    return anomaly_days(q_daily_summary(spark, sf_dir))


@register("anomaly_days_grouped", f"{FLAGSHIP_CTES} {ANOMALY_SQL}")
def q_anomaly_days_grouped(spark, sf_dir):
    from gridlake.operators.anomaly import anomaly_days_grouped
    return anomaly_days_grouped(q_daily_summary(spark, sf_dir))


# Scans, sinks, parsing, cleaning, quality and streaming entries register
# themselves on import.
from gridlake.plans import (catalog_incremental, catalog_lake, catalog_payloads, catalog_precise, catalog_quality,  # noqa: E402,F401
                            catalog_records, catalog_runs)
