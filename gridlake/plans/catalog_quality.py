"""Catalog entries for data-quality checks."""

from __future__ import annotations


from pyspark.sql import functions as F

from gridlake import dims
from gridlake.plans import testbed as tb
from gridlake.plans.catalog import register
from gridlake.plans.catalog_common import E_SQL, W_SQL


# -- N1 / N2 / N4 ----------------------------------------------------------------
NULLY_W_SQL = f"""
SELECT city_name, country, time,
       CASE WHEN humidity >= 3 THEN temperature END AS temperature,
       CASE WHEN humidity < 3 OR humidity > 5 THEN humidity END AS humidity,
       wind_speed, CASE WHEN humidity < 97 THEN precipitation END AS precipitation, weather_code
FROM ({W_SQL})
"""
NOT_NULL_COLS = ["city_name", "country", "time", "temperature", "humidity", "wind_speed",
                 "precipitation", "weather_code"]
DQ_NOT_NULL_SQL = f"WITH w AS ({NULLY_W_SQL}) " + " UNION ALL ".join(
    f"SELECT 'stg_weather' AS \"table\", '{c}' AS \"column\", 'not_null' AS \"check\", "
    f"CAST(count(*) - count({c}) AS BIGINT) AS failures FROM w" for c in NOT_NULL_COLS)


@register("dq_not_null", DQ_NOT_NULL_SQL)
def q_dq_not_null(spark, sf_dir):
    from gridlake.operators.quality import not_null
    w = tb.stage_weather(spark, sf_dir)
    h = F.col("humidity")
    nully = w.select("city_name", "country", "time",
                     F.when(h >= 3, F.col("temperature")).alias("temperature"),
                     F.when((h < 3) | (h > 5), h).alias("humidity"), "wind_speed",
                     F.when(h < 97, F.col("precipitation")).alias("precipitation"), "weather_code")
    return not_null(nully, "stg_weather", NOT_NULL_COLS)


ACCEPTED_LIST_SQL = ", ".join(f"'{c}'" for c in dims.ACCEPTED_COUNTRIES)


@register("dq_accepted_values", f"""
SELECT country AS value, count(*) AS failures FROM ({E_SQL})
WHERE country IS NOT NULL AND country NOT IN ({ACCEPTED_LIST_SQL}) GROUP BY country
""")
def q_dq_accepted_values(spark, sf_dir):
    from gridlake.operators.quality import rejected_values
    return rejected_values(tb.stage_energy(spark, sf_dir), "country")


@register("dq_accepted_summary", f"""
SELECT 'stg_energy' AS "table", 'country' AS "column", 'accepted_values' AS "check",
       CAST(count(*) FILTER (WHERE country IS NOT NULL AND country NOT IN ({ACCEPTED_LIST_SQL})) AS BIGINT) AS failures
FROM ({E_SQL})
""")
def q_dq_accepted_summary(spark, sf_dir):
    from gridlake.operators.quality import accepted_values
    return accepted_values(tb.stage_energy(spark, sf_dir), "stg_energy", "country")


@register("dq_unique_key", f"""
SELECT 'stg_energy' AS "table", 'city_name|country|time' AS "column", 'unique' AS "check",
       CAST(count(*) AS BIGINT) AS failures
FROM (SELECT city_name, country, time FROM ({E_SQL}) GROUP BY 1, 2, 3 HAVING count(*) > 1)
""")
def q_dq_unique_key(spark, sf_dir):
    from gridlake.operators.quality import unique_key
    return unique_key(tb.stage_energy(spark, sf_dir), "stg_energy", ["city_name", "country", "time"])


@register("partition_ready", f"""
SELECT city_name, CAST(time AS DATE) AS event_date, count(*) AS rows,
       count(DISTINCT hour(time)) AS hours, count(DISTINCT hour(time)) >= 24 AS complete
FROM ({E_SQL}) GROUP BY 1, 2
""")
def q_partition_ready(spark, sf_dir):
    from gridlake.operators.quality import partition_ready
    return partition_ready(tb.stage_energy(spark, sf_dir), by=["city_name"])
