"""Read the driver's parquet tables as the pipeline's domain tables.

Mapping (kept identical in every oracle SQL text):

* city        = the fixed city list, entry ``user_id % 9``
* weather row = an ``events`` row with ``event_type = 'view'``
    temperature = value - 20, humidity = props.k, wind_speed = |value - 100|,
    precipitation = max(value - 100, 0), weather_code = props.k % 4
  (measures rounded to 2 decimals, so that no binary noise is in them)
* load row    = an ``events`` row with ``event_type = 'purchase'``,
    load_mw = value + 1000
* time        = ``ts``
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import dims
from gridlake.session import apply_pipeline_conf

N_CITIES = len(dims.CITIES)


_TABLES: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a lazy DataFrame.

    The handle (a plan, no data) is kept per session and path, so repeated
    queries skip listing the read-only files again.
    """
    apply_pipeline_conf(spark)
    key = (id(spark), sf_dir.rstrip("/"), name)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _TABLES[key] = df
    return df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _with_city(df: DataFrame, spark: SparkSession) -> DataFrame:
    """City columns of entry ``user_id % 9`` as an in-expression array lookup
    (a 9-entry constant): no join, no exchange, one codegen stage."""
    city = F.element_at(dims.city_array(), (F.col("user_id") % N_CITIES).cast("int") + 1)
    return df.select("*", *[city[c].alias(c) for c in ["city_name", "country", "latitude", "longitude"]])


def humidity_of(props="props"):
    return F.get_json_object(F.col(props), "$.k").cast("int")


def stage_weather(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    """stg_weather over the driver tables (silver weather columns, no y/m/d)."""
    ev = events(spark, sf_dir).where(F.col("event_type") == "view")
    v = F.col("value")
    hum = humidity_of()
    out = _with_city(ev, spark).select(*(["event_id"] if with_id else []),
        "city_name", "country", "latitude", "longitude", F.col("ts").alias("time"),
        F.round(v - 20.0, 2).alias("temperature"), hum.alias("humidity"),
        F.round(F.abs(v - 100.0), 2).alias("wind_speed"),
        F.round(F.greatest(v - 100.0, F.lit(0.0)), 2).alias("precipitation"),
        (hum % 4).alias("weather_code"))
    return out.withColumn("weather", dims.weather_text(F.col("weather_code")))


def stage_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stg_energy over the driver tables."""
    ev = events(spark, sf_dir).where(F.col("event_type") == "purchase")
    return _with_city(ev, spark).select("city_name", "country", F.col("ts").alias("time"),
                                        F.round(F.col("value") + 1000.0, 2).alias("load_mw"))


# SQL text of the same mapping, shared by every oracle query.
CITY_VALUES_SQL = "(VALUES " + ", ".join(
    f"({i}, '{c}', '{k}', CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))" for i, c, k, lat, lon in dims.city_rows()
) + ") AS dim_city(ord, city_name, country, latitude, longitude)"

STAGE_WEATHER_SQL = f"""
SELECT c.city_name, c.country, c.latitude, c.longitude, e.ts AS time,
       round(e.value - 20.0, 2) AS temperature,
       CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS humidity,
       round(abs(e.value - 100.0), 2) AS wind_speed,
       round(greatest(e.value - 100.0, 0.0), 2) AS precipitation,
       CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 4 AS weather_code
FROM events e JOIN {CITY_VALUES_SQL} ON c.ord = e.user_id % {N_CITIES}
WHERE e.event_type = 'view'
""".replace("AS dim_city(", "AS c(")

STAGE_ENERGY_SQL = f"""
SELECT c.city_name, c.country, e.ts AS time, round(e.value + 1000.0, 2) AS load_mw
FROM events e JOIN {CITY_VALUES_SQL} ON c.ord = e.user_id % {N_CITIES}
WHERE e.event_type = 'purchase'
""".replace("AS dim_city(", "AS c(")


def props_k():
    return F.get_json_object(F.col("props"), "$.k").cast("int")


K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
EVENTS_CITY_SQL = f"""
SELECT e.*, {K_SQL} AS k, c.city_name, c.country, c.latitude, c.longitude
FROM events e JOIN {CITY_VALUES_SQL} ON c.ord = e.user_id % {N_CITIES}
""".replace("AS dim_city(", "AS c(")


def events_with_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_city(events(spark, sf_dir), spark).withColumn("k", props_k())


def codes_values_sql(alias: str = "codes") -> str:
    rows = ", ".join(f"({k}, '{v}')" for k, v in sorted(dims.WEATHER_CODES.items()))
    return f"(VALUES {rows}) AS {alias}(weather_code, weather)"
