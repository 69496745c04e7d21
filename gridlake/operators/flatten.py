"""Weather payload -> hourly records.

A payload row holds one city's response: context columns plus the struct
``hourly`` of parallel arrays.  ``inline(arrays_zip(...))`` turns index i
of every array into one row inside the task that read the payload, so
flattening never shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake import dims

# Source array -> record column (B2).  shortwave_radiation is requested by
# the source but not kept.
RENAMES = [("time", "time"), ("temperature_2m", "temperature"),
           ("relative_humidity_2m", "humidity"), ("wind_speed_10m", "wind_speed"),
           ("precipitation", "precipitation"), ("weather_code", "weather_code")]
CONTEXT = ["city_name", "country", "latitude", "longitude"]


def flatten_weather(payloads: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per hour: context columns (and ``keep``) + renamed measures + code text.

    ``weather`` is NULL for an unknown or NULL code (the source crashed on
    those); ``type_weather`` / ``unknown_codes`` route them to quarantine.
    """
    zipped = F.arrays_zip(*[F.col(f"hourly.{src}").alias(dst) for src, dst in RENAMES])
    rows = payloads.select(*CONTEXT, *(keep or []), F.inline(zipped))
    return rows.withColumn("weather", dims.weather_text(F.col("weather_code")))


def unknown_codes(rows: DataFrame) -> DataFrame:
    """Rows whose code has no text."""
    return rows.where(F.col("weather").isNull())


def lookup_codes_join(rows: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """E3 as a join: left join to the code dimension.

    The fixed 28-row table (default) is broadcast; a caller-supplied table
    is joined normally and broadcast by AQE only once its size is measured.
    """
    dim = F.broadcast(dims.dim_weather_code(rows.sparkSession)) if codes is None else codes
    return rows.drop("weather").join(dim, "weather_code", "left")
