"""Bronze -> silver cleaning.

Order differs from the source jobs on purpose: records are typed and
null rows dropped *before* the deduplication, so a null copy can never
win over a good one (Q2), and the key uses the parsed instant, so
``T00:00`` and ``T00:00:00+00:00`` are the same hour (Q3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators.dedup import keep_one

SILVER_WEATHER_COLUMNS = ["city_name", "country", "latitude", "longitude", "time", "temperature",
                          "humidity", "wind_speed", "precipitation", "weather_code", "weather",
                          "year", "month", "day"]
SILVER_ENERGY_COLUMNS = ["city_name", "country", "time", "load_mw", "year", "month", "day"]
KEY = ["city_name", "country", "time"]


def with_date_parts(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Year / month / day-of-month of the (UTC) event time."""
    return (df.withColumn("year", F.year(time_col)).withColumn("month", F.month(time_col))
            .withColumn("day", F.dayofmonth(time_col)))


def clean_energy(typed: DataFrame, prefer: list | None = None) -> DataFrame:
    """C2 + J1 + D4 + D6 on typed energy rows (output of ``type_energy``)."""
    rows = typed.where(F.col("reason").isNull()) if "reason" in typed.columns else typed
    rows = rows.dropna(subset=["city_name", "country", "time", "load_mw"])
    extra = [c for c in ["ingest_ts"] if c in rows.columns]
    rows = rows.select(*KEY, "load_mw", *extra)
    # latest arrival first, then the larger reading, then the whole row
    survivors = keep_one(rows, KEY, prefer or extra + ["load_mw"])
    return with_date_parts(survivors).select(*SILVER_ENERGY_COLUMNS)


def clean_weather(typed: DataFrame, prefer: list | None = None) -> DataFrame:
    """C1 + J1 + D4 + D5 on typed weather rows (output of ``type_weather``)."""
    rows = typed.where(F.col("reason").isNull()) if "reason" in typed.columns else typed
    rows = rows.dropna(subset=["city_name", "country", "time", "temperature"])
    extra = [c for c in ["ingest_ts"] if c in rows.columns]
    rows = rows.select(*SILVER_WEATHER_COLUMNS[:11], *extra)
    survivors = keep_one(rows, KEY, prefer or extra + ["temperature"])
    return with_date_parts(survivors).select(*SILVER_WEATHER_COLUMNS)
