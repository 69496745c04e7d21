"""Every schema used by the package, spelled out (no inference at read)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DIM_CITY = _struct(("ord", I), ("city_name", S), ("country", S), ("latitude", D), ("longitude", D))
DIM_WEATHER_CODE = _struct(("weather_code", I), ("weather", S))

# Weather payload (landed API response with its context columns).
WEATHER_HOURLY = _struct(
    ("time", T.ArrayType(S)),
    ("temperature_2m", T.ArrayType(D)),
    ("relative_humidity_2m", T.ArrayType(I)),
    ("wind_speed_10m", T.ArrayType(D)),
    ("precipitation", T.ArrayType(D)),
    ("weather_code", T.ArrayType(I)),
    ("shortwave_radiation", T.ArrayType(D)),
)
WEATHER_PAYLOAD = _struct(("city_name", S), ("country", S), ("latitude", D), ("longitude", D),
                          ("hourly", WEATHER_HOURLY))

# Load payload: nested XML tree (namespace ignored).
# both as text: a bad value voids its point, not the document
LOAD_POINT = _struct(("position", S), ("quantity", S))
LOAD_PERIOD = _struct(
    ("timeInterval", _struct(("start", S), ("end", S))),
    ("resolution", S),
    ("Point", T.ArrayType(LOAD_POINT)),
)
LOAD_DOCUMENT = _struct(("TimeSeries", T.ArrayType(_struct(("Period", T.ArrayType(LOAD_PERIOD))))))
LOAD_LANDED = _struct(("country", S), ("city_name", S), ("xml", S))

# Stream records: measures arrive as strings so that a bad value is caught
# by try_cast instead of failing the whole read.
WEATHER_RECORD = _struct(
    ("city_name", S), ("country", S), ("latitude", S), ("longitude", S), ("time", S),
    ("temperature", S), ("humidity", S), ("wind_speed", S), ("precipitation", S),
    ("weather_code", S), ("weather", S), ("ingest_ts", S),
)
ENERGY_RECORD = _struct(("city_name", S), ("country", S), ("time", S), ("load_mw", S), ("ingest_ts", S))
# ``ingest_ts`` (arrival time on the topic) is optional: it decides which copy
# of a duplicated record survives in silver (latest arrival wins).

# Silver tables.
SILVER_WEATHER = _struct(
    ("city_name", S), ("country", S), ("latitude", D), ("longitude", D),
    ("time", T.TimestampType()), ("temperature", D), ("humidity", I), ("wind_speed", D),
    ("precipitation", D), ("weather_code", I), ("weather", S), ("year", I), ("month", I), ("day", I),
)
SILVER_ENERGY = _struct(("city_name", S), ("country", S), ("time", T.TimestampType()),
                        ("load_mw", D), ("year", I), ("month", I), ("day", I))

WEATHER_MEASURES = ["temperature", "humidity", "wind_speed", "precipitation", "weather_code"]
WEATHER_KEY = ["city_name", "country", "time"]
ENERGY_KEY = ["city_name", "country", "time"]

QUARANTINE = _struct(("source", S), ("raw", S), ("reason", S), ("event_date", T.DateType()))
CHECK_RESULT = _struct(("table", S), ("column", S), ("check", S), ("failures", L))

# Published marts (with their partition column where they have one).
DEC = T.DecimalType(10, 2)
JOINED_MART = _struct(("city_name", S), ("country", S), ("time", T.TimestampType()), ("temperature", D), ("humidity", I),
                      ("wind_speed", D), ("precipitation", D), ("weather_code", I), ("load_mw", D),
                      ("activity_date", T.DateType()))
DAILY_MART = _struct(("city_name", S), ("country", S), ("activity_date", T.DateType()),
                     *[(f"{how}_{what}", DEC) for what in ("temperature", "humidity") for how in ("avg", "min", "max")],
                     ("avg_wind_speed", DEC), ("avg_precipitation", DEC),
                     *[(f"{how}_load_mw", DEC) for how in ("min", "max", "avg", "total")])
# The daily mart as a step to other marts: its totals need not fit the published type.
DAILY_STEP = _struct(*[(f.name, T.DecimalType(24, 2) if f.name == "total_load_mw" else f.dataType) for f in DAILY_MART])
ANOMALY_MART = _struct(("country", S), ("activity_date", T.DateType()), ("avg_load_mw", DEC), ("mean_load", D),
                       ("stddev_load", D), ("deviation_score", D))
