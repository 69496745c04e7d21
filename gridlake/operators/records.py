"""Stream records: encode (B17), decode (B18), validate and quarantine
(L6, L7, N3, B3, D1-D3).

A record is one city-hour as JSON text.  Decoding never fails the job:
malformed text, a missing or unparsable time, a measure that is not a plain
publishable number (``NaN``, ``Infinity``, ``1d``, ``1e30``) or an unknown weather code each become a quarantine row with a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake import dims, schemas
from gridlake.functions.numeric import measure
from gridlake.functions.timefmt import parse_iso

CORRUPT = "_corrupt_record"

WEATHER_DOUBLES = ["latitude", "longitude", "temperature", "wind_speed", "precipitation"]
WEATHER_INTS = ["humidity", "weather_code"]


def encode_records(df: DataFrame, key_col: str | None = None, time_col: str | None = None) -> DataFrame:
    """``(key, value)`` rows, value = ``to_json`` of all columns.

    Timestamps are rendered in ISO-8601 with offset so any reader can
    parse them.  ``time_col`` also keeps that column as ``_event_time``
    (for ordering or partitioning the messages).
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias(f.name)
                        if isinstance(f.dataType, T.TimestampType)
                        else F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(f.name))
        else:
            cols.append(F.col(f.name))
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    extra = [F.col(time_col).alias("_event_time")] if time_col else []
    return df.select(key.alias("key"), F.to_json(F.struct(*cols)).alias("value"), *extra)


def decode_records(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """JSON text -> columns of ``schema`` plus ``_corrupt_record``.

    Single-quoted (Python ``str(dict)``) records are read as JSON without
    rewriting quotes, so ``Val d'Oise`` stays intact; a bare ``None`` makes
    the record corrupt.  The raw text is kept in ``raw``.
    """
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    parsed = F.from_json(F.col(value_col), full,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
                          "allowSingleQuotes": "true"})
    names = set(full.fieldNames())
    keep = [c for c in df.columns if c != value_col and c not in names]
    # A column that arrives next to the text (e.g. the topic's ingest time)
    # fills the field when the record itself does not carry it.
    beside = {c for c in df.columns if c != value_col and c in names}

    def field(name: str):
        got = F.col(f"_r.{name}")
        return (F.coalesce(got, F.col(f"_in_{name}").cast("string")) if name in beside else got).alias(name)

    # ``explode(array(x))`` makes the parsed struct a generator output: a later
    # filter on its fields (e.g. ``reason IS NULL``) cannot be pushed below it
    # and inline ``from_json``, so every record is parsed exactly once.
    return (df.select(*keep, *[F.col(c).alias(f"_in_{c}") for c in beside],
                      F.col(value_col).alias("raw"), F.explode(F.array(parsed)).alias("_r"))
            .select(*keep, "raw", *[field(f.name) for f in full.fields]))


def _passthrough(decoded: DataFrame, schema_cols: list[str]) -> list[str]:
    """Columns that came with the record (key, ingest time, ...)."""
    skip = set(schema_cols) | {"raw", CORRUPT}
    return [c for c in decoded.columns if c not in skip]


def _ingest(decoded: DataFrame) -> Column:
    if "ingest_ts" in decoded.columns:
        return parse_iso("ingest_ts").alias("ingest_ts")
    return F.lit(None).cast("timestamp").alias("ingest_ts")


def _num(col: str, typ: str) -> Column:
    return measure(col) if typ == "double" else F.col(col).try_cast(typ)


def _reason_chain(pairs: list[tuple[Column, str]]) -> Column:
    out = F.lit(None).cast("string")
    for cond, reason in reversed(pairs):
        out = F.when(cond, F.lit(reason)).otherwise(out)
    return out


def type_energy(decoded: DataFrame) -> DataFrame:
    """Typed energy columns plus ``reason`` (NULL = valid)."""
    t = parse_iso("time")
    load = _num("load_mw", "double")
    reason = _reason_chain([
        (F.col(CORRUPT).isNotNull(), "malformed_record"),
        (F.col("time").isNull(), "missing_time"),
        (F.col("city_name").isNull() | F.col("country").isNull(), "missing_key"),
        (t.isNull(), "bad_time"),
        (F.col("load_mw").isNotNull() & load.isNull(), "bad_measure"),
    ])
    extra = _passthrough(decoded, schemas.ENERGY_RECORD.fieldNames())
    return decoded.select(*extra, "raw", "city_name", "country", t.alias("time"), load.alias("load_mw"),
                          _ingest(decoded), reason.alias("reason"))


def type_weather(decoded: DataFrame, check_codes: bool = True) -> DataFrame:
    """Typed weather columns plus ``reason``; the text comes from the code."""
    t = parse_iso("time")
    typed = {c: _num(c, "double") for c in WEATHER_DOUBLES}
    typed.update({c: _num(c, "int") for c in WEATHER_INTS})
    text = dims.weather_text(typed["weather_code"])
    bad_measure = F.lit(False)
    for c, v in typed.items():
        bad_measure = bad_measure | (F.col(c).isNotNull() & v.isNull())
    checks = [
        (F.col(CORRUPT).isNotNull(), "malformed_record"),
        (F.col("time").isNull(), "missing_time"),
        (F.col("city_name").isNull() | F.col("country").isNull(), "missing_key"),
        (t.isNull(), "bad_time"),
        (bad_measure, "bad_measure"),
    ]
    if check_codes:
        checks.append((text.isNull(), "unknown_weather_code"))
    extra = _passthrough(decoded, schemas.WEATHER_RECORD.fieldNames())
    return decoded.select(
        *extra, "raw", "city_name", "country", typed["latitude"].alias("latitude"),
        typed["longitude"].alias("longitude"), t.alias("time"),
        typed["temperature"].alias("temperature"), typed["humidity"].alias("humidity"),
        typed["wind_speed"].alias("wind_speed"), typed["precipitation"].alias("precipitation"),
        typed["weather_code"].alias("weather_code"),
        F.coalesce(text, F.col("weather")).alias("weather"), _ingest(decoded),
        _reason_chain(checks).alias("reason"))


def valid_rows(typed: DataFrame) -> DataFrame:
    """Accepted records (typed columns, plus ``ingest_ts`` and pass-through columns)."""
    return typed.where(F.col("reason").isNull()).drop("reason", "raw")


def quarantine_rows(typed: DataFrame, source: str, *keep: str) -> DataFrame:
    """``source, raw, reason, event_date`` for every rejected record (and
    the columns ``keep`` that came with it)."""
    return typed.where(F.col("reason").isNotNull()).select(
        F.lit(source).alias("source"), "raw", "reason", F.to_date("time").alias("event_date"), *keep)


def decode_energy(df: DataFrame, value_col: str = "value") -> DataFrame:
    return type_energy(decode_records(df, schemas.ENERGY_RECORD, value_col))


def decode_weather(df: DataFrame, value_col: str = "value") -> DataFrame:
    return type_weather(decode_records(df, schemas.WEATHER_RECORD, value_col))
