"""Catalog entries for record encoding, decoding, quarantine, cleaning,
lookups and firsts (A8-A10, B3, B4, B14, B16-B18, C1, C2, D1-D6, D15-D17,
E2, E3, F8, H1, H2, J1, K, L6, L7, N3)."""

from __future__ import annotations


from pyspark.sql import functions as F

from gridlake import dims
from gridlake.functions.timefmt import compact_stamp, date_key, iso_offset, parse_iso
from gridlake.operators import records
from gridlake.operators.clean import clean_energy
from gridlake.plans import testbed as tb
from gridlake.plans.catalog import register
from gridlake.plans.catalog_common import ENERGY_COLS, E_SQL, W_SQL, YMD_SQL
from gridlake.session import shared_dir


# -- A10 / B17 / B18 -----------------------------------------------------------
@register("ndjson_roundtrip", f"SELECT city_name, country, time, load_mw FROM ({E_SQL})")
def q_ndjson_roundtrip(spark, sf_dir):
    landing = shared_dir(spark, "landing-ndjson")
    records.encode_records(tb.stage_energy(spark, sf_dir), "country").select("value").write.text(landing)
    typed = records.decode_energy(spark.read.text(landing))
    return records.valid_rows(typed).select(*ENERGY_COLS)


@register("single_quoted_decode", f"SELECT city_name, country, time, load_mw FROM ({E_SQL})")
def q_single_quoted_decode(spark, sf_dir):
    enc = records.encode_records(tb.stage_energy(spark, sf_dir))
    quoted = enc.select(F.translate("value", '"', "'").alias("value"))
    return records.valid_rows(records.decode_energy(quoted)).select(*ENERGY_COLS)

# -- L6 / L7 / N3 --------------------------------------------------------------
QUARANTINE_SQL = """
SELECT CASE WHEN event_type = 'purchase' THEN 'valid' ELSE 'quarantine' END AS status,
       CASE event_type WHEN 'error' THEN 'malformed_record' WHEN 'signup' THEN 'missing_time'
                       WHEN 'click' THEN 'bad_measure' WHEN 'view' THEN 'bad_time' ELSE 'ok' END AS reason,
       count(*) AS records
FROM events GROUP BY 1, 2
"""


def faulty_energy_records(spark, sf_dir):
    """Energy records with one kind of fault per event type."""
    ev = tb.events_with_city(spark, sf_dir)
    t = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    load = F.round(F.col("value") + 1000.0, 2).cast("string")
    et = F.col("event_type")
    good = F.struct("city_name", "country", t.alias("time"), load.alias("load_mw"))
    # error events: the record lost its closing brace (malformed JSON)
    value = (F.when(et == "error", F.regexp_replace(F.to_json(good), "}$", ""))
             .when(et == "signup", F.to_json(F.struct("city_name", "country", load.alias("load_mw"))))
             .when(et == "click", F.to_json(F.struct("city_name", "country", t.alias("time"),
                                                     F.lit("n/a").alias("load_mw"))))
             .when(et == "view", F.to_json(F.struct("city_name", "country", F.lit("junk").alias("time"),
                                                    load.alias("load_mw"))))
             .otherwise(F.to_json(good)))
    return ev.select(value.alias("value"))


@register("quarantine_counts", QUARANTINE_SQL)
def q_quarantine_counts(spark, sf_dir):
    typed = records.decode_energy(faulty_energy_records(spark, sf_dir))
    status = F.when(F.col("reason").isNull(), "valid").otherwise("quarantine")
    return (typed.groupBy(status.alias("status"), F.coalesce("reason", F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("records")))

# -- C1 / C2 / D1-D6 / J1 ------------------------------------------------------
CLEAN_SQL = f"""
SELECT city_name, country, time, max(load_mw) AS load_mw, {YMD_SQL}
FROM ({E_SQL}) GROUP BY city_name, country, time
"""


@register("clean_silver", CLEAN_SQL)
def q_clean_silver(spark, sf_dir):
    ev = tb.events_with_city(spark, sf_dir).where(F.col("event_type") == "purchase")
    load = F.round(F.col("value") + 1000.0, 2)
    naive = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zoned = F.concat(naive, F.lit("+00:00"))
    # copy 1: naive time, measure missing on some rows; copy 2: same instant
    # with an offset; copy 3: an older, lower reading of some hours.
    c1 = ev.select("city_name", "country", naive.alias("time"),
                   F.when(F.col("k") >= 10, load).alias("load_mw"))
    c2 = ev.select("city_name", "country", zoned.alias("time"), load.alias("load_mw"))
    c3 = ev.where(F.col("k") >= 90).select("city_name", "country", naive.alias("time"),
                                           (load - 1.0).alias("load_mw"))
    raw = c1.unionByName(c2).unionByName(c3)
    enc = records.encode_records(raw)
    return clean_energy(records.decode_energy(enc))

# -- K / B18 -------------------------------------------------------------------
@register("json_props", f"SELECT event_id, {tb.K_SQL} AS k FROM events")
def q_json_props(spark, sf_dir):
    ev = tb.events(spark, sf_dir)
    return ev.select("event_id", F.from_json("props", "k int")["k"].alias("k"))

# -- A8 / B4 / E2 --------------------------------------------------------------
@register("entity_enrich", f"SELECT event_id, city_name, country, latitude, longitude FROM ({tb.EVENTS_CITY_SQL})")
def q_entity_enrich(spark, sf_dir):
    from gridlake.operators.join import enrich_with_city
    ev = tb.events(spark, sf_dir).withColumn("ord", (F.col("user_id") % tb.N_CITIES).cast("int"))
    return enrich_with_city(ev).select(
        "event_id", "city_name", "country", "latitude", "longitude")

# -- A9 / B3 / E3 --------------------------------------------------------------
CODE_SQL = f"""
SELECT e.event_id, e.weather_code, codes.weather,
       CASE WHEN codes.weather IS NULL THEN 'quarantine' ELSE 'valid' END AS status
FROM (SELECT event_id, {tb.K_SQL} AS weather_code FROM events) e
LEFT JOIN {tb.codes_values_sql()} ON codes.weather_code = e.weather_code
"""


@register("code_lookup", CODE_SQL)
def q_code_lookup(spark, sf_dir):
    from gridlake.operators.flatten import lookup_codes_join
    ev = tb.events(spark, sf_dir).select("event_id", tb.props_k().alias("weather_code"))
    out = lookup_codes_join(ev)
    status = F.when(F.col("weather").isNull(), "quarantine").otherwise("valid")
    return out.select("event_id", "weather_code", "weather", status.alias("status"))


@register("code_lookup_map", CODE_SQL)
def q_code_lookup_map(spark, sf_dir):
    ev = tb.events(spark, sf_dir).select("event_id", tb.props_k().alias("weather_code"))
    text = dims.weather_text(F.col("weather_code"))
    status = F.when(text.isNull(), "quarantine").otherwise("valid")
    return ev.select("event_id", "weather_code", text.alias("weather"), status.alias("status"))

# -- B14 / B16 / H1 ------------------------------------------------------------
FIRST_SQL = """
SELECT s_nationkey, s_suppkey, s_name, s_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier)
WHERE rn = 1
"""


@register("first_per_group", FIRST_SQL)
def q_first_per_group(spark, sf_dir):
    from gridlake.operators.firsts import first_per_group
    sup = tb.table(spark, sf_dir, "supplier")
    return first_per_group(sup, ["s_nationkey"], ["s_suppkey"], ["s_suppkey", "s_name", "s_acctbal"])

# -- D15 / D16 / D17 -----------------------------------------------------------
ISO_SQL = """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso,
       strftime(ts, '%Y%m%dT%H%M') AS compact,
       'year=' || strftime(ts, '%Y') || '/month=' || strftime(ts, '%m') || '/day=' || strftime(ts, '%d') AS date_key,
       date_trunc('second', ts) AS reparsed
FROM events
"""


@register("iso_format", ISO_SQL)
def q_iso_format(spark, sf_dir):
    ev = tb.events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("t"))
    iso = iso_offset("t")
    return ev.select("event_id", iso.alias("iso"), compact_stamp("t").alias("compact"),
                     date_key("t").alias("date_key"), parse_iso(iso).alias("reparsed"))

# -- F8 / H2 ----------------------------------------------------------------------
@register("date_grouping", f"""
SELECT event_date, records, first_city_name, first_time, first_load_mw FROM (
  SELECT CAST(time AS DATE) AS event_date, count(*) OVER (PARTITION BY CAST(time AS DATE)) AS records,
         city_name AS first_city_name, time AS first_time, load_mw AS first_load_mw,
         row_number() OVER (PARTITION BY CAST(time AS DATE) ORDER BY time, city_name, load_mw) AS rn
  FROM ({E_SQL}))
WHERE rn = 1
""")
def q_date_grouping(spark, sf_dir):
    from gridlake.operators.firsts import per_date_first
    e = tb.stage_energy(spark, sf_dir)
    return per_date_first(e, "time", ["time", "city_name", "load_mw"], ["city_name", "time", "load_mw"])

# -- C1 / D3 / D5 ---------------------------------------------------------------------
CLEAN_WEATHER_SQL = f"""
SELECT w.city_name, w.country, w.latitude, w.longitude, w.time, w.temperature, w.humidity, w.wind_speed,
       w.precipitation, w.weather_code, codes.weather, {YMD_SQL.replace('time', 'w.time')}
FROM ({W_SQL}) w LEFT JOIN {tb.codes_values_sql()} ON codes.weather_code = w.weather_code
WHERE w.humidity >= 3
QUALIFY row_number() OVER (PARTITION BY w.city_name, w.country, w.time
                           ORDER BY w.temperature DESC, w.latitude DESC, w.longitude DESC, w.humidity DESC,
                                    w.wind_speed DESC, w.precipitation DESC, w.weather_code DESC) = 1
"""


@register("clean_weather_silver", CLEAN_WEATHER_SQL)
def q_clean_weather_silver(spark, sf_dir):
    from gridlake.operators.clean import clean_weather
    w = tb.stage_weather(spark, sf_dir)
    # temperature missing on some records (dropped, C1); every record twice
    nully = w.withColumn("temperature", F.when(F.col("humidity") >= 3, F.col("temperature")))
    enc = records.encode_records(nully.unionByName(nully))
    return clean_weather(records.decode_weather(enc))
