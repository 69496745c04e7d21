"""Catalog entries for payload parsing: resolutions, block means, load
documents (XML) and weather payloads (A6, A7, B1-B13, D19, F9)."""

from __future__ import annotations


from pyspark.sql import functions as F

from gridlake.functions.resolution import points_per_hour, resolution_reason
from gridlake.functions.timefmt import parse_iso, period_start
from gridlake.plans import testbed as tb
from gridlake.plans.catalog import half_up_sql, register, total_sql
from gridlake.plans.catalog_common import W_SQL
from gridlake.session import shared_dir
from gridlake.sources import payloads


# -- B8 / B9 / D19 -------------------------------------------------------------
RES_TEXT_SQL = f"""CASE event_type WHEN 'view' THEN 'PT15M' WHEN 'click' THEN 'PT30M'
  WHEN 'purchase' THEN 'PT60M' WHEN 'error' THEN 'P1D'
  ELSE CASE WHEN {tb.K_SQL} >= 95 THEN 'PT120M' ELSE 'PT' || CAST(({tb.K_SQL} % 7) * 10 AS VARCHAR) || 'M' END END"""
RESOLUTION_SQL = f"""
SELECT event_id, resolution,
  CASE WHEN NOT (resolution LIKE 'PT%' AND resolution LIKE '%M') THEN 1
       WHEN m IS NULL OR m = 0 OR m > 60 THEN NULL ELSE CAST(60 // m AS INTEGER) END AS points_per_hour,
  CASE resolution WHEN 'PT60M' THEN 1 WHEN 'PT30M' THEN 2 WHEN 'PT15M' THEN 4 END AS fixed_points,
  CASE WHEN NOT (resolution LIKE 'PT%' AND resolution LIKE '%M') THEN NULL
       WHEN m IS NULL THEN 'unparsable_resolution' WHEN m = 0 THEN 'zero_resolution'
       WHEN m > 60 THEN 'resolution_over_one_hour' END AS reason
FROM (SELECT event_id, resolution,
             TRY_CAST(NULLIF(regexp_extract(resolution, '^PT([0-9]+)M$', 1), '') AS BIGINT) AS m
      FROM (SELECT event_id, {RES_TEXT_SQL} AS resolution FROM events))
"""


def resolution_text():
    k = tb.props_k()
    et = F.col("event_type")
    return (F.when(et == "view", "PT15M").when(et == "click", "PT30M")
            .when(et == "purchase", "PT60M").when(et == "error", "P1D")
            .otherwise(F.when(k >= 95, "PT120M")
                       .otherwise(F.concat(F.lit("PT"), ((k % 7) * 10).cast("string"), F.lit("M")))))


@register("resolution_parse", RESOLUTION_SQL)
def q_resolution_parse(spark, sf_dir):
    ev = tb.events(spark, sf_dir).select("event_id", resolution_text().alias("resolution"))
    r = F.col("resolution")
    return ev.select("event_id", "resolution", points_per_hour(r).alias("points_per_hour"),
                     points_per_hour(r, strict=True).alias("fixed_points"),
                     resolution_reason(r).alias("reason"))

# -- B10 / B12 / B13 / F9 ------------------------------------------------------
BLOCK_SQL = f"""
SELECT event_type, day, block, day + to_hours(CAST(block AS BIGINT)) AS time,
       {half_up_sql('s', '4')} AS load_mw, points
FROM (
  SELECT event_type, day, i // 4 AS block, {total_sql('value')} AS s, count(*) AS points
  FROM (SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, value,
               row_number() OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts, event_id) - 1 AS i
        FROM events)
  GROUP BY 1, 2, 3)
WHERE points = 4
"""


@register("block_mean", BLOCK_SQL)
def q_block_mean(spark, sf_dir):
    from gridlake.operators.blocks import block_means
    ev = tb.events(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts"))
    return block_means(ev, ["event_type", "day"], ["ts", "event_id"], "value", 4, "day")

# -- A7 / B5-B8 / B11-B13 ------------------------------------------------------
DOC_POINTS = 96
# Fixed value: default XML namespace of load documents (IEC 62325-451-6); parsing ignores it.
XML_NS = "urn:iec62325.351:tc57wg16:451-6:generationloaddocument:3:0"
XML_SQL = f"""
WITH base AS (
  SELECT event_type, ts, event_id, value, {tb.K_SQL} AS k,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i
  FROM events),
chunks AS (SELECT *, i // {DOC_POINTS} AS chunk FROM base),
starts AS (SELECT event_type, chunk, date_trunc('hour', min(ts)) AS start FROM chunks GROUP BY 1, 2),
valid AS (SELECT *, row_number() OVER (PARTITION BY event_type, chunk ORDER BY i) - 1 AS vpos
          FROM chunks WHERE k < 95 AND event_type <> 'error'),
sized AS (SELECT *, CASE event_type WHEN 'view' THEN 4 WHEN 'click' THEN 2 ELSE 1 END AS n FROM valid),
blocks AS (SELECT event_type, chunk, n, vpos // n AS block, {total_sql('value')} AS s,
                  count(*) AS c FROM sized GROUP BY 1, 2, 3, 4)
SELECT {{city}} AS city_name, b.event_type AS country,
       st.start + to_hours(CAST(b.block AS BIGINT)) AS time,
       {half_up_sql('b.s', 'b.n')} AS load_mw
FROM blocks b JOIN starts st ON st.event_type = b.event_type AND st.chunk = b.chunk
WHERE b.c = b.n
"""


def _indexed_points(spark, sf_dir):
    from gridlake.operators.sequence import index_within_group
    ev = tb.events(spark, sf_dir).withColumn("k", tb.props_k())
    return index_within_group(ev, ["event_type"], ["ts", "event_id"], "i")


def _quantity(value=None):
    value = F.col("value") if value is None else value
    return F.when(F.col("k") < 95, value.cast("string")).otherwise(F.lit("n/a"))


def _resolution_of(et):
    return (F.when(et == "view", "PT15M").when(et == "click", "PT30M").when(et == "purchase", "PT60M")
            .when(et == "error", "PT120M"))


def load_documents(spark, sf_dir, points=DOC_POINTS, value=None):
    """Landed load documents built from events: one per ``points`` (a day's
    96 unless given) consecutive points of an event type, so no document
    grows with the table."""
    idx = _indexed_points(spark, sf_dir)
    qty = _quantity(value)
    point = F.format_string("<Point><position>%d</position><quantity>%s</quantity></Point>",
                            (F.col("i") % points + 1).cast("int"), qty)
    docs = (idx.groupBy("event_type", (F.col("i") / points).cast("long").alias("chunk"))
            .agg(F.min("ts").alias("first_ts"), F.collect_list(F.struct("i", point.alias("p"))).alias("pts")))
    et = F.col("event_type")
    res = (F.when(et == "view", "<resolution>PT15M</resolution>")
           .when(et == "click", "<resolution>PT30M</resolution>")
           .when(et == "purchase", "<resolution>PT60M</resolution>")
           .when(et == "error", "<resolution>PT120M</resolution>").otherwise(""))
    body = F.array_join(F.transform(F.array_sort("pts"), lambda s: s["p"]), "")
    xml = F.concat(F.lit(f'<Publication_MarketDocument xmlns="{XML_NS}"><TimeSeries><Period>'
                         "<timeInterval><start>"),
                   period_start(F.date_trunc("hour", F.col("first_ts").cast("timestamp"))),
                   F.lit("</start></timeInterval>"), res, body,
                   F.lit("</Period></TimeSeries></Publication_MarketDocument>"))
    return docs.select(et.alias("country"),
                       F.concat(et, F.lit("-"), F.col("chunk").cast("string")).alias("city_name"),
                       xml.alias("xml"))


@register("xml_block_mean", XML_SQL.replace("{city}", "b.event_type || '-' || CAST(b.chunk AS VARCHAR)"))
def q_xml_block_mean(spark, sf_dir):
    from gridlake.operators.loadxml import load_records
    landing = shared_dir(spark, "landing-load")
    payloads.write_landed(load_documents(spark, sf_dir), landing)
    return load_records(payloads.read_load_payloads(spark, landing))


def load_periods(spark, sf_dir):
    """The same documents as ``load_documents``, as ``Period`` rows for
    the XML writer (one folder per event type)."""
    idx = _indexed_points(spark, sf_dir)
    et = F.col("event_type")
    point = F.struct((F.col("i") % DOC_POINTS + 1).cast("int").alias("position"), _quantity().alias("quantity"))
    per = (idx.groupBy("event_type", (F.col("i") / DOC_POINTS).cast("long").alias("chunk"))
           .agg(F.min("ts").alias("first_ts"), F.collect_list(F.struct("i", point.alias("p"))).alias("pts")))
    start = period_start(F.date_trunc("hour", F.col("first_ts").cast("timestamp")))
    return per.select(et.alias("country"), et.alias("city_name"),
                      F.struct(start.alias("start"), F.lit(None).cast("string").alias("end")).alias("timeInterval"),
                      _resolution_of(et).alias("resolution"),
                      F.transform(F.array_sort("pts"), lambda x: x["p"]).alias("Point"))


@register("xml_files_block_mean", XML_SQL.replace("{city}", "b.event_type"))
def q_xml_files_block_mean(spark, sf_dir):
    from gridlake.operators.loadxml import load_records_from_files
    root = shared_dir(spark, "landing-load-xml")
    payloads.write_load_xml_files(load_periods(spark, sf_dir), root)
    return load_records_from_files(spark, root)

# -- A6 / B1 / B2 / B3 / B4 ----------------------------------------------------
PAYLOAD_HOURS = 24
FLATTEN_SQL = f"""
SELECT w.city_name, w.country, w.time, w.temperature, w.humidity, w.wind_speed, w.precipitation,
       w.weather_code, codes.weather
FROM ({W_SQL}) w LEFT JOIN {tb.codes_values_sql()} ON codes.weather_code = w.weather_code
"""


def weather_payloads(spark, sf_dir):
    """Landed weather responses built from staged weather rows: one per 24
    consecutive hours of a city, the measures as parallel arrays."""
    from gridlake.operators.sequence import index_within_group
    w = tb.stage_weather(spark, sf_dir, with_id=True)
    idx = index_within_group(w, ["city_name"], ["time", "event_id"], "i")
    entry = F.struct("i", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"),
                     "temperature", "humidity", "wind_speed", "precipitation", "weather_code")
    grouped = (idx.groupBy("city_name", "country", "latitude", "longitude",
                           (F.col("i") / PAYLOAD_HOURS).cast("long").alias("chunk"))
               .agg(F.array_sort(F.collect_list(entry)).alias("e")))

    def arr(field):
        return F.transform("e", lambda x: x[field])

    hourly = F.struct(arr("time").alias("time"), arr("temperature").alias("temperature_2m"),
                      arr("humidity").alias("relative_humidity_2m"), arr("wind_speed").alias("wind_speed_10m"),
                      arr("precipitation").alias("precipitation"), arr("weather_code").alias("weather_code"),
                      F.transform("e", lambda x: F.lit(None).cast("double")).alias("shortwave_radiation"))
    return grouped.select("city_name", "country", "latitude", "longitude", hourly.alias("hourly"))


@register("flatten_arrays", FLATTEN_SQL)
def q_flatten_arrays(spark, sf_dir):
    from gridlake.operators.flatten import flatten_weather
    landing = shared_dir(spark, "landing-weather")
    payloads.write_landed(weather_payloads(spark, sf_dir), landing)
    rows = flatten_weather(payloads.read_weather_payloads(spark, landing))
    return rows.select("city_name", "country", parse_iso("time").alias("time"), "temperature", "humidity",
                       "wind_speed", "precipitation", "weather_code", "weather")


XML_QUARANTINE_SQL = f"""
SELECT 'energy' AS source, 'resolution_over_one_hour' AS reason, count(DISTINCT i // {DOC_POINTS}) AS documents
FROM (SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events)
WHERE event_type = 'error'
"""


@register("xml_quarantine_counts", XML_QUARANTINE_SQL)
def q_xml_quarantine_counts(spark, sf_dir):
    """B6/Q13 on driver data: periods that cannot be downsampled, by reason."""
    from gridlake.operators.loadxml import rejected_documents
    landing = shared_dir(spark, "landing-load-q")
    payloads.write_landed(load_documents(spark, sf_dir), landing)
    rejected = rejected_documents(payloads.read_load_payloads(spark, landing))
    return rejected.groupBy("source", "reason").agg(F.count(F.lit(1)).alias("documents"))
