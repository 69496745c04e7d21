"""Catalog entries for runs over what is new: ledgers, late days, keyed
quarantine, compaction, incremental statistics, bucketed joins, candidate
names, silver merges and stateful block means
(A5, A6, A7, A10, A13, B11, B16, E1, G1, G2, J1, J2, L1, L5, N3, N6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import records
from gridlake.plans import testbed as tb
from gridlake.plans.catalog import ANOMALY_SQL, E_CTE, FLAGSHIP_CTES, JOIN_SQL, W_CTE, register
from gridlake.plans.catalog_common import ENERGY_COLS, E_SQL, W_SQL
from gridlake.plans.catalog_payloads import BLOCK_SQL, XML_SQL, load_documents, weather_payloads
from gridlake.plans.catalog_runs import DAILY_RUN_SQL, per_event_load_documents
from gridlake.session import shared_dir
from gridlake.sources import lake, messages, payloads

# Load readings of some hours arrive late, in a landing of their own (whole hours of a city,
# so that no two landings hold readings of one hour).
LATE_SQL = "(hour(time) = 13 AND day(time) % 5 = 0)"


def _land_weather(spark, sf_dir, paths):
    payloads.write_landed(weather_payloads(spark, sf_dir).repartition("city_name"), paths.landing_weather)


def _land_loads(spark, sf_dir, paths, late: bool):
    """One landing of load documents, one file for all documents of a city."""
    docs = per_event_load_documents(spark, sf_dir, keep=F.expr(LATE_SQL) == late)
    docs.repartition("city_name").write.mode("append").json(paths.landing_energy)


# -- L5 / N6: a late record rebuilds its own day ----------------------------------
@register("late_day_rebuild", f"""
SELECT d.*, CASE WHEN l.day IS NULL THEN 1 ELSE 2 END AS generation
FROM ({DAILY_RUN_SQL}) d
LEFT JOIN (SELECT DISTINCT CAST(time AS DATE) AS day FROM ({E_SQL}) WHERE {LATE_SQL}) l ON l.day = d.activity_date
""")
def q_late_day_rebuild(spark, sf_dir):
    """Two runs over what is new: the second lands the late hours and rebuilds
    their days alone (``generation``: the run that a day was published by)."""
    from gridlake.plans.daily import Paths, published
    from gridlake.plans.incremental import run_pending
    from gridlake.sources import snapshots
    paths = Paths(shared_dir(spark, "late-days"))
    _land_weather(spark, sf_dir, paths)
    _land_loads(spark, sf_dir, paths, False)
    run_pending(spark, paths.root)
    _land_loads(spark, sf_dir, paths, True)
    second = run_pending(spark, paths.root)["run"]
    parts = snapshots.manifest(spark, paths.gold_root).where("name = 'mart_daily_demand_summary'").select(
        F.split("part", "=")[1].cast("date").alias("activity_date"),
        F.when(F.col("run") == second, 2).otherwise(1).alias("generation"))
    return published(spark, paths, "mart_daily_demand_summary").join(parts, "activity_date") \
        .select(*schemas.DAILY_MART.fieldNames(), "generation")


# -- A6 / A7: each file version is parsed once ----------------------------------------
@register("landing_increment", f"""
SELECT * FROM (
  SELECT 1 AS landing, 'weather' AS source, count(*) AS rows FROM ({W_SQL})
  UNION ALL SELECT 1, 'energy', count(*) FROM ({E_SQL}) WHERE NOT {LATE_SQL}
  UNION ALL SELECT 2, 'energy', count(*) FROM ({E_SQL}) WHERE {LATE_SQL}) WHERE rows > 0
""")
def q_landing_increment(spark, sf_dir):
    """Rows that each of three landings wrote; nothing is new for the third."""
    from gridlake.plans.daily import SOURCES, Paths
    from gridlake.plans.incremental import land_new
    from gridlake.sources.ledger import Ledger
    paths = Paths(shared_dir(spark, "landing-increment"))
    _land_weather(spark, sf_dir, paths)
    _land_loads(spark, sf_dir, paths, False)
    land_new(spark, paths, "landing1")
    _land_loads(spark, sf_dir, paths, True)
    land_new(spark, paths, "landing2")
    land_new(spark, paths, "landing3")
    ledger = Ledger(spark, paths.root)
    touched = ledger.touched(SOURCES[0]).unionByName(ledger.touched(SOURCES[1]))
    return touched.groupBy(F.substring("mark", 8, 1).cast("int").alias("landing"), "source").agg(F.sum("rows").alias("rows"))


# -- N3: one row for a record, none once it is mended -------------------------------
def _bad_loads(spark, sf_dir, mended: bool):
    """Load records of the error events with a measure that is no number;
    mended: those of k below 50 have one."""
    ev = tb.events_with_city(spark, sf_dir).where("event_type = 'error'")
    good = F.col("k") < 50 if mended else F.lit(False)
    return ev.select("city_name", "country", F.col("ts").alias("time"),
                     F.when(good, F.col("value").cast("string")).otherwise(F.concat(F.lit("n/a "), "event_id")).alias("load_mw"))


def _span_days(spark, sf_dir):
    span = tb.events(spark, sf_dir).agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi")).first()
    return [span.lo + dt.timedelta(days=i) for i in range((span.hi - span.lo).days + 1)]


def _bad_bronze(spark, sf_dir, paths, mended: bool):
    lake.write_bronze(tb.stage_energy(spark, sf_dir).withColumn("load_mw", F.col("load_mw").cast("string"))
                      .unionByName(_bad_loads(spark, sf_dir, mended)), paths.at("bronze", "energy"), mode="overwrite", batch="given")


def _open_by_day(spark, paths):
    from gridlake.sources import quarantine
    return quarantine.open_rows(spark, paths.at("quarantine", "energy")).groupBy("event_date", "reason").agg(
        F.count(F.lit(1)).alias("records"), F.sum("copies").alias("copies"))


@register("quarantine_rerun", """
SELECT CAST(ts AS DATE) AS event_date, 'bad_measure' AS reason, count(*) AS records, CAST(count(*) AS BIGINT) AS copies
FROM events WHERE event_type = 'error' GROUP BY 1
""")
def q_quarantine_rerun(spark, sf_dir):
    """Runs over overlapping days (a third of them, then all) file each bad record once."""
    from gridlake.plans.daily import Paths, silver_days
    paths, days = Paths(shared_dir(spark, "quarantine-rerun")), _span_days(spark, sf_dir)
    _bad_bronze(spark, sf_dir, paths, False)
    silver_days(spark, paths, days[::3])
    silver_days(spark, paths, days)
    return _open_by_day(spark, paths)


@register("quarantine_upsert", f"""
SELECT CAST(ts AS DATE) AS event_date, 'bad_measure' AS reason, count(*) AS records, CAST(count(*) AS BIGINT) AS copies
FROM (SELECT *, {tb.K_SQL} AS k FROM events) WHERE event_type = 'error' AND k >= 50 GROUP BY 1
""")
def q_quarantine_upsert(spark, sf_dir):
    """The records of k below 50 are mended at their source and judged again: only the others stay."""
    from gridlake.plans.daily import Paths, silver_days
    paths, days = Paths(shared_dir(spark, "quarantine-upsert")), _span_days(spark, sf_dir)
    _bad_bronze(spark, sf_dir, paths, False)
    silver_days(spark, paths, days)
    _bad_bronze(spark, sf_dir, paths, True)
    silver_days(spark, paths, days)
    return _open_by_day(spark, paths)


@register("quarantine_replay", f"""
SELECT c.city_name, c.country, ts AS time, round(value, 2) AS load_mw
FROM (SELECT * FROM events WHERE event_type = 'error') e JOIN {tb.CITY_VALUES_SQL.replace('AS dim_city(', 'AS c(')}
  ON c.ord = e.user_id % {tb.N_CITIES}
""")
def q_quarantine_replay(spark, sf_dir):
    """Records that carry a unit are quarantined; a mend strips it and the replay accepts them all."""
    from gridlake.plans.daily import Paths, silver_days
    from gridlake.sources import quarantine
    paths = Paths(shared_dir(spark, "quarantine-replay"))
    given = tb.events_with_city(spark, sf_dir).where("event_type = 'error'").select(
        "city_name", "country", F.col("ts").alias("time"), F.concat(F.round("value", 2).cast("string"), F.lit(" MW")).alias("load_mw"))
    lake.write_bronze(given, paths.at("bronze", "energy"), mode="overwrite", batch="given")
    silver_days(spark, paths, _span_days(spark, sf_dir))
    root = paths.at("quarantine", "energy")
    rows, _ = quarantine.replay(spark, root, "energy", records.decode_energy,
                                lambda d: d.withColumn("value", F.replace("value", F.lit(" MW"))))
    return rows.select(*ENERGY_COLS)


# -- B11: a quantity that cannot be published rejects its period ---------------------
OVER_SQL = f"""
WITH numbered AS (SELECT event_type, {tb.K_SQL} AS k,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events),
over AS (SELECT DISTINCT event_type || '-' || CAST(i // 96 AS VARCHAR) AS city_name FROM numbered
         WHERE k = 37 AND event_type <> 'error')
SELECT 'quantity_over_limit' AS outcome, count(*) AS n FROM over
UNION ALL SELECT 'resolution_over_one_hour', count(DISTINCT i // 96) FROM numbered WHERE event_type = 'error'
UNION ALL SELECT 'landed hours', count(*) FROM ({XML_SQL.replace("{city}", "b.event_type || '-' || CAST(b.chunk AS VARCHAR)")}) x
          WHERE city_name NOT IN (SELECT city_name FROM over)
"""


@register("points_over_limit", OVER_SQL)
def q_points_over_limit(spark, sf_dir):
    """Points of k = 37 are too large to publish: their periods land no hours and are filed with the reason."""
    from gridlake.operators.loadxml import hourly_from_periods, parse_documents, periods, rejected_from_parsed
    landing = shared_dir(spark, "landing-over")
    value = F.when(F.col("k") == 37, F.col("value") + 2e8).otherwise(F.col("value"))
    payloads.write_landed(load_documents(spark, sf_dir, value=value), landing)
    parsed = parse_documents(payloads.read_load_payloads(spark, landing))
    hours = hourly_from_periods(periods(parsed)).select(F.lit("landed hours").alias("outcome"))
    return rejected_from_parsed(parsed).select(F.col("reason").alias("outcome")).unionByName(hours) \
        .groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


# -- B6: documents that do not parse -------------------------------------------------
@register("xml_malformed", """
SELECT CASE WHEN event_type = 'click' THEN 'malformed_xml' ELSE 'empty_payload' END AS reason, count(*) AS documents
FROM (SELECT DISTINCT event_type, i // 96 AS chunk FROM (
  SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i FROM events))
WHERE event_type IN ('click', 'signup') GROUP BY 1
""")
def q_xml_malformed(spark, sf_dir):
    """Truncated and empty documents beside whole ones."""
    from gridlake.operators.loadxml import rejected_documents
    landing = shared_dir(spark, "landing-malformed")
    docs = load_documents(spark, sf_dir)
    cut = F.when(F.col("country") == "click", F.substring("xml", 1, 150)).when(F.col("country") == "signup", F.lit(" ")) \
        .otherwise(F.col("xml"))
    payloads.write_landed(docs.withColumn("xml", cut), landing)
    found = rejected_documents(payloads.read_load_payloads(spark, landing))
    return found.where("reason IN ('malformed_xml', 'empty_payload')").groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))


# -- A10 / L1: compacted days hold the same records -----------------------------------
def _four_batches(spark, sf_dir, base):
    """Purchase events landed by four micro-batches, each over all days; the encoded parts."""
    from gridlake.streaming.ingest import land_stream
    rows = tb.events_with_city(spark, sf_dir).where("event_type = 'purchase'").select(
        "event_id", "city_name", "country", F.col("ts").alias("time"), F.round(F.col("value") + 1000.0, 2).alias("load_mw"))
    for part in range(4):
        mine = rows.where(F.col("event_id") % 4 == part).drop("event_id")
        records.encode_records(mine, time_col="time").select("value").repartition(1).write.text(f"{base}/landing/part={part}")
    land_stream(messages.read_topic(spark, fmt="text", path=f"{base}/landing/*", max_per_trigger=1), "energy",
                f"{base}/bronze", f"{base}/quarantine", f"{base}/_checkpoint").awaitTermination()


def compacted_bronze(spark, sf_dir, base):
    """Four batches, compacted; then the first is replayed."""
    from gridlake.sources.compaction import compact
    from gridlake.streaming.ingest import land_batch, stream_tag
    _four_batches(spark, sf_dir, base)
    days = _span_days(spark, sf_dir)
    compact(spark, f"{base}/bronze", f"{base}/folded", days[0].isoformat(), (days[-1] + dt.timedelta(days=1)).isoformat())
    replayed = spark.read.text(f"{base}/landing/part=0").select("value")
    land_batch(replayed, 0, "energy", f"{base}/bronze", f"{base}/quarantine", stream=stream_tag(f"{base}/_checkpoint"))


@register("bronze_compacted", f"SELECT city_name, country, time, load_mw FROM ({E_SQL})")
def q_bronze_compacted(spark, sf_dir):
    from gridlake.sources import compaction
    base = shared_dir(spark, "compacted")
    compacted_bronze(spark, sf_dir, base)
    text = spark.read.text(f"{base}/bronze")
    live = compaction.live(text, compaction.folded(spark, f"{base}/folded"))
    return records.valid_rows(records.decode_energy(live.select("value"))).select(*ENERGY_COLS)


# -- G1 / G2 / C6: statistics after a restated day --------------------------------------
@register("anomaly_incremental", f"{FLAGSHIP_CTES} {ANOMALY_SQL}")
def q_anomaly_incremental(spark, sf_dir):
    """Moments of a mart with every seventh day of the month wrong; those days
    are restated: old moments out, new ones in."""
    from gridlake.functions.numeric import STORED_TOTAL_DECIMAL
    from gridlake.operators import moments
    from gridlake.operators.aggregate import daily_summary_from_load_rollup
    base = shared_dir(spark, "moments")
    daily_summary_from_load_rollup(tb.stage_weather(spark, sf_dir), tb.stage_energy(spark, sf_dir), STORED_TOTAL_DECIMAL) \
        .write.parquet(f"{base}/daily")
    daily = spark.read.schema(schemas.DAILY_STEP).parquet(f"{base}/daily")
    wrong, restated = F.dayofmonth("activity_date") % 7 == 0, daily.where(F.dayofmonth("activity_date") % 7 == 0)
    first = moments.day_moments(daily.withColumn("avg_load_mw", F.when(wrong, F.col("avg_load_mw") * 3).otherwise(
        F.col("avg_load_mw")).cast("decimal(10,2)")))
    first.write.parquet(f"{base}/moments")
    stored = spark.read.schema(moments.MOMENTS).parquet(f"{base}/moments")
    moments.totals_of(stored).write.parquet(f"{base}/totals")
    fresh = moments.day_moments(restated)
    totals = moments.replaced_totals(spark.read.schema(moments.TOTALS).parquet(f"{base}/totals"), stored.where(wrong), fresh)
    candidates = moments.candidate_days(stored.where(~wrong).unionByName(fresh), totals)
    return moments.flagged(daily, candidates)


# -- E1: a join of co-partitioned tables ---------------------------------------------
@register("join_bucketed", f"WITH {W_CTE}, {E_CTE} {JOIN_SQL}")
def q_join_bucketed(spark, sf_dir):
    from gridlake.sources.bucketed import join_bucketed, write_bucketed
    base = shared_dir(spark, "bucketed")
    name = base.rsplit("-", 1)[1]
    write_bucketed(tb.stage_weather(spark, sf_dir), f"weather_{name}", f"{base}/weather", 8)
    write_bucketed(tb.stage_energy(spark, sf_dir), f"energy_{name}", f"{base}/energy", 8)
    return join_bucketed(spark, f"weather_{name}", f"energy_{name}")


# -- B16 / Q10: names from landed candidates -------------------------------------------
@register("resolve_landed", f"""
SELECT city_name AS resolved_name, country AS resolved_country, latitude, longitude, count(*) AS rows
FROM ({W_SQL}) GROUP BY ALL
""")
def q_resolve_landed(spark, sf_dir):
    """Spellings by case, accents, punctuation and white space; each city has
    a homonym of another country that the service ranks first."""
    from gridlake.operators.resolve import candidate_index, read_candidates, resolve_names
    base = shared_dir(spark, "candidates")
    w = tb.stage_weather(spark, sf_dir)

    def candidate(name, country, lat, lon, people):
        return F.struct(name.alias("name"), country.alias("country_code"), lat.alias("latitude"), lon.alias("longitude"),
                        F.lit(people).cast("long").alias("population"))

    c = {n: F.col(n) for n in ("city_name", "country", "latitude", "longitude")}
    cities = w.select(*c).distinct()
    cities.select(F.lower("city_name").alias("query"), F.array(
        candidate(c["city_name"], F.lit("US"), c["latitude"] - 1, c["longitude"] - 1, 900),
        candidate(F.concat(c["city_name"], F.lit(" Airport")), c["country"], c["latitude"] + 1, c["longitude"] + 1, 0),
        candidate(c["city_name"], c["country"], c["latitude"], c["longitude"], 500)).alias("results")) \
        .write.json(f"{base}/answers")
    spelled = F.when(F.col("humidity") % 4 == 0, F.upper("city_name")) \
        .when(F.col("humidity") % 4 == 1, F.translate("city_name", "aeiou", "áèîöü")) \
        .when(F.col("humidity") % 4 == 2, F.concat(F.lit("  "), "city_name", F.lit(". "))).otherwise(F.col("city_name"))
    rows = w.select(spelled.alias("city_name"), "country")
    index = candidate_index(read_candidates(spark, f"{base}/answers"))
    return resolve_names(rows, index).groupBy("resolved_name", "resolved_country", "latitude", "longitude").agg(
        F.count(F.lit(1)).alias("rows"))


# -- J1 / J2: corrections merged into silver ---------------------------------------------
@register("restated_load", f"""
SELECT city_name, country, ts AS time,
       CASE WHEN count(*) FILTER (k % 5 = 0) > 0 THEN max(round(value + 1100.0, 2)) FILTER (k % 5 = 0)
            ELSE max(round(value + 1000.0, 2)) END AS load_mw
FROM ({tb.EVENTS_CITY_SQL}) WHERE event_type = 'purchase' GROUP BY 1, 2, 3
""")
def q_restated_load(spark, sf_dir):
    """A first load, a later batch that corrects the readings of k % 5 = 0,
    and a replay of the first batch, which is older and changes nothing."""
    from gridlake.sources.merge import merge_silver
    base = shared_dir(spark, "restated")
    ev = tb.events_with_city(spark, sf_dir).where("event_type = 'purchase'")

    def batch(rows, plus, hours):
        return rows.select("city_name", "country", F.col("ts").cast("timestamp").alias("time"),
                           F.round(F.col("value") + plus, 2).alias("load_mw"),
                           (F.col("ts").cast("timestamp") + F.make_interval(hours=F.lit(hours))).alias("ingest_ts"))

    for step, rows in enumerate((batch(ev, 1000.0, 1), batch(ev.where("k % 5 = 0"), 1100.0, 48), batch(ev, 1000.0, 1))):
        merge_silver(spark, f"{base}/silver", rows, schemas.SILVER_ENERGY, "load_mw", f"{base}/staging{step}")
    return spark.read.schema(schemas.SILVER_ENERGY).parquet(f"{base}/silver").select(*ENERGY_COLS)


# -- B10 / L1 / L5: block means over a stream of points ------------------------------------
@register("stream_block_mean", BLOCK_SQL)
def q_stream_block_mean(spark, sf_dir):
    """Points arrive over four landings, every fifth one a day late."""
    from gridlake.streaming.blocks import block_stream, latest_blocks, write_blocks
    base = shared_dir(spark, "stream-blocks")
    points = tb.events(spark, sf_dir).select("event_type", F.col("ts").cast("timestamp").alias("ts"), "event_id", "value") \
        .withColumn("arrival", F.col("ts") + F.make_interval(days=F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)))
    span = points.agg(F.min("arrival").alias("lo"), F.max("arrival").alias("hi")).first()
    if span["lo"] is not None:
        width = (span["hi"] - span["lo"]) / 4
        for i in range(4):
            inside = F.col("arrival") >= F.lit(span["lo"] + i * width) if i else F.lit(True)
            before = F.col("arrival") < F.lit(span["lo"] + (i + 1) * width) if i < 3 else F.lit(True)
            points.where(inside & before).drop("arrival").repartition(1).write.parquet(f"{base}/landing/part={i}")
    given = spark.readStream.schema(points.drop("arrival").schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/landing/*")
    write_blocks(block_stream(given, 4), f"{base}/out", f"{base}/_checkpoint").awaitTermination()
    return latest_blocks(spark.read.parquet(f"{base}/out"), 4)


# -- A1 / A5 / F6: the weather stream and what it reports ------------------------------------
def _weather_stream(spark, sf_dir, base):
    from gridlake.plans.catalog_runs import arrivals
    from gridlake.streaming.ingest import land_stream
    good = records.encode_records(tb.stage_weather(spark, sf_dir), time_col="time")
    arrivals(good, 4).write.text(f"{base}/landing")
    tb.events(spark, sf_dir).where("event_type = 'error'").select(F.concat(F.lit('{"time": '), "event_id").alias("value")) \
        .write.mode("append").text(f"{base}/landing")
    land_stream(messages.read_topic(spark, fmt="text", path=f"{base}/landing", max_per_trigger=3), "weather", f"{base}/bronze",
                f"{base}/quarantine", f"{base}/_checkpoint", report_root=f"{base}/report").awaitTermination()


@register("stream_ingest_weather", f"""
SELECT city_name, country, time, temperature, humidity, wind_speed, precipitation, weather_code FROM ({W_SQL})
""")
def q_stream_ingest_weather(spark, sf_dir):
    base = shared_dir(spark, "stream-weather")
    _weather_stream(spark, sf_dir, base)
    text = spark.read.text(f"{base}/bronze").select("value")
    return records.valid_rows(records.decode_weather(text)).select(
        "city_name", "country", "time", "temperature", "humidity", "wind_speed", "precipitation", "weather_code")


@register("stream_report", f"""
SELECT 'weather' AS source, (SELECT count(*) FROM ({W_SQL})) AS written,
       (SELECT count(*) FROM events WHERE event_type = 'error') AS rejected
""")
def q_stream_report(spark, sf_dir):
    base = shared_dir(spark, "stream-report")
    _weather_stream(spark, sf_dir, base)
    return spark.read.parquet(f"{base}/report").groupBy("source").agg(
        F.sum("written").alias("written"), F.sum("rejected").alias("rejected"))


# -- D21: wall clocks of another zone ------------------------------------------------------
@register("zone_times", """
SELECT event_id, ts AS wall, (ts AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC' AS utc_time FROM events
""")
def q_zone_times(spark, sf_dir):
    from gridlake.functions.timefmt import utc_wall_clock
    return tb.events(spark, sf_dir).select("event_id", F.col("ts").alias("wall"),
                                           utc_wall_clock("ts", "Europe/Berlin").alias("utc_time"))
