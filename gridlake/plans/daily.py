"""The daily run (N5) and the range backfill (N6) as Spark jobs.

Folder layout under one root URI::

    landing/weather      weather payloads (JSON lines)        A6
    landing/energy       load documents (country, city, xml)  A7
    bronze/{weather,energy}/year=/month=/day=/batch=          A10
    folded/{weather,energy}/                                  bronze compaction
    quarantine/{weather,energy}/part=                         N3
    silver/{weather,energy}/year=/month=/day=                 A13
    ledger/              landed files, touched and consumed days
    staging/<run>/...    parsed documents and typed records of one run
    gold/<mart>/run=<run>/<part>, gold/_manifests             published snapshots

Every step covers a set of *days* in one job (a range, or the days that
late records touched: ``plans.incremental``).  Silver is written with dynamic
partition overwrite, and days that a rerun no longer fills are removed, so
rerunning replaces exactly its partitions.  Bronze days hold one
sub-partition per writer, so a landing replaces its own rows and no
stream's.  Marts are written beside the published ones and checked there;
then one manifest moves all of them at once (``sources.snapshots``), so
readers (``published``) see the old set or the new one, never a mixture (Q12).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridlake import dims, schemas
from gridlake.functions.timefmt import parse_iso
from gridlake.operators import moments, quality, records
from gridlake.operators.aggregate import daily_summary
from gridlake.operators.clean import clean_energy, clean_weather
from gridlake.operators.flatten import flatten_weather
from gridlake.operators.join import join_hourly
from gridlake.operators.loadxml import hourly_from_periods, parse_documents, periods, rejected_from_parsed
from gridlake.sources import compaction, lake, payloads, quarantine, snapshots
from gridlake.sources.lake import BRONZE_TEXT
from gridlake.sources.ledger import Ledger, days_of
from gridlake.sources.tables import materialise_view

SOURCES = ("weather", "energy")
CLEAN_MEASURE = {"weather": "temperature", "energy": "load_mw"}      # silver rows hold it (D5, D6)
LANDED = "landed"            # the batch landing's own sub-partition of a bronze day
# The columns that the published data tests check.
NOT_NULL = {
    "stg_weather": ["city_name", "country", "time", "temperature"],
    "stg_energy": ["city_name", "country", "time", "load_mw"],
    "int_weather_energy_joined": ["city_name", "country", "time", "temperature", "humidity",
                                  "wind_speed", "precipitation", "weather_code", "load_mw"],
    "mart_daily_demand_summary": ["city_name", "country", "activity_date", "avg_temperature",
                                  "min_temperature", "max_temperature", "avg_humidity", "min_humidity",
                                  "max_humidity", "avg_wind_speed", "avg_precipitation", "min_load_mw",
                                  "max_load_mw", "avg_load_mw", "total_load_mw"],
    "mart_anomaly_days": ["country", "activity_date", "avg_load_mw", "mean_load", "stddev_load"],
}


@dataclass
class Paths:
    root: str

    def at(self, layer: str, source: str) -> str:
        """``landing`` / ``bronze`` / ``quarantine`` / ``silver`` folder of a source."""
        return f"{self.root}/{layer}/{source}"

    @property
    def landing_weather(self) -> str:
        return self.at("landing", "weather")

    @property
    def landing_energy(self) -> str:
        return self.at("landing", "energy")

    @property
    def silver_energy(self) -> str:
        return self.at("silver", "energy")

    @property
    def quarantine_energy(self) -> str:
        return self.at("quarantine", "energy")

    @property
    def gold_root(self) -> str:
        return f"{self.root}/gold"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def staging(self, run_id: str, table: str) -> str:
        return f"{self.root}/staging/{run_id}/{table}"


def _of_days(df: DataFrame, days: list[dt.date], day) -> DataFrame:
    """Rows whose ``day`` is one of ``days`` (C4/C5: a range is half-open)."""
    lo, hi = min(days), max(days)
    inside = (day >= F.lit(lo)) & (day <= F.lit(hi))
    return df.where(inside if (hi - lo).days + 1 == len(set(days)) else day.isin(list(days)))


# -- landing -> bronze (bounded payloads; the stream path is streaming.ingest) --

def stage_landing(spark: SparkSession, paths: Paths, run_id: str, weather_from, energy_from) -> dict[str, DataFrame]:
    """The landed files (a folder, or a list of files; None: nothing)
    parsed once into staged tables: weather payloads and load documents."""
    staged = {}
    if weather_from:
        parsed = payloads.read_weather_payloads(spark, weather_from, with_corrupt=True)
        parsed.write.mode("overwrite").parquet(paths.staging(run_id, "weather_payloads"))
        staged["weather"] = spark.read.schema(parsed.schema).parquet(paths.staging(run_id, "weather_payloads"))
    if energy_from:
        parsed = parse_documents(payloads.read_load_payloads(spark, energy_from))
        # keep the raw text only where it explains a rejection
        (parsed.withColumn("raw", F.when(F.col("doc_reason").isNotNull(), F.col("raw")))
         .write.mode("overwrite").parquet(paths.staging(run_id, "load_documents")))
        staged["energy"] = spark.read.schema(parsed.schema).parquet(paths.staging(run_id, "load_documents"))
    return staged


def landed_rows(source: str, staged: DataFrame, canonical_names: bool = True) -> DataFrame:
    """Bronze records of staged weather payloads or load documents."""
    if source == "weather":
        rows = flatten_weather(staged, ["ingest_ts", "source_file"])
    else:
        rows = hourly_from_periods(periods(staged)).select("city_name", "country", "time", "load_mw", "ingest_ts", "source_file")
    return dims.canonical_city_names(rows) if canonical_names else rows


def landed_rejects(source: str, staged: DataFrame) -> DataFrame:
    if source == "energy":
        return rejected_from_parsed(staged)
    return payloads.rejected_weather(staged, flatten_weather(staged, ["ingest_ts", "source_file"]))


def event_day(source: str):
    return F.to_date(F.col("time") if source == "energy" else parse_iso("time"))


def land_payloads(spark: SparkSession, paths: Paths, start: str, end: str,
                  run_id: str | None = None, canonical_names: bool = True) -> dict[str, int]:
    """A6/A7 -> B* -> A10: all landed files, the hours of the range into
    bronze (``plans.incremental.land_new`` parses only new files).  Files are
    parsed once; rows, rejects and days come from the staged tables."""
    run_id = run_id or uuid.uuid4().hex[:12]
    days, ledger, counts = lake.range_days(start, end), Ledger(spark, paths.root), {}
    staged = stage_landing(spark, paths, run_id, paths.landing_weather, paths.landing_energy)
    for source in SOURCES:
        day = event_day(source)
        rows = _of_days(landed_rows(source, staged[source], canonical_names), days, day)
        obs = Observation(f"bronze_{source}")
        lake.write_bronze(rows.observe(obs, F.count(F.lit(1)).alias("rows")),
                          paths.at("bronze", source), mode="overwrite", batch=LANDED)
        counts[source] = lake.observed_rows(obs)
        written = days_of(rows, day)
        lake.drop_empty_days(spark, paths.at("bronze", source), written, days, f"/batch={LANDED}")
        ledger.touch(source, written, LANDED, run_id)
        # what cannot be landed does not depend on the range: all files were judged
        known = quarantine.open_rows(spark, paths.at("quarantine", source)).where(F.col("origin").startswith("file:"))
        _quarantine(spark, paths, source, landed_rejects(source, staged[source]), known.select("origin"), run_id, "land")
    return counts


def _quarantine(spark: SparkSession, paths: Paths, source: str, rejects: DataFrame, scope: DataFrame,
                run_id: str, step: str) -> None:
    quarantine.merge(spark, paths.at("quarantine", source), rejects, scope,
                     paths.staging(run_id, f"quarantine_{step}_{source}"), dt.datetime.now())


# -- bronze -> silver ----------------------------------------------------------------

def bronze_text(spark: SparkSession, paths: Paths, source: str, days: list[dt.date]) -> DataFrame:
    """(value, year, month, day, batch) of the bronze records that count:
    not those of folded batches, nor of landed files that came again."""
    text = lake.read_days(spark, paths.at("bronze", source), days, "text", BRONZE_TEXT)
    if "batch" not in text.columns:
        text = text.withColumn("batch", F.lit(None).cast("string"))
    text = compaction.live(text, compaction.folded(spark, paths.at("folded", source)))
    old = Ledger(spark, paths.root).superseded(source)
    if old.isEmpty():
        return text
    named = text.withColumn("_file", F.get_json_object("value", "$.source_file")) \
        .withColumn("_at", parse_iso(F.get_json_object("value", "$.ingest_ts")))
    return named.join(old.toDF("_file", "_at"), ["_file", "_at"], "left_anti").drop("_file", "_at")


def bronze_origin():
    """Quarantine origin of a bronze record: its day."""
    return F.concat(F.lit("bronze:"), F.make_date("year", "month", "day").cast("string"))


def silver_days(spark: SparkSession, paths: Paths, days: list[dt.date], run_id: str | None = None) -> dict[str, int]:
    """Decode, type, quarantine, clean and deduplicate some days (C*, D*, J1).

    Records are decoded once into a staged table; silver (valid rows) and
    the quarantine (rejected rows with their raw text) both read it.
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    out = {}
    for source in SOURCES:
        text = bronze_text(spark, paths, source, days)
        decode = records.decode_weather if source == "weather" else records.decode_energy
        typed = decode(text.select("value", bronze_origin().alias("origin")))
        staged_path = paths.staging(run_id, f"typed_{source}")
        (typed.withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))
         .write.mode("overwrite").parquet(staged_path))
        staged = spark.read.schema(typed.schema).parquet(staged_path)
        clean = clean_weather if source == "weather" else clean_energy
        obs = Observation(f"silver_{source}")
        lake.write_partitioned(clean(staged), paths.at("silver", source), observation=obs)
        filled = staged.where(F.col("reason").isNull() & F.col(CLEAN_MEASURE[source]).isNotNull())
        lake.drop_empty_days(spark, paths.at("silver", source), filled.select(F.to_date("time").alias("event_date")), days)
        judged = spark.createDataFrame([(f"bronze:{d.isoformat()}",) for d in days], "origin string")
        _quarantine(spark, paths, source, records.quarantine_rows(staged, source, "origin"), judged, run_id, "silver")
        out[source] = lake.observed_rows(obs)
    return out


def silver_step(spark: SparkSession, paths: Paths, start: str, end: str, run_id: str | None = None) -> dict[str, int]:
    """``silver_days`` of the range ``[start, end)``."""
    return silver_days(spark, paths, lake.range_days(start, end), run_id)


# -- silver -> marts ---------------------------------------------------------------

def build_anomaly(daily: DataFrame, candidates: DataFrame) -> DataFrame:
    """The anomaly mart's rows of the rebuilt countries."""
    return moments.flagged(daily, candidates)


def marts_days(spark: SparkSession, paths: Paths, days: list[dt.date],
               accepted_countries: list[str] | None = None, run_id: str | None = None) -> DataFrame:
    """Rebuild the marts of some days: write all of them into the run's own
    folders, check them, then publish them in one step (Q12).  Returns the
    check results.

    The daily mart aggregates the written join (silver holds one reading per
    key, so the join is 1:1 and is computed once).  Country statistics are
    kept as moments per (country, day) and country totals: the old moments
    of the days are taken out, the new ones added.  Anomalies are built anew
    for the countries of these days only, from the days whose moments lie
    outside their country's band; no other published day is read.
    """
    run_id, gold = run_id or uuid.uuid4().hex[:12], paths.gold_root
    base = snapshots.current(spark, gold)
    w = lake.read_days(spark, paths.at("silver", "weather"), days, "parquet", schemas.SILVER_WEATHER)
    e = lake.read_days(spark, paths.at("silver", "energy"), days, "parquet", schemas.SILVER_ENERGY)
    added = []

    def written(name: str, rows: DataFrame, by: str | None) -> DataFrame:
        path = snapshots.part_folder(gold, name, run_id)
        if by:
            lake.write_partitioned(rows, path, partition_cols=[by])
        else:
            rows.write.mode("overwrite").parquet(f"{path}/{snapshots.WHOLE}")
        back = spark.read.schema(rows.schema).parquet(path if by else f"{path}/{snapshots.WHOLE}")
        part = F.concat(F.lit(f"{by}="), F.col(by).cast("string")) if by else F.lit(snapshots.WHOLE)
        parts = back.select(part.alias("part")).distinct() if by else spark.range(1).select(part.alias("part"))
        added.append(parts.select(F.lit(name).alias("name"), "part"))
        return back

    joined = written("int_weather_energy_joined", join_hourly(w, e).withColumn("activity_date", F.to_date("time")), "activity_date")
    daily = written("mart_daily_demand_summary", daily_summary(joined), "activity_date")

    months = sorted({f"month={d:%Y-%m}" for d in days})
    mine = F.col("activity_date").isin(list(days))
    before = snapshots.read_version(spark, gold, "country_day_moments", moments.MOMENTS, base, months)
    fresh, old = moments.day_moments(daily), before.where(mine)
    kept = written("country_day_moments", before.where(~mine).unionByName(fresh), "month")
    totals = written("country_totals", moments.replaced_totals(
        snapshots.read_version(spark, gold, "country_totals", moments.TOTALS, base), old, fresh), None)
    other = snapshots.read_version(spark, gold, "country_day_moments", moments.MOMENTS, base) \
        .where(~F.concat(F.lit("month="), "month").isin(months))
    changed = old.select("country").union(fresh.select("country")).distinct()
    open_days = moments.candidate_days(kept.unionByName(other).join(changed, "country", "left_semi"), totals)
    outside = open_days.where(~mine).select("activity_date").distinct().collect()         # a few of the published days
    published_days = snapshots.read_version(spark, gold, "mart_daily_demand_summary", schemas.DAILY_MART, base,
                                            [f"activity_date={r['activity_date']}" for r in outside])
    columns = ["country", "activity_date", "avg_load_mw"]
    again = build_anomaly(daily.select(*columns).unionByName(published_days.select(*columns)), open_days)
    others = snapshots.read_version(spark, gold, "mart_anomaly_days", schemas.ANOMALY_MART, base).join(changed, "country", "left_anti")
    anomaly = written("mart_anomaly_days", again.unionByName(others, allowMissingColumns=True), None)

    allowed = accepted_countries if accepted_countries is not None else [k for _, k in dims.CITIES]
    checks = quality.run_checks(
        {"stg_weather": (w, NOT_NULL["stg_weather"]), "stg_energy": (e, NOT_NULL["stg_energy"]),
         "int_weather_energy_joined": (joined, NOT_NULL["int_weather_energy_joined"]),
         "mart_daily_demand_summary": (daily, NOT_NULL["mart_daily_demand_summary"]),
         "mart_anomaly_days": (anomaly, NOT_NULL["mart_anomaly_days"])},
        countries={"stg_weather": "country", "stg_energy": "country"}, accepted=allowed).cache()
    quality.assert_passed(checks)
    by_day = [(name, f"activity_date={d.isoformat()}") for d in days
              for name in ("int_weather_energy_joined", "mart_daily_demand_summary")]
    replaced = spark.createDataFrame(by_day + [("country_day_moments", m) for m in months], "name string, part string")
    parts = added[0]
    for rows in added[1:]:
        parts = parts.unionByName(rows)
    snapshots.publish(spark, gold, base, run_id, replaced, parts)
    return checks


def marts_step(spark: SparkSession, paths: Paths, start: str, end: str,
               accepted_countries: list[str] | None = None, run_id: str | None = None) -> DataFrame:
    """``marts_days`` of the range ``[start, end)``."""
    return marts_days(spark, paths, lake.range_days(start, end), accepted_countries, run_id)


MARTS = {"int_weather_energy_joined": schemas.JOINED_MART, "mart_daily_demand_summary": schemas.DAILY_MART,
         "mart_anomaly_days": schemas.ANOMALY_MART}


def published(spark: SparkSession, paths: Paths, name: str, version: int | None = None) -> DataFrame:
    """A published mart, as of the current (or an earlier) version."""
    if snapshots.current(spark, paths.gold_root) == 0:
        raise LookupError(f"nothing is published in {paths.gold_root}")
    rows = snapshots.read_version(spark, paths.gold_root, name, MARTS[name], version)
    return rows.select(*MARTS[name].fieldNames())


def register_marts(spark: SparkSession, root: str, database: str = "default") -> None:
    """The published marts by name: two tables whose partitions are
    the folders of the published version, and the anomaly mart as a view."""
    paths = Paths(root.rstrip("/"))
    parts = snapshots.manifest(spark, paths.gold_root)
    for name in ("int_weather_energy_joined", "mart_daily_demand_summary"):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MARTS[name])
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet PARTITIONED BY (activity_date) "
                  f"LOCATION '{paths.gold(name)}'")
        mine = [(r["part"].split("=", 1)[1], snapshots.part_folder(paths.gold_root, name, r["run"], r["part"]))
                for r in parts.where(F.col("name") == name).collect()]
        for at in range(0, len(mine), 500):
            adds = " ".join(f"PARTITION (activity_date='{d}') LOCATION '{p}'" for d, p in mine[at:at + 500])
            spark.sql(f"ALTER TABLE {database}.{name} ADD IF NOT EXISTS {adds}")
    materialise_view(published(spark, paths, "mart_anomaly_days"), "mart_anomaly_days")


class ArrivalIncomplete(RuntimeError):
    """Raised when a required day is not complete in bronze."""


def arrival_gaps(spark: SparkSession, paths: Paths, start: str, end: str,
                 expected_hours: int = 24, cities: DataFrame | None = None) -> DataFrame:
    """``source, city_name, event_date, rows, hours`` of every expected
    (source, city, date) of the range with fewer hours than expected.

    What is expected comes from the city list, not from what arrived, so a
    city or a day without any rows is a gap too.
    """
    days = F.sequence(F.lit(start).cast("date"), F.date_sub(F.lit(end).cast("date"), 1))
    expected = (cities if cities is not None else dims.dim_city(spark)).select("city_name").distinct() \
        .select("city_name", F.explode(days).alias("event_date"))
    gaps = []
    for source in SOURCES:
        text = bronze_text(spark, paths, source, lake.range_days(start, end))
        rows = records.valid_rows((records.decode_weather if source == "weather" else records.decode_energy)(
            text.select("value")))
        ready = quality.partition_ready(rows, expected_hours=expected_hours, by=["city_name"])
        gaps.append(expected.join(ready, ["city_name", "event_date"], "left")
                    .where(~F.coalesce("complete", F.lit(False)))
                    .select(F.lit(source).alias("source"), "city_name", "event_date", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
                            F.coalesce("hours", F.lit(0)).cast("long").alias("hours")))
    return gaps[0].unionByName(gaps[1])


def stage_entries(spark: SparkSession, paths: Paths, run_id: str, entries: DataFrame) -> DataFrame:
    """The pending ledger entries as they are before silver reads bronze:
    what is written later stays pending."""
    entries.write.mode("overwrite").parquet(paths.staging(run_id, "pending"))
    return spark.read.schema(entries.schema).parquet(paths.staging(run_id, "pending"))


def run_range(spark: SparkSession, root: str, start: str, end: str, land: bool = True,
              accepted_countries: list[str] | None = None, require_complete: bool = False,
              cities: DataFrame | None = None) -> dict:
    """One job per step for the whole range ``[start, end)``.

    ``require_complete`` re-aims the arrival wait (N4): after landing, the
    run stops with ``ArrivalIncomplete`` unless every city (of ``cities``,
    the fixed list by default) has all hours of every day in bronze; the
    caller decides when to try again.
    """
    paths = Paths(root.rstrip("/"))
    run_id = uuid.uuid4().hex[:12]
    report = {"run": run_id}
    if land:
        report["bronze"] = land_payloads(spark, paths, start, end, run_id)
    days = lake.range_days(start, end)
    ledger = Ledger(spark, paths.root)
    entries = stage_entries(spark, paths, run_id, ledger.pending(SOURCES).where(F.col("event_date").isin(days)))
    if require_complete:
        where = f"{paths.root}/reports/arrival_gaps/run={run_id}"
        arrival_gaps(spark, paths, start, end, cities=cities).write.mode("overwrite").parquet(where)
        missing = spark.read.parquet(where).count()
        if missing:
            raise ArrivalIncomplete(f"{missing} incomplete (source, city, date) entries, listed in {where}")
    report["silver"] = silver_days(spark, paths, days, run_id)
    checks = marts_days(spark, paths, days, accepted_countries, run_id)
    ledger.consume(entries, run_id)
    report["checks"] = {f"{r['table']}.{r['column']}.{r['check']}": r["failures"] for r in checks.collect()}
    return report


def run_day(spark: SparkSession, root: str, day: str, land: bool = True,
            accepted_countries: list[str] | None = None, require_complete: bool = False,
            cities: DataFrame | None = None) -> dict:
    """One date for every step (Q11): land -> silver -> marts -> checks."""
    d = dt.date.fromisoformat(day)
    return run_range(spark, root, d.isoformat(), (d + dt.timedelta(days=1)).isoformat(), land,
                     accepted_countries, require_complete, cities)
