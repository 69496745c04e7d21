"""Runs over what is new.

``land_new`` parses only landed files (or versions of files) that no run has
parsed, each once.  ``run_pending`` rebuilds only the days that bronze
writers have touched since: new days, and old days that late records or
changed files fall into, with the anomalies of their countries.

A run that fails leaves its days pending.  Bronze is written before the
ledgers, so a failure between them repeats work, never loses it: the
batch of a landing is named by the file versions in it, so landing the same
files again replaces the same sub-partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.plans.daily import (SOURCES, Paths, _quarantine, event_day, landed_rejects, landed_rows, marts_days, silver_days,
                                  stage_entries, stage_landing)
from gridlake.sources import lake
from gridlake.sources.ledger import Ledger, days_of, read_or_empty

FILE_DAYS = "file string, modified timestamp, event_date date, run string"


def _new_versions(spark: SparkSession, paths: Paths, ledger: Ledger, source: str, run_id: str) -> DataFrame:
    """The staged listing of new file versions: later arrivals wait for the next run."""
    found = ledger.new_files(source, paths.at("landing", source))
    path = paths.staging(run_id, f"new_files_{source}")
    found.write.mode("overwrite").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def land_new(spark: SparkSession, paths: Paths, run_id: str | None = None, canonical_names: bool = True) -> dict[str, dict]:
    """New file versions into bronze, one ``batch=files-<name>`` per source;
    returns files and rows by source."""
    run_id, ledger, report = run_id or uuid.uuid4().hex[:12], Ledger(spark, paths.root), {}
    files = {source: _new_versions(spark, paths, ledger, source, run_id) for source in SOURCES}
    listed = {source: [r["path"] for r in files[source].select("path").collect()] for source in SOURCES}   # one per new file
    staged = stage_landing(spark, paths, run_id, listed["weather"], listed["energy"])
    for source in SOURCES:
        report[source] = {"files": len(listed[source]), "rows": 0}
        if source not in staged:
            continue
        name = files[source].agg(F.sum(F.xxhash64("file", "modified", "size").cast("decimal(38,0)")).alias("s")).first()["s"]
        batch, day = f"files-{int(name) & (1 << 64) - 1:016x}", event_day(source)
        rows = landed_rows(source, staged[source], canonical_names).where(day.isNotNull())
        lake.write_bronze(rows, paths.at("bronze", source), mode="overwrite", batch=batch)
        held_path = paths.staging(run_id, f"file_days_{source}")
        rows.groupBy(F.col("source_file").alias("file"), F.col("ingest_ts").alias("modified"), day.alias("event_date")) \
            .agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(held_path)
        held = spark.read.parquet(held_path)
        # days that an earlier version of a changed file had rows in are touched as well
        known = read_or_empty(spark, f"{ledger.root}/file_days/{source}", FILE_DAYS)
        lost = known.join(files[source].select("file"), "file", "left_semi").select("event_date", F.lit(0).cast("long").alias("rows"))
        days = held.select("event_date", "rows").unionByName(lost).groupBy("event_date").agg(F.sum("rows").alias("rows"))
        _quarantine(spark, paths, source, landed_rejects(source, staged[source]),
                    files[source].select(F.concat(F.lit("file:"), "file").alias("origin")), run_id, "land")
        ledger.touch(source, days, batch, run_id)
        held.select("file", "modified", "event_date").write.mode("overwrite").parquet(f"{ledger.root}/file_days/{source}/run={run_id}")
        ledger.add_files(source, files[source], run_id)
        report[source]["rows"] = held.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"]
    return report


def run_pending(spark: SparkSession, root: str, accepted_countries: list[str] | None = None, land: bool = True) -> dict:
    """Land what is new, rebuild the touched days, publish, file them as consumed."""
    paths, run_id = Paths(root.rstrip("/")), uuid.uuid4().hex[:12]
    report: dict = {"run": run_id}
    if land:
        report["bronze"] = land_new(spark, paths, run_id)
    ledger = Ledger(spark, paths.root)
    entries = stage_entries(spark, paths, run_id, ledger.pending(SOURCES))
    days = sorted(r["event_date"] for r in entries.select("event_date").distinct().collect())       # days, not rows
    report["days"] = [d.isoformat() for d in days]
    if not days:
        return report
    report["silver"] = silver_days(spark, paths, days, run_id)
    checks = marts_days(spark, paths, days, accepted_countries, run_id)
    ledger.consume(entries, run_id)
    report["checks"] = {f"{r['table']}.{r['column']}.{r['check']}": r["failures"] for r in checks.collect()}
    return report
