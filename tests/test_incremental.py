"""Runs over what is new, atomic publishing, keyed quarantine, compaction."""

import datetime as dt
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridlake.operators import moments, records
from gridlake.operators.anomaly import anomaly_days_grouped
from gridlake.plans import daily as plan
from gridlake.plans.daily import Paths, bronze_text, marts_step, published, register_marts, run_range, silver_days
from gridlake.plans.incremental import land_new, run_pending
from gridlake.sources import compaction, lake, quarantine, snapshots
from gridlake.sources.ledger import Ledger
from gridlake.streaming.ingest import land_batch
from tests import fixtures as fx

DAYS = ["2026-03-12", "2026-03-13", "2026-03-14"]
DAILY, ANOMALY = "mart_daily_demand_summary", "mart_anomaly_days"


def land_weather(spark, paths, days, city=("Berlin", "DE")):
    rows = [(fx.weather_payload(*city, 52.5, 13.4, d, fx.SAMPLE_TEMPS, fx.SAMPLE_HUMS, fx.SAMPLE_WINDS, [0.0] * 24,
                                fx.SAMPLE_CODES),) for d in days]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(paths.landing_weather)


def land_loads(spark, paths, values, city=("DE", "Berlin"), mode="append"):
    """values: {day: loads}; one file."""
    docs = [(*city, fx.load_xml([(f"{d}T00:00Z", "PT60M", [f"{v:.2f}" for v in vals])])) for d, vals in values.items()]
    spark.createDataFrame(docs, "country string, city_name string, xml string").coalesce(1).write.mode(mode).json(paths.landing_energy)


def means(spark, paths, version=None):
    return {(r.country, r.activity_date.isoformat()): r.avg_load_mw for r in published(spark, paths, DAILY, version).collect()}


def part_runs(spark, paths):
    return {r["part"]: r["run"] for r in snapshots.manifest(spark, paths.gold_root).where(F.col("name") == DAILY).collect()}


@pytest.fixture()
def lake_of_three(spark, scratch):
    paths = Paths(scratch("inc"))
    land_weather(spark, paths, DAYS)
    land_loads(spark, paths, {d: [100.0] * 20 for d in DAYS})
    return paths, run_pending(spark, paths.root)


def test_late_records_rebuild_their_day_only(spark, lake_of_three):
    paths, first = lake_of_three
    assert first["days"] == DAYS and first["bronze"] == {"weather": {"files": 1, "rows": 72}, "energy": {"files": 1, "rows": 60}}
    assert run_pending(spark, paths.root)["days"] == []                     # nothing is new
    before = part_runs(spark, paths)
    late = fx.load_xml([(f"{DAYS[1]}T20:00Z", "PT60M", ["160"] * 4)])
    spark.createDataFrame([("DE", "Berlin", late)], "country string, city_name string, xml string").coalesce(1) \
        .write.mode("append").json(paths.landing_energy)
    second = run_pending(spark, paths.root)
    assert second["days"] == [DAYS[1]] and second["bronze"]["energy"] == {"files": 1, "rows": 4}
    assert second["bronze"]["weather"] == {"files": 0, "rows": 0}
    after = part_runs(spark, paths)
    assert {p for p in after if after[p] != before[p]} == {f"activity_date={DAYS[1]}"}
    assert means(spark, paths) == {("DE", d): Decimal("110.00") if d == DAYS[1] else Decimal("100.00") for d in DAYS}
    # the version before is still there to read
    assert means(spark, paths, 1) == {("DE", d): Decimal("100.00") for d in DAYS}


def test_a_late_stream_batch_rebuilds_its_day(spark, lake_of_three):
    """A bronze writer outside the landing: its ledger entry is enough."""
    paths, _ = lake_of_three
    record = f'{{"city_name": "Berlin", "country": "DE", "time": "{DAYS[0]}T21:00:00+00:00", "load_mw": 310.0}}'
    batch = spark.createDataFrame([(record,), ("{",)], "value string")
    for _ in range(2):                                                       # a replayed batch is filed once
        land_batch(batch, 3, "energy", paths.at("bronze", "energy"), f"{paths.root}/stream_quarantine", stream="s", lake_root=paths.root)
    assert Ledger(spark, paths.root).pending(("weather", "energy")).count() == 1
    assert run_pending(spark, paths.root)["days"] == [DAYS[0]]
    assert means(spark, paths)["DE", DAYS[0]] == Decimal("110.00")
    land_batch(batch, 3, "energy", paths.at("bronze", "energy"), f"{paths.root}/stream_quarantine", stream="s", lake_root=paths.root)
    assert run_pending(spark, paths.root)["days"] == []                     # nor does a replay make work


def test_changed_file_replaces_its_older_version(spark, scratch):
    """Same file name, later time: its hours are parsed again, the old ones no longer count."""
    paths = Paths(scratch("changed"))
    land_weather(spark, paths, DAYS[:2])
    import os
    folder = paths.landing_energy.removeprefix("file:")
    os.makedirs(folder)

    def write(day, value, n):
        import json
        with open(f"{folder}/de.json", "w") as f:
            f.write(json.dumps({"country": "DE", "city_name": "Berlin", "xml": fx.load_xml([(f"{day}T00:00Z", "PT60M", [value] * n)])}))

    write(DAYS[0], "100", 24)
    run_pending(spark, paths.root)
    assert means(spark, paths) == {("DE", DAYS[0]): Decimal("100.00")}
    time.sleep(1.1)
    write(DAYS[1], "200", 12)                                                # the day moved, too
    report = run_pending(spark, paths.root)
    assert report["days"] == DAYS[:2] and report["bronze"]["energy"] == {"files": 1, "rows": 12}
    assert means(spark, paths) == {("DE", DAYS[1]): Decimal("200.00")}
    files = Ledger(spark, paths.root).files("energy")
    assert files.count() == 2 and files.select("file").distinct().count() == 1


def test_failure_before_the_ledger_lands_again_without_copies(spark, scratch, monkeypatch):
    paths = Paths(scratch("again"))
    land_weather(spark, paths, DAYS[:1])
    land_loads(spark, paths, {DAYS[0]: [100.0] * 24})
    monkeypatch.setattr(Ledger, "add_files", lambda *a: (_ for _ in ()).throw(RuntimeError("lost driver")))
    with pytest.raises(RuntimeError):
        land_new(spark, paths)
    monkeypatch.undo()
    report = run_pending(spark, paths.root)
    assert report["bronze"]["weather"]["rows"] == 24 and report["days"] == DAYS[:1]
    assert bronze_text(spark, paths, "weather", [dt.date.fromisoformat(DAYS[0])]).count() == 24
    assert run_pending(spark, paths.root)["days"] == []


@pytest.mark.parametrize("broken", ["mart_daily_demand_summary", "country_totals", "mart_anomaly_days", "manifest"])
def test_failure_between_marts_leaves_readers_on_the_old_set(spark, lake_of_three, monkeypatch, broken):
    paths, _ = lake_of_three
    joined = published(spark, paths, "int_weather_energy_joined").count()
    before, anomalies = means(spark, paths), published(spark, paths, ANOMALY).collect()
    land_loads(spark, paths, {DAYS[1]: [500.0] * 24, DAYS[2]: [900.0] * 3})
    land_new(spark, paths)
    part_folder, write = snapshots.part_folder, snapshots._manifest_path

    def fail(name):
        if name == broken:
            raise OSError("no space left")

    monkeypatch.setattr(snapshots, "part_folder", lambda root, name, *a: fail(name) or part_folder(root, name, *a))
    monkeypatch.setattr(snapshots, "_manifest_path", lambda root, v: (v > 1 and fail("manifest")) or write(root, v))
    if broken == "mart_anomaly_days":     # reading the published marts below must still work
        monkeypatch.setattr(plan, "build_anomaly", lambda *a: (_ for _ in ()).throw(OSError("no space left")))
    with pytest.raises(OSError):
        run_pending(spark, paths.root, land=False)
    monkeypatch.undo()
    assert snapshots.current(spark, paths.gold_root) == 1
    assert means(spark, paths) == before and published(spark, paths, ANOMALY).collect() == anomalies
    assert published(spark, paths, "int_weather_energy_joined").count() == joined
    register_marts(spark, paths.root)                                        # named tables follow the published version
    assert spark.table(DAILY).count() == 3
    again = run_pending(spark, paths.root)                                   # the days are still pending
    assert again["days"] == DAYS[1:] and means(spark, paths)["DE", DAYS[1]] == Decimal("500.00")
    register_marts(spark, paths.root)
    assert {r.avg_load_mw for r in spark.table(DAILY).collect()} == set(means(spark, paths).values())
    for name in (DAILY, "int_weather_energy_joined"):
        spark.sql(f"DROP TABLE {name}")


def test_emptied_day_goes_with_the_new_version(spark, lake_of_three):
    """The failure case 'before days are dropped' cannot occur: one manifest drops and adds."""
    paths, _ = lake_of_three
    days = [dt.date.fromisoformat(DAYS[1])]
    lake.drop_empty_days(spark, paths.at("silver", "energy"), spark.createDataFrame([], "event_date date"), days)
    marts_step(spark, paths, DAYS[1], DAYS[2])
    assert set(means(spark, paths)) == {("DE", DAYS[0]), ("DE", DAYS[2])}
    totals = snapshots.read_version(spark, paths.gold_root, "country_totals", moments.TOTALS).first()
    assert (totals.n, totals.s) == (2, Decimal("200.00"))


def test_conflicting_publish_fails_whole(spark, lake_of_three):
    paths, _ = lake_of_three
    none = spark.createDataFrame([], "name string, part string")
    assert snapshots.publish(spark, paths.gold_root, 1, "other", none, none) == 2
    with pytest.raises(snapshots.PublishConflict):
        snapshots.publish(spark, paths.gold_root, 1, "mine", none, none)
    assert means(spark, paths) and snapshots.current(spark, paths.gold_root) == 2
    # a claim of a dead run stops others until it is removed
    fs, claim = snapshots.located(spark, f"{paths.gold_root}/_claims/{3:010d}")
    fs.createNewFile(claim)
    with pytest.raises(snapshots.PublishConflict, match="is being published"):
        snapshots.publish(spark, paths.gold_root, 2, "mine", none, none)
    fs.delete(claim, False)
    assert snapshots.publish(spark, paths.gold_root, 2, "mine", none, none) == 3


def test_expire_keeps_what_live_versions_name(spark, lake_of_three):
    paths, _ = lake_of_three
    for load in (200.0, 300.0):
        time.sleep(1.1)
        land_loads(spark, paths, {DAYS[2]: [load] * 24})
        run_pending(spark, paths.root)
    want = means(spark, paths)
    gone = snapshots.expire(spark, paths.gold_root, keep=1)
    assert gone and snapshots.versions(spark, paths.gold_root) == [3] and means(spark, paths) == want
    assert want["DE", DAYS[2]] == Decimal("300.00")


def test_incremental_anomalies_equal_a_full_rebuild(spark, scratch):
    """Two countries over 40 days; one is restated, the other's rows stay as published."""
    paths = Paths(scratch("anomalies"))
    first = dt.date(2026, 1, 1)
    days = [(first + dt.timedelta(days=i)).isoformat() for i in range(40)]
    for country, city in (("DE", "Berlin"), ("FR", "Paris")):
        land_weather(spark, paths, days, (city, country))
        land_loads(spark, paths, {d: [1000.0 + 7 * (i % 5) + (900 if i == 20 else 0)] * 24 for i, d in enumerate(days)}, (country, city))
    run_pending(spark, paths.root)
    time.sleep(1.1)
    land_loads(spark, paths, {days[20]: [1003.0] * 24, days[33]: [100.0] * 24})
    report = run_pending(spark, paths.root)
    assert report["days"] == [days[20], days[33]]
    got = sorted(tuple(r) for r in published(spark, paths, ANOMALY).collect())
    want = sorted(tuple(r) for r in anomaly_days_grouped(published(spark, paths, DAILY)).collect())
    assert got == want and [(r[0], r[1].isoformat()) for r in got] == [("DE", days[33]), ("FR", days[20])]


def test_range_run_consumes_what_it_rebuilt(spark, scratch):
    paths = Paths(scratch("range"))
    land_weather(spark, paths, DAYS)
    land_loads(spark, paths, {d: [100.0] * 24 for d in DAYS})
    run_range(spark, paths.root, DAYS[0], DAYS[2])
    assert Ledger(spark, paths.root).pending(("weather", "energy")).count() == 0
    # the landing has not parsed these files one by one: the first incremental run does
    assert run_pending(spark, paths.root)["days"] == DAYS
    assert set(means(spark, paths).values()) == {Decimal("100.00")}


def test_quarantine_is_keyed_and_forgets_mended_files(spark, scratch):
    paths = Paths(scratch("quarantine"))
    folder = paths.landing_weather.removeprefix("file:")
    import os
    os.makedirs(folder)
    good = fx.weather_payload("Berlin", "DE", 52.5, 13.4, DAYS[0], [1.0] * 24, [50] * 24, [1.0] * 24, [0.0] * 24, [0] * 24)

    def write(name, lines):
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")

    def filed():
        return sorted((r.reason, r.copies) for r in quarantine.open_rows(spark, paths.at("quarantine", "weather")).collect())

    write("a.json", [good, '{"city_name": ', '{"city_name": '])
    write("b.json", ['{"x": 1', good.replace("T00:00", "junk")])
    land_loads(spark, paths, {DAYS[0]: [100.0] * 24})
    run_pending(spark, paths.root)
    want = [("bad_time", 1), ("malformed_payload", 1), ("malformed_payload", 2)]
    assert filed() == want
    first = {r.record_hash: r.first_seen for r in quarantine.open_rows(spark, paths.at("quarantine", "weather")).collect()}
    time.sleep(1.1)
    write("a.json", [good, '{"city_name": '])                                # one copy of it is gone
    run_pending(spark, paths.root)
    assert filed() == [("bad_time", 1), ("malformed_payload", 1), ("malformed_payload", 1)]
    rows = quarantine.open_rows(spark, paths.at("quarantine", "weather")).collect()
    assert all(r.first_seen == first[r.record_hash] for r in rows)
    assert sum(r.last_seen > r.first_seen for r in rows) == 1
    time.sleep(1.1)
    write("a.json", [good])
    write("b.json", [good])
    run_pending(spark, paths.root)
    assert filed() == []


def test_replay_closes_what_is_valid_now(spark, scratch):
    paths = Paths(scratch("replay"))
    rows = [("Berlin", "DE", f"{DAYS[0]}T0{h}:00:00Z", v) for h, v in enumerate(["10", "12 MW", "junk"])]
    lake.write_bronze(spark.createDataFrame(rows, "city_name string, country string, time string, load_mw string"),
                      paths.at("bronze", "energy"), mode="overwrite", batch="given")
    day = [dt.date.fromisoformat(DAYS[0])]
    silver_days(spark, paths, day)
    root = paths.at("quarantine", "energy")
    assert quarantine.open_rows(spark, root).count() == 2
    valid, closed = quarantine.replay(spark, root, "energy", records.decode_energy,
                                      lambda d: d.withColumn("value", F.replace("value", F.lit(" MW"))))
    assert [r.load_mw for r in valid.collect()] == [12.0]
    quarantine.close(spark, root, closed, paths.staging("r", "close"))
    assert [r.raw for r in quarantine.open_rows(spark, root).collect()][0].count("junk") == 1


def test_compaction_survives_replays_and_late_batches(spark, scratch):
    from gridlake.plans.catalog_incremental import compacted_bronze
    from tests.conftest import SF_SMALL
    base = scratch("fold")
    compacted_bronze(spark, SF_SMALL, base)
    bronze, manifest = f"{base}/bronze", f"{base}/folded"
    days = lake.range_days("2023-12-01", "2024-04-01")

    def live():
        text = spark.read.text(bronze)
        return sorted(r.value for r in compaction.live(text, compaction.folded(spark, manifest)).select("value").collect())

    rows = live()
    on_disk = spark.read.text(bronze)
    assert on_disk.count() > len(rows)                                       # the replayed batch lies there, unread
    held = compaction.live(on_disk.withColumn("f", F.col("_metadata.file_path")), compaction.folded(spark, manifest)) \
        .select("year", "month", "day", "f")
    files = held.distinct().groupBy("year", "month", "day").count().collect()
    assert {r["count"] for r in files} == {1} and len(files) > 20            # one file a day
    entries = compaction.folded(spark, manifest)
    assert compaction.remove_folded(spark, bronze, entries) > 0 and live() == rows
    # late records make a batch of their own, and the next compaction folds it in
    record = '{"city_name":"Berlin","country":"DE","time":"2024-01-02T05:00:00.000000+00:00","load_mw":77.0}'
    land_batch(spark.createDataFrame([(record,)], "value string"), 9, "energy", bronze, f"{base}/q", stream="late")
    assert len(live()) == len(rows) + 1
    report = compaction.compact(spark, bronze, manifest, days[0].isoformat(), days[-1].isoformat())
    assert report == {"days": 1, "batches": 2} and len(live()) == len(rows) + 1
    assert compaction.compact(spark, bronze, manifest, days[0].isoformat(), days[-1].isoformat()) == {"days": 0, "batches": 0}


def test_compaction_that_fails_before_its_manifest_changes_nothing(spark, scratch, monkeypatch):
    base = scratch("fold-fault")
    bronze, manifest = f"{base}/bronze", f"{base}/folded"
    for i in range(3):
        record = f'{{"city_name":"Berlin","country":"DE","time":"2024-01-02T0{i}:00:00+00:00","load_mw":{i}.0}}'
        land_batch(spark.createDataFrame([(record,)], "value string"), i, "energy", bronze, f"{base}/q", stream="s")
    hint = compaction.remove_folded
    monkeypatch.setattr(compaction, "remove_folded", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):                                             # folded and filed, folders not yet removed
        compaction.compact(spark, bronze, manifest, "2024-01-01", "2024-01-05")
    monkeypatch.setattr(compaction, "remove_folded", hint)
    text = spark.read.text(bronze)
    assert text.count() == 6 and compaction.live(text, compaction.folded(spark, manifest)).count() == 3
    # a compacted folder that was never filed does not count
    spark.createDataFrame([("x", 2024, 1, 2, "compact-lost")], "value string, year int, month int, day int, batch string") \
        .write.mode("append").partitionBy("year", "month", "day", "batch").text(bronze)
    assert compaction.live(spark.read.text(bronze), compaction.folded(spark, manifest)).count() == 3
