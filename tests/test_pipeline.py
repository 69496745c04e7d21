"""End to end: landed payloads -> bronze -> silver -> checked marts."""

import datetime as dt
from decimal import Decimal

import pytest

from gridlake.operators.quality import QualityGateError
from gridlake.plans.daily import Paths, published, run_day, run_range
from tests import fixtures as fx

DAY = "2026-03-13"


def _land(spark, root, loads=fx.SAMPLE_LOADS, extra_docs=()):
    paths = Paths(root)
    weather = fx.weather_payload("Berlin", "DE", 52.52437, 13.41053, DAY, fx.SAMPLE_TEMPS, fx.SAMPLE_HUMS,
                                 fx.SAMPLE_WINDS, [0.0] * 24, fx.SAMPLE_CODES)
    spark.createDataFrame([(weather,)], "value string").write.mode("overwrite").text(paths.landing_weather)
    # 15-minute points: every load value four times -> hourly mean = value
    qty = [f"{v:.2f}" for v in loads for _ in range(4)]
    docs = [("DE", "Berlin", fx.load_xml([(f"{DAY}T00:00Z", "PT15M", qty)]))] + list(extra_docs)
    spark.createDataFrame(docs, "country string, city_name string, xml string").write.mode(
        "overwrite").json(paths.landing_energy)
    return paths


def test_run_day_end_to_end_and_rerun(spark, scratch):
    root = scratch("lake")
    paths = _land(spark, root, extra_docs=[("DE", "Berlin", "<bad")])
    report = run_day(spark, root, DAY)
    assert report["silver"] == {"weather": 24, "energy": 10}
    assert all(v == 0 for v in report["checks"].values())
    daily = published(spark, paths, "mart_daily_demand_summary").collect()
    assert len(daily) == 1
    d = daily[0]
    assert d.activity_date == dt.date(2026, 3, 13)
    assert (d.avg_load_mw, d.total_load_mw) == (fx.mean2(fx.SAMPLE_LOADS), fx.dec(sum(map(fx.dec, fx.SAMPLE_LOADS))))
    assert (d.min_load_mw, d.max_load_mw) == (fx.dec(min(fx.SAMPLE_LOADS)), fx.dec(max(fx.SAMPLE_LOADS)))
    assert d.avg_temperature == fx.mean2(fx.SAMPLE_TEMPS[:10])
    joined = published(spark, paths, "int_weather_energy_joined")
    assert joined.count() == 10
    quarantined = spark.read.parquet(paths.quarantine_energy).collect()
    assert [r.reason for r in quarantined] == ["malformed_xml"]
    # rerun of the same day: identical silver and marts, no duplicates
    before = sorted(spark.read.parquet(paths.silver_energy).collect())
    run_day(spark, root, DAY)
    assert sorted(spark.read.parquet(paths.silver_energy).collect()) == before
    assert published(spark, paths, "mart_daily_demand_summary").collect() == daily
    assert published(spark, paths, "int_weather_energy_joined").count() == 10
    assert spark.read.parquet(paths.quarantine_energy).count() == len(quarantined)


def test_gate_blocks_publishing(spark, scratch):
    root = scratch("lake")
    paths = _land(spark, root)
    with pytest.raises(QualityGateError):
        run_range(spark, root, DAY, "2026-03-14", accepted_countries=["FR"])
    with pytest.raises(Exception):
        published(spark, paths, "mart_daily_demand_summary").count()


def test_command_line_run_day(spark, scratch, capsys):
    import json

    from gridlake.__main__ import main
    root = scratch("cli")
    _land(spark, root)
    assert main(["run-day", "--root", root, "--day", DAY]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["silver"] == {"weather": 24, "energy": 10}


def test_rerun_of_one_day_keeps_the_others(spark, scratch):
    """A range run, then one day rerun with corrected load: only that
    day's partitions change in silver and gold; the anomaly mart is rebuilt."""
    root = scratch("lake2")
    paths = Paths(root)
    days = ["2026-03-13", "2026-03-14"]
    weather = [fx.weather_payload("Berlin", "DE", 52.52437, 13.41053, d, fx.SAMPLE_TEMPS, fx.SAMPLE_HUMS,
                                  fx.SAMPLE_WINDS, [0.0] * 24, fx.SAMPLE_CODES) for d in days]
    spark.createDataFrame([(w,) for w in weather], "value string").write.mode("overwrite").text(paths.landing_weather)

    def land_load(values_by_day):
        docs = [("DE", "Berlin", fx.load_xml([(f"{d}T00:00Z", "PT60M", [f"{v:.2f}" for v in vals])]))
                for d, vals in values_by_day.items()]
        spark.createDataFrame(docs, "country string, city_name string, xml string").write.mode(
            "overwrite").json(paths.landing_energy)

    land_load({days[0]: [100.0] * 24, days[1]: [200.0] * 24})
    run_range(spark, root, days[0], "2026-03-15")
    before = {r.activity_date.isoformat(): r.avg_load_mw
              for r in published(spark, paths, "mart_daily_demand_summary").collect()}
    assert before == {days[0]: Decimal("100.00"), days[1]: Decimal("200.00")}

    land_load({days[0]: [999.0] * 24, days[1]: [300.0] * 24})  # day 1 changed upstream too
    run_day(spark, root, days[1])
    after = {r.activity_date.isoformat(): r.avg_load_mw
             for r in published(spark, paths, "mart_daily_demand_summary").collect()}
    assert after == {days[0]: Decimal("100.00"), days[1]: Decimal("300.00")}
    silver = spark.read.parquet(paths.silver_energy)
    assert silver.count() == 48
    assert {r.load_mw for r in silver.where("day = 13").collect()} == {100.0}
    assert published(spark, paths, "int_weather_energy_joined").count() == 48


def test_city_spelling_is_canonical(spark):
    """Q10: a differently spelled city still joins (name taken from the list)."""
    from gridlake.dims import canonical_city_names
    rows = spark.createDataFrame([("Wien", "AT", 1.0), ("Springfield", "US", 2.0)],
                                 "city_name string, country string, v double")
    got = {r.country: r.city_name for r in canonical_city_names(rows).collect()}
    assert got == {"AT": "Vienna", "US": "Springfield"}
    assert canonical_city_names(rows).columns == ["city_name", "country", "v"]


def test_arrival_gate(spark, scratch):
    """N4 re-aimed: an incomplete day stops the run before silver."""
    from gridlake.plans.daily import ArrivalIncomplete
    root = scratch("gate")
    paths = _land(spark, root)  # weather has 24 hours, load only 10
    only = spark.createDataFrame([("Berlin",)], "city_name string")
    with pytest.raises(ArrivalIncomplete):
        run_day(spark, root, DAY, require_complete=True, cities=only)
    with pytest.raises(Exception):
        spark.read.parquet(paths.silver_energy).count()
    full = [50000.0 + h for h in range(24)]
    _land(spark, root, loads=full)
    report = run_day(spark, root, DAY, require_complete=True, cities=only)
    assert report["silver"] == {"weather": 24, "energy": 24}


def test_gate_sees_absent_cities_and_days(spark, scratch):
    """A city or a day without any rows is a gap; an empty day runs with the gate off."""
    from gridlake.plans.daily import ArrivalIncomplete, arrival_gaps
    root = scratch("absent")
    paths = _land(spark, root, loads=[50000.0 + h for h in range(24)])
    run_day(spark, root, DAY)
    gaps = {(r.source, r.city_name): r.hours for r in arrival_gaps(spark, paths, DAY, "2026-03-14").collect()}
    assert len(gaps) == 16 and set(gaps.values()) == {0} and ("weather", "Berlin") not in gaps
    with pytest.raises(ArrivalIncomplete):
        run_day(spark, root, "2026-03-20", require_complete=True)
    report = run_day(spark, root, "2026-03-20")
    assert report["bronze"] == report["silver"] == {"weather": 0, "energy": 0}
    assert spark.read.parquet(f"{root}/reports/arrival_gaps").count() == 18


def test_rerun_empties_a_day_and_failed_marts_publish_nothing(spark, scratch, monkeypatch):
    """A day that a rerun no longer fills goes; Q12: the third mart's
    check fails before any of the three is published."""
    from gridlake.plans import daily as plan
    root = scratch("shrinks")
    paths = _land(spark, root)
    run_day(spark, root, DAY)
    before = published(spark, paths, "mart_daily_demand_summary").collect()
    _land(spark, root, loads=[70000.0] * 10)
    monkeypatch.setitem(plan.NOT_NULL, "mart_anomaly_days", ["country"])
    monkeypatch.setattr(plan, "build_anomaly", lambda d, candidates: d.selectExpr(
        "cast(null as string) as country", "activity_date", "avg_load_mw"))
    with pytest.raises(QualityGateError):
        run_day(spark, root, DAY)
    assert published(spark, paths, "mart_daily_demand_summary").collect() == before
    monkeypatch.undo()
    spark.createDataFrame([("DE", "Berlin", fx.load_xml([("2026-01-01T00:00Z", "PT60M", ["1"])]))],
                          "country string, city_name string, xml string").write.mode("overwrite").json(paths.landing_energy)
    run_day(spark, root, DAY)
    assert spark.read.schema("load_mw double").parquet(paths.silver_energy).count() == 0
    assert published(spark, paths, "mart_daily_demand_summary").count() == 0


def test_landing_quarantines_once_and_latest_file_wins(spark, scratch):
    """Bad payload lines and hours are filed once; J1: a restated load replaces the larger one."""
    root = scratch("restated")
    paths = _land(spark, root, loads=[200.0] * 24, extra_docs=[("DE", "Berlin", "<bad")])
    bad_hour = fx.weather_payload("Rome", "IT", 41.9, 12.5, DAY, [1.0], [50], [1.0], [0.0], [0]).replace("T00:00", "junk")
    spark.createDataFrame([('{"city_name": "Paris", ',), (bad_hour,)], "value string").write.mode("append").text(paths.landing_weather)
    run_day(spark, root, DAY)
    run_day(spark, root, "2026-03-14")
    reasons = sorted(r.reason for r in spark.read.parquet(paths.at("quarantine", "weather")).collect())
    assert reasons == ["bad_time", "malformed_payload"]
    assert spark.read.parquet(paths.quarantine_energy).count() == 1
    import time
    time.sleep(1.1)
    spark.createDataFrame([("DE", "Berlin", fx.load_xml([(f"{DAY}T00:00Z", "PT60M", ["150"] * 24)]))],
                          "country string, city_name string, xml string").write.mode("append").json(paths.landing_energy)
    run_day(spark, root, DAY)
    assert {r.load_mw for r in spark.read.parquet(paths.silver_energy).collect()} == {150.0}


def test_two_cities_of_a_country_and_named_marts(spark, scratch):
    from gridlake.plans.daily import register_marts
    root = scratch("cities")
    paths = _land(spark, root)
    munich = fx.weather_payload("Munich", "DE", 48.1, 11.6, DAY, [1.0] * 24, [50] * 24, [1.0] * 24, [0.0] * 24, [0] * 24)
    spark.createDataFrame([(munich,)], "value string").write.mode("append").text(paths.landing_weather)
    run_day(spark, root, DAY)
    assert {r.city_name for r in spark.read.parquet(paths.at("silver", "weather")).select("city_name").distinct().collect()} == {"Berlin", "Munich"}
    register_marts(spark, root)
    assert spark.table("mart_daily_demand_summary").count() == 1
    assert spark.table("int_weather_energy_joined").count() == 10 and spark.table("mart_anomaly_days").count() == 0
    for name in ("mart_daily_demand_summary", "int_weather_energy_joined"):
        spark.sql(f"DROP TABLE {name}")
