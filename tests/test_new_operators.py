"""Bucketed join, candidate names, silver merge, stream blocks, rejected periods."""

import datetime as dt
import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import moments
from gridlake.operators.join import join_hourly
from gridlake.operators.loadxml import hourly_from_periods, parse_documents, periods, rejected_from_parsed
from gridlake.operators.resolve import CANDIDATES, candidate_index, normalised_name, read_candidates, resolve_names
from gridlake.plans import testbed as tb
from gridlake.sources.bucketed import bucket_count, join_bucketed, write_bucketed
from gridlake.sources.merge import merge_silver
from gridlake.streaming.blocks import block_stream, latest_blocks, write_blocks
from tests import fixtures as fx
from tests.conftest import SF_SMALL

UTC = dt.timezone.utc


def test_bucketed_join_needs_no_exchange(spark, scratch):
    base = scratch("buckets")
    w, e = tb.stage_weather(spark, SF_SMALL), tb.stage_energy(spark, SF_SMALL)
    write_bucketed(w, "bucketed_w", f"{base}/w", 8)
    write_bucketed(e, "bucketed_e", f"{base}/e", 8)
    joined = join_bucketed(spark, "bucketed_w", "bucketed_e")
    plan = joined._jdf.queryExecution().executedPlan().toString()            # before the run: nothing is broadcast later
    assert "SortMergeJoin" in plan and plan.count("Bucketed: true") == 2
    assert "Exchange" not in plan
    rows = sorted(map(str, joined.collect()))
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert rows == sorted(map(str, join_hourly(w, e).collect()))
    assert "Exchange" in join_hourly(w, e)._jdf.queryExecution().executedPlan().toString()
    assert bucket_count(10) == 8 and bucket_count(10**9) == 239
    for name in ("bucketed_w", "bucketed_e"):
        spark.sql(f"DROP TABLE {name}")


def test_names_are_normalised(spark):
    given = ["  São  PAULO ", "saô-paulo", "Łódź", "STRASSE", "Straße", "Æbeltoft", "Œuvre", "Ångström", "München",
             "éclair", "Škoda.", "...", "", None, "Örebro 2"]
    got = [r[0] for r in spark.createDataFrame([(g,) for g in given], "n string").select(normalised_name("n")).collect()]
    assert got == ["sao paulo", "sao paulo", "lodz", "strasse", "strasse", "aebeltoft", "oeuvre", "angstrom", "munchen",
                   "eclair", "skoda", None, None, None, "orebro 2"]


def test_candidates_are_chosen_by_country_name_rank_and_population(spark, scratch):
    answers = [("Frankfurt", [("Frankfurt", "US", 38.2, -84.9, 28000), ("Frankfurt (Oder)", "DE", 52.3, 14.5, 57000),
                              ("Frankfurt", "DE", 50.1, 8.7, 760000)]),
               ("Cordoba", [("Córdoba", "AR", -31.4, -64.2, 1300000), ("Córdoba", "ES", 37.9, -4.8, 320000)]),
               ("Nowhere", []), (None, None)]
    base = scratch("answers")
    spark.createDataFrame(answers, CANDIDATES).write.json(base)
    index = candidate_index(read_candidates(spark, base))
    rows = spark.createDataFrame([(1, "FRANKFURT", "DE"), (2, "frankfurt", "US"), (3, "Frankfurt  Oder", "DE"), (4, "CÓRDOBA", "ES"),
                                  (5, "cordoba", None), (6, "frankfurt", "FR"), (7, "Nowhere", "DE"), (8, None, None)],
                                 "i int, city_name string, country string")
    got = {r.i: (r.resolved_name, r.resolved_country, r.latitude) for r in resolve_names(rows, index).collect()}
    none = (None, None, None)
    assert got == {1: ("Frankfurt", "DE", 50.1), 2: ("Frankfurt", "US", 38.2), 3: ("Frankfurt (Oder)", "DE", 52.3),
                   4: ("Córdoba", "ES", 37.9), 5: ("Córdoba", "AR", -31.4), 6: none, 7: none, 8: none}
    assert resolve_names(rows, index).columns[:3] == rows.columns
    assert read_candidates(spark, f"{base}/none").count() == 0


def test_merge_rewrites_touched_days_only(spark, scratch):
    base = scratch("merge")
    t = lambda d, h: dt.datetime(2026, 3, d, h)

    def merge(rows, step):
        typed = spark.createDataFrame(rows, "city_name string, country string, time timestamp, load_mw double, ingest_ts timestamp")
        return merge_silver(spark, f"{base}/silver", typed, schemas.SILVER_ENERGY, "load_mw", f"{base}/staging{step}")

    def files():
        return {os.path.join(r, p) for r, _, ps in os.walk(f"{base}/silver".removeprefix("file:"))
                for p in ps if p.endswith(".parquet")}

    assert merge([("A", "X", t(d, h), 10.0 * d + h, t(20, 0)) for d in (3, 4, 5) for h in range(4)], 0) == [
        dt.date(2026, 3, d) for d in (3, 4, 5)]
    before = files()
    assert merge([("A", "X", t(4, 1), 1.0, t(21, 0)), ("A", "X", t(4, 9), 2.0, t(21, 0)), ("A", "X", t(4, 2), 999.0, t(1, 0)),
                  ("A", "X", t(4, 3), None, t(22, 0)), ("A", "X", None, 1.0, t(22, 0))], 1) == [dt.date(2026, 3, 4)]
    after = files()
    assert len(before) == len(after) == 3 and len(before & after) == 2       # the two other days were left alone
    got = {(r.day, r.time.hour): r.load_mw for r in spark.read.schema(schemas.SILVER_ENERGY).parquet(f"{base}/silver").collect()}
    assert got == {(d, h): 10.0 * d + h for d in (3, 4, 5) for h in range(4)} | {(4, 1): 1.0, (4, 9): 2.0}
    assert merge([], 2) == []


def test_blocks_follow_late_points_until_the_watermark(spark, scratch):
    base = scratch("blocks")
    points = lambda d, hs, v=1.0: [("a", dt.datetime(2026, 3, d, h), 100 * d + h, v * h) for h in hs]
    schema = "event_type string, ts timestamp, event_id long, value double"
    landings = [points(3, [0, 1, 2, 4, 5, 6]) + [("a", dt.datetime(2026, 3, 3, 7), 9, None)],
                points(3, [3]) + points(3, [5]),                 # a late point and a replayed one
                points(9, [0, 1, 2, 3]),                          # moves the watermark past the first day
                points(3, [8]) + points(9, [4])]                  # the first of them is too late
    for i, rows in enumerate(landings):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/in/part={i}")
        given = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
        query = write_blocks(block_stream(given, 3), f"{base}/out", f"{base}/ckpt")
        query.awaitTermination()
        got = sorted((r.day.day, r.block, r.time.hour, r.load_mw, r.points) for r in latest_blocks(spark.read.parquet(f"{base}/out"), 3).collect())
        third = [(3, 0, 0, 1.0, 3)]
        assert got == [third + [(3, 1, 1, 5.0, 3)], third + [(3, 1, 1, 4.0, 3)], third + [(3, 1, 1, 4.0, 3), (9, 0, 0, 1.0, 3)],
                       third + [(3, 1, 1, 4.0, 3), (9, 0, 0, 1.0, 3)]][i]
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == 1                             # the first day's state is gone


def test_period_over_the_limit_is_rejected_whole(spark):
    docs = [("DE", "a", fx.load_xml([("2026-03-03T00:00Z", "PT60M", ["200000000"] + ["5"] * 24)])),
            ("DE", "b", fx.load_xml([("2026-03-03T00:00Z", "PT60M", ["99999999", "x", "5"]), (None, "PT60M", ["1"])])),
            ("DE", "c", fx.load_xml([("2026-03-03T00:00Z", "PT15M", ["1e9"] * 4)]))]
    parsed = parse_documents(spark.createDataFrame(docs, "country string, city_name string, xml string"))
    hours = [(r.city_name, r.time.hour, r.load_mw) for r in hourly_from_periods(periods(parsed)).orderBy("time").collect()]
    assert hours == [("b", 0, 99999999.0), ("b", 1, 5.0)]
    assert sorted(r.reason for r in rejected_from_parsed(parsed).collect()) == [
        "period_without_start", "quantity_over_limit", "quantity_over_limit"]


day = st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 5), st.integers(0, 3),
                st.decimals(0, 99999, places=2, allow_nan=False))


@settings(max_examples=12, deadline=None)
@given(st.lists(day, max_size=20), st.lists(day, max_size=20), st.sets(st.integers(0, 5), max_size=3))
def test_replaced_moments_equal_moments_at_once(spark, first, second, replaced):
    """Totals after replacing days equal totals built from what is there."""
    schema = "country string, activity_date date, n int, avg_load_mw decimal(10,2)"
    date = lambda i: dt.date(2026, 1, 1) + dt.timedelta(days=i)
    a = [(c, date(d), n, x) for c, d, n, x in first]
    b = [(c, date(d), n, x) for c, d, n, x in second if d in replaced]
    old, new = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    gone = F.col("activity_date").isin([date(i) for i in replaced]) if replaced else F.lit(False)
    stored, fresh = moments.day_moments(old), moments.day_moments(new)
    got = moments.replaced_totals(moments.totals_of(stored), stored.where(gone), fresh)
    want = moments.totals_of(moments.day_moments(old.where(~gone).unionByName(new)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
