"""Property tests against brute force on small random inputs."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlake.functions.numeric import exact_total, half_up_mean
from gridlake.operators.sequence import index_within_group

cents = st.integers(min_value=-10**9, max_value=10**9)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(cents, min_size=1, max_size=7), min_size=1, max_size=6))
def test_half_up_mean_matches_decimal(spark, groups):
    rows = [(g, float(Decimal(c) / 100)) for g, vals in enumerate(groups) for c in vals]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: r.m for r in df.groupBy("g").agg(half_up_mean(exact_total("x"), F.count("x")).alias("m")).collect()}
    for g, vals in enumerate(groups):
        exact = (Decimal(sum(vals)) / 100 / len(vals)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert got[g] == float(exact)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.integers(0, 50)),
                min_size=1, max_size=120),
       st.integers(min_value=1, max_value=9))
def test_positions_match_row_number(spark, rows, parts):
    data = [(g, t, i) for i, (g, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, t int, id int")
    got = index_within_group(df, ["g"], ["t", "id"], "pos", num_partitions=parts)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("t", "id")) - 1)
    assert sorted(got.select("id", "pos").collect()) == sorted(want.select("id", "pos").collect())


_cents_or_null = st.one_of(st.none(), st.integers(min_value=-5000, max_value=5000))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["Berlin", "Rome"]), st.integers(0, 3), st.integers(0, 59),
                          _cents_or_null, st.one_of(st.none(), st.integers(0, 100))), min_size=1, max_size=25),
       st.lists(st.tuples(st.sampled_from(["Berlin", "Rome", "Paris"]), st.integers(0, 3), st.integers(0, 59),
                          _cents_or_null), min_size=1, max_size=25))
def test_daily_plans_agree(spark, weather_rows, energy_rows):
    """Both roll-up plans equal aggregating the n x m join, NULLs included."""
    import datetime as dt

    from gridlake.operators.aggregate import (daily_summary, daily_summary_from_load_rollup,
                                              daily_summary_from_sides)
    from gridlake.operators.join import join_hourly
    base = dt.datetime(2026, 3, 3, 22)

    def money(c):
        return None if c is None else c / 100

    w = spark.createDataFrame(
        [(c, "DE" if c == "Berlin" else "IT", base + dt.timedelta(hours=h, minutes=m), money(t), hu, 1.5, 0.25, 3)
         for c, h, m, t, hu in weather_rows],
        "city_name string, country string, time timestamp, temperature double, humidity int, "
        "wind_speed double, precipitation double, weather_code int")
    e = spark.createDataFrame(
        [(c, "XX", base + dt.timedelta(hours=h, minutes=m), money(v)) for c, h, m, v in energy_rows],
        "city_name string, country string, time timestamp, load_mw double")
    want = sorted(daily_summary(join_hourly(w, e)).collect())
    assert sorted(daily_summary_from_sides(w, e).collect()) == want
    assert sorted(daily_summary_from_load_rollup(w, e).collect()) == want


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["DE", "FR", "IT"]), st.integers(0, 40),
                          st.one_of(st.none(), st.integers(min_value=0, max_value=10_000_000))),
                min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1])))
def test_anomaly_forms_agree(spark, days):
    import datetime as dt
    from decimal import Decimal as D

    from gridlake.operators.anomaly import anomaly_days, anomaly_days_grouped
    rows = [(c, dt.date(2026, 1, 1) + dt.timedelta(days=d), None if v is None else D(v) / 100)
            for c, d, v in days]
    daily = spark.createDataFrame(rows, "country string, activity_date date, avg_load_mw decimal(10,2)")
    assert sorted(anomaly_days(daily).collect()) == sorted(anomaly_days_grouped(daily).collect())


def _expected_hours(points, per_hour):
    """Plain-Python statement of the downsampling rules on one period."""
    from decimal import ROUND_HALF_UP, Decimal
    good = [Decimal(q) for q in points if q is not None and q.lstrip("-").replace(".", "", 1).isdigit()]
    out = []
    for b in range(len(good) // per_hour):
        block = good[b * per_hour:(b + 1) * per_hour]
        mean = (sum(block) / per_hour).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        out.append((b, float(mean)))
    return out


@settings(max_examples=15, deadline=None)
@given(st.sampled_from([("PT15M", 4), ("PT30M", 2), ("PT60M", 1), ("PT20M", 3)]),
       st.lists(st.one_of(st.none(), st.just("abc"),
                          st.integers(0, 99_999).map(lambda c: f"{c // 100}.{c % 100:02d}")),
                max_size=30))
def test_downsampling_matches_rules(spark, resolution, points):
    import datetime as dt

    from gridlake.operators.loadxml import load_records
    from tests.fixtures import load_xml
    res, per_hour = resolution
    xml = load_xml([("2026-03-03T00:00Z", res, points)])
    df = spark.createDataFrame([("DE", "Berlin", xml)], "country string, city_name string, xml string")
    got = sorted((r.time, r.load_mw) for r in load_records(df).collect())
    want = [(dt.datetime(2026, 3, 3) + dt.timedelta(hours=b), m) for b, m in _expected_hours(points, per_hour)]
    assert got == want


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["Berlin", "Rome"]), st.integers(0, 3), st.booleans(),
                          st.one_of(st.none(), st.integers(0, 9999)), st.one_of(st.none(), st.integers(0, 5))),
                min_size=1, max_size=30))
def test_clean_energy_matches_brute_force(spark, recs):
    """Typing, NULL dropping and one survivor per (city, country, instant)."""
    import datetime as dt
    import json

    from gridlake.operators import records
    from gridlake.operators.clean import clean_energy
    texts, best = [], {}
    for city, hour, zoned, cents, arrival in recs:
        t = f"2026-03-03T0{hour}:00" + (":00+00:00" if zoned else "")
        load = None if cents is None else cents / 100
        ingest = None if arrival is None else f"2026-03-04T0{arrival}:00:00Z"
        texts.append(json.dumps({"city_name": city, "country": "DE", "time": t, "load_mw": load,
                                 "ingest_ts": ingest}))
        if load is None:
            continue
        key = (city, dt.datetime(2026, 3, 3, hour))
        rank = (arrival is not None, arrival or 0, load)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, load)
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = sorted((r.city_name, r.time, r.load_mw) for r in clean_energy(records.decode_energy(df)).collect())
    assert got == sorted((c, t, v) for (c, t), (_, v) in best.items())
