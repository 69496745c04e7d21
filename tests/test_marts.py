import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gridlake.operators.aggregate import daily_summary, daily_summary_from_load_rollup, daily_summary_from_sides
from gridlake.operators.anomaly import anomaly_days, anomaly_days_grouped
from gridlake.operators.join import join_hourly
from tests import fixtures as fx

W_SCHEMA = ("city_name string, country string, time timestamp, temperature double, humidity int, "
            "wind_speed double, precipitation double, weather_code int")
E_SCHEMA = "city_name string, country string, time timestamp, load_mw double"


def _weather(spark, day=dt.datetime(2026, 3, 13)):
    rows = [("Berlin", "DE", day + dt.timedelta(hours=h), fx.SAMPLE_TEMPS[h], fx.SAMPLE_HUMS[h],
             fx.SAMPLE_WINDS[h], 0.0, fx.SAMPLE_CODES[h]) for h in range(24)]
    return spark.createDataFrame(rows, W_SCHEMA)


def _energy(spark, loads, day=dt.datetime(2026, 3, 13), city="Berlin", country="DE"):
    rows = [(city, country, day + dt.timedelta(hours=h), v) for h, v in enumerate(loads)]
    return spark.createDataFrame(rows, E_SCHEMA)


def test_weather_golden_values(spark):
    daily = daily_summary(join_hourly(_weather(spark), _energy(spark, [1.0] * 24))).first()
    assert daily.avg_temperature == fx.mean2(fx.SAMPLE_TEMPS)
    assert (daily.min_temperature, daily.max_temperature) == (fx.dec(min(fx.SAMPLE_TEMPS)), fx.dec(max(fx.SAMPLE_TEMPS)))
    assert daily.avg_humidity == fx.mean2(fx.SAMPLE_HUMS)
    assert (daily.min_humidity, daily.max_humidity) == (fx.dec(min(fx.SAMPLE_HUMS)), fx.dec(max(fx.SAMPLE_HUMS)))
    assert daily.avg_wind_speed == fx.mean2(fx.SAMPLE_WINDS)
    assert daily.avg_precipitation == Decimal("0.00")


def test_load_golden_values_both_plans(spark):
    w, e = _weather(spark), _energy(spark, fx.SAMPLE_LOADS)
    a = daily_summary(join_hourly(w, e)).collect()
    b = daily_summary_from_sides(w, e).collect()
    c = daily_summary_from_load_rollup(w, e).collect()
    assert a == b == c and len(a) == 1
    r = a[0]
    assert r.activity_date == dt.date(2026, 3, 13)
    assert (r.min_load_mw, r.max_load_mw) == (fx.dec(min(fx.SAMPLE_LOADS)), fx.dec(max(fx.SAMPLE_LOADS)))
    assert (r.avg_load_mw, r.total_load_mw) == (fx.mean2(fx.SAMPLE_LOADS), fx.dec(sum(map(fx.dec, fx.SAMPLE_LOADS))))
    assert r.avg_temperature == fx.mean2(fx.SAMPLE_TEMPS[:10])


def test_join_multiplies_duplicates_and_drops_unmatched(spark):
    w = _weather(spark)
    e = _energy(spark, [10.0, 20.0]).unionByName(_energy(spark, [30.0]))  # hour 0 twice
    j = join_hourly(w, e)
    assert j.count() == 3
    assert sorted(r.load_mw for r in j.where(F.hour("time") == 0).collect()) == [10.0, 30.0]
    both = daily_summary_from_sides(w, e).first()
    assert both == daily_summary(j).first() == daily_summary_from_load_rollup(w, e).first()


def test_overflow_raises(spark):
    w = _weather(spark)
    e = _energy(spark, [60_000_000.0, 60_000_000.0])
    with pytest.raises(Exception):
        daily_summary(join_hourly(w, e)).collect()


def _daily(spark, loads, country="DE"):
    rows = [(country, dt.date(2026, 3, 1) + dt.timedelta(days=i), Decimal(str(v)).quantize(Decimal("0.01")))
            for i, v in enumerate(loads)]
    return spark.createDataFrame(rows, "country string, activity_date date, avg_load_mw decimal(10,2)")


@pytest.mark.parametrize("fn", [anomaly_days, anomaly_days_grouped])
def test_anomaly_six_days(spark, fn):
    got = fn(_daily(spark, [100] * 5 + [200])).collect()
    assert len(got) == 1
    r = got[0]
    assert r.activity_date == dt.date(2026, 3, 6)
    assert round(r.mean_load, 6) == 116.666667
    assert round(r.stddev_load, 6) == 40.824829
    assert round(r.deviation_score, 6) == 2.041241


@pytest.mark.parametrize("fn", [anomaly_days, anomaly_days_grouped])
def test_anomaly_never_flags_small_or_flat(spark, fn):
    assert fn(_daily(spark, [55008.53] * 7)).count() == 0       # sd 0: no division error
    assert fn(_daily(spark, [42.0])).count() == 0               # sd NULL
    assert fn(_daily(spark, [1, 1, 1, 1, 1000])).count() == 0  # 5 days: max score 1.79
