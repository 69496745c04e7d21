"""Hot keys: a third of all rows on one key must not land in one task."""

import datetime as dt
from contextlib import contextmanager

from pyspark.sql import functions as F

from gridlake.operators.aggregate import daily_summary, daily_summary_from_load_rollup, daily_summary_from_sides
from gridlake.operators.join import join_hourly
from gridlake.session import scale_conf

BASE = dt.datetime(2026, 3, 3)


@contextmanager
def conf(spark, **settings):
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _sides(spark, n=30000):
    hot = F.col("id") % 3 == 0
    city = F.when(hot, F.lit("Berlin")).otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string")))
    # every hot reading is distinct (own second inside the hour, own value), as
    # real readings are: skew is detected on compressed shuffle bytes
    hour = F.when(hot, F.lit(BASE) + F.make_interval(secs=(F.col("id") % 3600).cast("decimal(18,6)")))
    hour = hour.otherwise(F.lit(BASE) + F.make_interval(hours=(F.col("id") % 24).cast("int")))
    w = spark.range(n).select(city.alias("city_name"), F.lit("DE").alias("country"), hour.alias("time"),
                              ((F.col("id") * 37) % 4001 / 10).alias("temperature"), F.lit(1).alias("humidity"),
                              F.lit(1.0).alias("wind_speed"), F.lit(0.0).alias("precipitation"),
                              F.lit(0).alias("weather_code"))
    hot_e = F.col("id") % 100 == 0
    e = spark.range(2000).select(
        F.when(hot_e, F.lit("Berlin")).otherwise(F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))).alias("city_name"),
        F.lit("DE").alias("country"),
        F.when(hot_e, F.lit(BASE)).otherwise(F.lit(BASE) + F.make_interval(hours=(F.col("id") % 24).cast("int"))).alias("time"),
        (F.col("id") % 11 + 100).cast("double").alias("load_mw"))
    return w, e


def test_hot_key_join_is_split_by_aqe(spark):
    w, e = _sides(spark)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
                        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}):
        j = join_hourly(w, e)
        assert len(j.collect()) == 10000 * 20 + 13200  # hot city-hour: 10,000 x 20 pairs
        plan = j._jdf.queryExecution().executedPlan().toString()
        # the 1:m join of weather rows to the load roll-up is split the same way
        d = daily_summary_from_load_rollup(w, e)
        d.collect()
        daily_plan = d._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    assert "SortMergeJoin(skew=true)" in daily_plan


def test_rollup_plan_equals_join_plan_on_hot_key(spark):
    w, e = _sides(spark)
    want = sorted(daily_summary(join_hourly(w, e)).collect())
    assert sorted(daily_summary_from_sides(w, e).collect()) == want
    assert sorted(daily_summary_from_load_rollup(w, e).collect()) == want


def test_scale_conf_bounds():
    small = scale_conf(10 * 2**30, executors=2, cores_per_executor=4)
    big = scale_conf(100 * 2**40, executors=1000, cores_per_executor=8)
    assert int(small["spark.sql.shuffle.partitions"]) >= 16
    assert int(big["spark.sql.shuffle.partitions"]) * 256 * 2**20 >= 0.3 * 100 * 2**40
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
