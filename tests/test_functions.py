import datetime as dt

from pyspark.sql import functions as F

from gridlake.functions import (compact_stamp, date_key, half_up_mean, iso_offset, parse_iso,
                                points_per_hour, resolution_reason)


def test_parse_iso_shapes(spark):
    rows = [("2026-03-13T00:00",), ("2026-03-03T00:00:00+00:00",), ("2026-03-03T00:00Z",),
            ("2026-03-03T23:00:00-05:00",), ("junk",), (None,)]
    df = spark.createDataFrame(rows, "s string").select(parse_iso("s").alias("t"))
    got = [r.t for r in df.collect()]
    assert got[:4] == [dt.datetime(2026, 3, 13), dt.datetime(2026, 3, 3), dt.datetime(2026, 3, 3),
                       dt.datetime(2026, 3, 4, 4)]
    assert got[4:] == [None, None]


def test_formats(spark):
    df = spark.createDataFrame([("2026-03-03T05:07:09",)], "s string").select(parse_iso("s").alias("t"))
    r = df.select(iso_offset("t").alias("a"), compact_stamp("t").alias("b"), date_key("t").alias("c")).first()
    assert r.a == "2026-03-03T05:07:09+00:00"
    assert r.b == "20260303T0507"
    assert r.c == "year=2026/month=03/day=03"


def test_points_per_hour(spark):
    res = ["PT15M", "PT30M", "PT60M", None, "P1D", "PT120M", "PT0M", "PT7M", "PTxM"]
    df = spark.createDataFrame([(r,) for r in res], "r string")
    got = df.select(points_per_hour(F.col("r")).alias("p"), points_per_hour(F.col("r"), True).alias("f"),
                    resolution_reason(F.col("r")).alias("why")).collect()
    assert [r.p for r in got] == [4, 2, 1, 1, 1, None, None, 8, None]
    assert [r.f for r in got] == [4, 2, 1, 1, None, None, None, None, None]
    assert [r.why for r in got][5:7] == ["resolution_over_one_hour", "zero_resolution"]


def test_half_up_mean_is_exact(spark):
    # 1.005 is a tie at the 3rd decimal; exact decimal sums round it up.
    df = spark.createDataFrame([(1.00,), (1.01,)], "x double")
    r = df.agg(half_up_mean(F.sum(F.col("x").cast("decimal(18,2)")), F.count("x")).alias("m")).first()
    assert r.m == 1.01


def test_local_time_to_utc(spark):
    from gridlake.functions import utc_wall_clock
    df = spark.createDataFrame([("2026-03-03 12:00:00",)], "s string").select(F.to_timestamp("s").alias("t"))
    assert df.select(utc_wall_clock("t", "Europe/Berlin").alias("u")).first().u == dt.datetime(2026, 3, 3, 11)


def test_storage_conf_passthrough():
    from gridlake.session import storage_conf
    got = storage_conf({"fs.s3a.endpoint": "http://store.example:9000", "spark.sql.shuffle.partitions": "4"})
    assert got == {"spark.hadoop.fs.s3a.endpoint": "http://store.example:9000", "spark.sql.shuffle.partitions": "4"}
