import pytest

from gridlake.operators import quality
from gridlake.dims import countries, dim_city


def test_not_null_counts(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("c", 1)], "x string, y int")
    got = {r.column: r.failures for r in quality.not_null(df, "t", ["x", "y"]).collect()}
    assert got == {"x": 1, "y": 2}


def test_accepted_values_reference_list_and_dimension(spark):
    df = spark.createDataFrame([("DE",), ("HU",), ("HU",), (None,)], "country string")
    assert quality.accepted_values(df, "t", "country").first().failures == 2
    assert quality.accepted_values(df, "t", "country", ["DE", "HU"]).first().failures == 0
    assert {r.value: r.failures for r in quality.rejected_values(df, "country").collect()} == {"HU": 2}


def test_gate_raises(spark):
    df = spark.createDataFrame([(None,)], "x string")
    with pytest.raises(quality.QualityGateError):
        quality.assert_passed(quality.not_null(df, "t", ["x"]))
    quality.assert_passed(quality.not_null(spark.createDataFrame([("a",)], "x string"), "t", ["x"]))


def test_unique_and_ready(spark):
    import datetime as dt
    rows = [("B", dt.datetime(2026, 3, 3, h)) for h in range(24)] + [("B", dt.datetime(2026, 3, 3, 5))]
    df = spark.createDataFrame(rows, "city_name string, time timestamp")
    assert quality.unique_key(df, "t", ["city_name", "time"]).first().failures == 1
    r = quality.partition_ready(df).first()
    assert (r.rows, r.hours, r.complete) == (25, 24, True)


def test_first_city_per_country(spark):
    got = {r.country: r.city_name for r in countries(spark).collect()}
    assert got["DE"] == "Berlin" and len(got) == 9
    assert dim_city(spark).count() == 9


def test_table_checks_one_pass(spark):
    df = spark.createDataFrame([("DE", None), ("HU", 1.0), (None, 2.0)], "country string, load double")
    got = {(r.column, r.check): r.failures for r in quality.table_checks(df, "t", ["country", "load"], "country").collect()}
    assert got == {("country", "not_null"): 1, ("load", "not_null"): 1, ("country", "accepted_values"): 1}


def test_resolve_entities_top_candidate(spark):
    from gridlake.operators.firsts import resolve_entities
    names = spark.createDataFrame([("Berlin",), ("Nowhere",)], "query string")
    cands = spark.createDataFrame([("Berlin", 2, "Berlin, Maryland", 39.3, -75.2),
                                   ("Berlin", 1, "Berlin", 52.52437, 13.41053)],
                                  "query string, rank int, city_name string, latitude double, longitude double")
    got = {r.query: (r.city_name, r.latitude) for r in resolve_entities(names, cands).collect()}
    assert got == {"Berlin": ("Berlin", 52.52437), "Nowhere": (None, None)}
