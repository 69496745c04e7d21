import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["city_name", "country", "activity_date"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_listed():
    qs, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(qs)
    assert len(qs) >= 30
