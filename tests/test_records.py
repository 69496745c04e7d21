from pyspark.sql import functions as F

from gridlake.operators import records


def _decode(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return {r.raw: r for r in records.decode_energy(df).collect()}


def test_single_quotes_and_python_none(spark):
    ok = "{'city_name': 'Berlin', 'country': 'DE', 'time': '2026-03-03T00:00:00+00:00', 'load_mw': 1.5}"
    none = "{'city_name': 'Berlin', 'country': 'DE', 'time': '2026-03-03T00:00:00+00:00', 'load_mw': None}"
    got = _decode(spark, [ok, none])
    assert got[ok].reason is None and got[ok].load_mw == 1.5
    assert got[none].reason == "malformed_record"


def test_apostrophe_kept(spark):
    rec = '{"city_name": "Val d\'Oise", "country": "FR", "time": "2026-03-03T00:00:00+00:00", "load_mw": 2}'
    got = _decode(spark, [rec])[rec]
    assert got.city_name == "Val d'Oise" and got.reason is None and got.load_mw == 2.0


def test_bad_fields_are_quarantined(spark):
    bad_measure = '{"city_name": "Berlin", "country": "DE", "time": "2026-03-03T00:00", "load_mw": "abc"}'
    bad_time = '{"city_name": "Berlin", "country": "DE", "time": "junk", "load_mw": 1}'
    no_time = '{"city_name": "Berlin", "country": "DE", "load_mw": 1}'
    broken = '{"city_name": "Berlin", '
    got = _decode(spark, [bad_measure, bad_time, no_time, broken])
    assert got[bad_measure].reason == "bad_measure"
    assert got[bad_time].reason == "bad_time"
    assert got[no_time].reason == "missing_time"
    assert got[broken].reason == "malformed_record"
    q = records.quarantine_rows(records.decode_energy(
        spark.createDataFrame([(t,) for t in [bad_measure, broken]], "value string")), "energy")
    assert sorted(r.reason for r in q.collect()) == ["bad_measure", "malformed_record"]


def test_unknown_weather_code(spark):
    base = ('{"city_name": "Berlin", "country": "DE", "latitude": 52.5, "longitude": 13.4, '
            '"time": "2026-03-13T00:00", "temperature": 7.5, "humidity": 61, "wind_speed": 8.4, '
            '"precipitation": 0.0, "weather_code": %s}')
    df = spark.createDataFrame([(base % c,) for c in ["3", "4", "null"]], "value string")
    got = sorted(((r.weather_code, r.weather, r.reason) for r in records.decode_weather(df).collect()),
                 key=str)
    assert (3, "Overcast", None) in got
    assert (4, None, "unknown_weather_code") in got
    assert (None, None, "unknown_weather_code") in got


def test_encode_decode_roundtrip(spark):
    df = spark.createDataFrame([("Berlin", "DE", 45668.64)], "city_name string, country string, load_mw double")
    df = df.withColumn("time", F.to_timestamp(F.lit("2026-03-03 01:00:00")))
    enc = records.encode_records(df, "country")
    assert enc.first().key == "DE"
    back = records.valid_rows(records.decode_energy(enc)).first()
    assert back.load_mw == 45668.64 and back.time.hour == 1 and back.key == "DE"
