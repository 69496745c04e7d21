from gridlake.operators.flatten import flatten_weather, unknown_codes
from gridlake.sources import payloads
from tests import fixtures as fx


def test_flatten_sample_day(spark, scratch):
    path = scratch("payload")
    text = fx.weather_payload("Berlin", "DE", 52.52437, 13.41053, "2026-03-13", fx.SAMPLE_TEMPS,
                              fx.SAMPLE_HUMS, fx.SAMPLE_WINDS, [0.0] * 24, fx.SAMPLE_CODES)
    spark.createDataFrame([(text,)], "value string").write.text(path)
    rows = flatten_weather(payloads.read_weather_payloads(spark, path)).collect()
    assert len(rows) == 24
    first = rows[0].asDict()
    assert first["time"] == "2026-03-13T00:00" and first["temperature"] == fx.SAMPLE_TEMPS[0]
    assert first["humidity"] == fx.SAMPLE_HUMS[0] and first["weather"] == "Clear sky"
    assert "shortwave_radiation" not in first
    assert rows[23].weather == "Overcast"


def test_unknown_code(spark, scratch):
    path = scratch("payload")
    text = fx.weather_payload("Berlin", "DE", 52.5, 13.4, "2026-03-13", [1.0, 2.0], [1, 2], [1.0, 1.0],
                              [0.0, 0.0], [4, 3])
    spark.createDataFrame([(text,)], "value string").write.text(path)
    bad = unknown_codes(flatten_weather(payloads.read_weather_payloads(spark, path))).collect()
    assert [r.weather_code for r in bad] == [4]
