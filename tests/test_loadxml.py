import datetime as dt

from gridlake.operators.loadxml import load_records, rejected_documents
from tests.fixtures import load_xml


def _run(spark, xmls, by_position=False):
    df = spark.createDataFrame([("DE", "Berlin", x) for x in xmls], "country string, city_name string, xml string")
    return sorted(load_records(df, by_position).collect(), key=lambda r: r.time)


def test_block_mean_drops_partial_block(spark):
    got = _run(spark, [load_xml([("2026-03-03T00:00Z", "PT15M", ["10", "20", "30", "41", "50"])])])
    assert [(r.time, r.load_mw) for r in got] == [(dt.datetime(2026, 3, 3), 25.25)]


def test_skipped_points_do_not_count(spark):
    got = _run(spark, [load_xml([("2026-03-03T00:00Z", "PT15M", ["10", None, "30", "abc", "50", "51", "52"])])])
    assert [(r.time, r.load_mw) for r in got] == [(dt.datetime(2026, 3, 3), 35.25)]


def test_by_position_option(spark):
    got = _run(spark, [load_xml([("2026-03-03T00:00Z", "PT15M", ["10", None, "30", "40", "1", "2", "3", "4"])])],
               by_position=True)
    assert [(r.time.hour, r.load_mw) for r in got] == [(1, 2.5)]


def test_resolutions_and_hours(spark):
    xml = load_xml([("2026-03-03T00:00Z", None, ["1", "2"]),
                    ("2026-03-04T00:00Z", "P1D", ["7"]),
                    ("2026-03-05T00:00Z", "PT120M", ["1", "2"]),
                    ("2026-03-06T00:00Z", "PT0M", ["1"]),
                    (None, "PT60M", ["5"])])
    got = _run(spark, [xml])
    assert [(r.time, r.load_mw) for r in got] == [
        (dt.datetime(2026, 3, 3, 0), 1.0), (dt.datetime(2026, 3, 3, 1), 2.0), (dt.datetime(2026, 3, 4), 7.0)]


def test_bad_documents_are_quarantined(spark):
    good = load_xml([("2026-03-05T00:00Z", "PT120M", ["1"])])
    df = spark.createDataFrame([("DE", "Berlin", "<bad"), ("DE", "Berlin", ""), ("DE", "Berlin", good)],
                               "country string, city_name string, xml string")
    assert _run(spark, ["<bad", ""]) == []
    reasons = sorted(r.reason for r in rejected_documents(df).collect())
    assert reasons == ["empty_payload", "malformed_xml", "resolution_over_one_hour"]


def test_rounding_half_up(spark):
    got = _run(spark, [load_xml([("2026-03-03T00:00Z", "PT30M", ["1.00", "1.01"])])])
    assert got[0].load_mw == 1.01


def test_raw_xml_files_match_landed_rows(spark, scratch):
    """A7 via Spark's XML source: country/city from folders, same hours."""
    import os
    from gridlake.operators.loadxml import load_records_from_files
    from gridlake.session import local_fs_path
    root = scratch("xmlfiles")
    doc = load_xml([("2026-03-03T00:00Z", "PT15M", ["10", "20", "30", "41", "50"]),
                    ("2026-03-04T00:00Z", None, ["1", "2"])])
    folder = local_fs_path(f"{root}/country=DE/city_name=Berlin")
    os.makedirs(folder)
    with open(f"{folder}/doc.xml", "w") as fh:
        fh.write(doc)
    with open(f"{folder}/broken.xml", "w") as fh:
        fh.write("<bad")
    got = sorted((r.city_name, r.country, r.time, r.load_mw) for r in load_records_from_files(spark, root).collect())
    want = sorted((r.city_name, r.country, r.time, r.load_mw) for r in _run(spark, [doc]))
    assert got == want and len(got) == 3


def test_several_series_and_periods(spark):
    """Each period is downsampled on its own, from its own start."""
    xml = load_xml([("2026-03-03T00:00Z", "PT30M", ["1", "3", "5", "7"]),
                    ("2026-03-03T02:00Z", "PT60M", ["10", "20"]),
                    ("2026-03-04T00:00Z", "PT15M", ["4", "4", "4", "4", "9"])])
    got = [(r.time, r.load_mw) for r in _run(spark, [xml])]
    assert got == [(dt.datetime(2026, 3, 3, 0), 2.0), (dt.datetime(2026, 3, 3, 1), 6.0),
                   (dt.datetime(2026, 3, 3, 2), 10.0), (dt.datetime(2026, 3, 3, 3), 20.0),
                   (dt.datetime(2026, 3, 4, 0), 4.0)]
