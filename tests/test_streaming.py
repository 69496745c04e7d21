"""Stream landing equals the batch decode; replays are deduplicated."""

from pyspark.sql import functions as F

from gridlake.operators import records
from gridlake.sources import messages
from gridlake.streaming.ingest import dedup_stream, land_stream

GOOD = [f'{{"city_name": "Berlin", "country": "DE", "time": "2026-03-0{d}T0{h}:00:00+00:00", "load_mw": {d}{h}.5}}'
        for d in (3, 4) for h in range(4)]
BAD = ['{"city_name": "Berlin", ', '{"city_name": "Berlin", "country": "DE", "load_mw": 1}',
       "{'city_name': 'Berlin', 'country': 'DE', 'time': '2026-03-03T23:00:00-05:00', 'load_mw': 7}"]


def test_stream_equals_batch(spark, scratch):
    base = scratch("stream")
    spark.createDataFrame([(t,) for t in GOOD[:4]], "value string").write.text(f"{base}/landing/a")
    spark.createDataFrame([(t,) for t in GOOD[4:] + BAD], "value string").write.text(f"{base}/landing/b")
    src = messages.read_topic(spark, fmt="text", path=f"{base}/landing/*", max_per_trigger=1)
    q = land_stream(src, "energy", f"{base}/bronze", f"{base}/quarantine", f"{base}/ckpt")
    q.awaitTermination()
    assert q.lastProgress is not None
    bronze = spark.read.text(f"{base}/bronze")
    streamed = records.valid_rows(records.decode_energy(bronze.select("value"))).select(
        "city_name", "country", "time", "load_mw")
    batch_in = spark.createDataFrame([(t,) for t in GOOD + BAD], "value string")
    batch = records.valid_rows(records.decode_energy(batch_in)).select("city_name", "country", "time", "load_mw")
    assert sorted(streamed.collect()) == sorted(batch.collect())
    # the -05:00 record lands in the UTC date 2026-03-04
    late = spark.read.text(f"{base}/bronze").where(F.col("value").contains('"load_mw":7'))
    assert late.select("day").first().day == 4
    reasons = sorted(r.reason for r in spark.read.parquet(f"{base}/quarantine").collect())
    assert reasons == ["malformed_record", "missing_time"]
    # rerun: the checkpoint makes it a no-op
    q2 = land_stream(messages.read_topic(spark, fmt="text", path=f"{base}/landing/*"), "energy",
                     f"{base}/bronze", f"{base}/quarantine", f"{base}/ckpt")
    q2.awaitTermination()
    assert spark.read.text(f"{base}/bronze").count() == bronze.count()


def test_replay_dedup(spark, scratch):
    base = scratch("dedup")
    for copy in ("1", "2"):
        spark.createDataFrame([(t,) for t in GOOD], "value string").write.text(f"{base}/in/copy={copy}")
    src = messages.read_topic(spark, fmt="text", path=f"{base}/in/*", max_per_trigger=1)
    typed = records.valid_rows(records.decode_energy(src)).select("city_name", "country", "time", "load_mw",
                                                                  "ingest_ts")
    q = (dedup_stream(typed, ["city_name", "country", "time"]).drop("ingest_ts").writeStream.format("parquet")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == len(GOOD)


def test_publish_report(spark, scratch):
    df = spark.createDataFrame([("DE", "a"), ("FR", "b"), (None, "c")], "key string, value string")
    report = messages.write_topic(df, fmt="parquet", path=scratch("topic"))
    assert report == {"rows": 3, "without_key": 1}


def test_two_streams_side_by_side(spark, scratch):
    """Weather and energy landings run as two queries at once."""
    base = scratch("two")
    w = ('{"city_name": "Berlin", "country": "DE", "latitude": 52.5, "longitude": 13.4, '
         '"time": "2026-03-13T00:00", "temperature": 7.5, "humidity": 61, "wind_speed": 8.4, '
         '"precipitation": 0.0, "weather_code": 3, "weather": "Overcast"}')
    spark.createDataFrame([(w,)], "value string").write.text(f"{base}/in/weather")
    spark.createDataFrame([(t,) for t in GOOD], "value string").write.text(f"{base}/in/energy")
    queries = [land_stream(messages.read_topic(spark, fmt="text", path=f"{base}/in/{k}"), k,
                           f"{base}/bronze/{k}", f"{base}/quarantine/{k}", f"{base}/ckpt/{k}")
               for k in ("weather", "energy")]
    for q in queries:
        q.awaitTermination()
    assert spark.read.text(f"{base}/bronze/weather").count() == 1
    assert spark.read.text(f"{base}/bronze/energy").count() == len(GOOD)


def test_processing_time_trigger_and_stop(spark, scratch):
    """A continuous query on a 1-second trigger drains and stops cleanly."""
    base = scratch("trigger")
    spark.createDataFrame([(t,) for t in GOOD], "value string").write.text(f"{base}/in")
    q = land_stream(messages.read_topic(spark, fmt="text", path=f"{base}/in"), "energy",
                    f"{base}/bronze", f"{base}/quarantine", f"{base}/ckpt",
                    available_now=False, processing_time="1 second")
    q.processAllAvailable()
    q.stop()
    assert not q.isActive
    assert spark.read.text(f"{base}/bronze").count() == len(GOOD)


def test_replay_dedup_keeps_late_events(spark, scratch):
    """Files arrive newest-first: nothing is dropped as late, replays are."""
    base = scratch("late")
    newest, oldest = GOOD[4:], GOOD[:4]
    spark.createDataFrame([(t,) for t in newest], "value string").write.text(f"{base}/in/a")
    spark.createDataFrame([(t,) for t in oldest], "value string").write.text(f"{base}/in/b")
    spark.createDataFrame([(t,) for t in GOOD], "value string").write.text(f"{base}/in/c")  # replay
    src = messages.read_topic(spark, fmt="text", path=f"{base}/in/*", max_per_trigger=1)
    typed = records.valid_rows(records.decode_energy(src)).select("city_name", "country", "time", "load_mw",
                                                                  "ingest_ts")
    q = (dedup_stream(typed, ["city_name", "country", "time"]).drop("ingest_ts").writeStream.format("parquet")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == len(GOOD)


def test_batch_report(spark, scratch):
    """A5: per micro-batch, rows written to bronze and rows rejected."""
    base = scratch("report")
    spark.createDataFrame([(t,) for t in GOOD[:4] + BAD[:1]], "value string").coalesce(1).write.text(f"{base}/in/a")
    spark.createDataFrame([(t,) for t in GOOD[4:] + BAD[1:]], "value string").coalesce(1).write.text(f"{base}/in/b")
    src = messages.read_topic(spark, fmt="text", path=f"{base}/in/*", max_per_trigger=1)
    q = land_stream(src, "energy", f"{base}/bronze", f"{base}/quarantine", f"{base}/ckpt",
                    report_root=f"{base}/report")
    q.awaitTermination()
    rep = spark.read.parquet(f"{base}/report").collect()
    assert len(rep) == 2
    assert sum(r.written for r in rep) == spark.read.text(f"{base}/bronze").count() == len(GOOD) + 1
    assert sum(r.rejected for r in rep) == spark.read.parquet(f"{base}/quarantine").count() == 2


def test_command_line_land_stream(spark, scratch, capsys):
    import json

    from gridlake.__main__ import main
    base = scratch("cli-stream")
    spark.createDataFrame([(t,) for t in GOOD + BAD], "value string").coalesce(1).write.text(f"{base}/in")
    assert main(["land-stream", "--root", f"{base}/lake", "--kind", "energy", "--path", f"{base}/in"]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report == {"batches": 1, "rows": len(GOOD) + len(BAD)}
    assert spark.read.text(f"{base}/lake/bronze/energy").count() == len(GOOD) + 1


def test_writers_share_a_bronze_folder(spark, scratch):
    """Two streams with their own checkpoints and a batch landing of the same day keep each other's rows."""
    from gridlake.sources.lake import write_bronze
    base = scratch("shared")
    for k, part in enumerate((GOOD[:2], GOOD[2:4])):
        spark.createDataFrame([(t,) for t in part], "value string").write.text(f"{base}/in{k}")
        land_stream(messages.read_topic(spark, fmt="text", path=f"{base}/in{k}"), "energy", f"{base}/bronze",
                    f"{base}/quarantine", f"{base}/ckpt{k}").awaitTermination()
    for load in (1.0, 2.0):
        rows = spark.createDataFrame([("Rome", "IT", "2026-03-03T05:00:00+00:00", load)],
                                     "city_name string, country string, time string, load_mw double")
        write_bronze(rows, f"{base}/bronze", mode="overwrite", batch="landed")
    assert spark.read.text(f"{base}/bronze").count() == 5
