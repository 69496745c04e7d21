from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlake.operators.blocks import block_means
from gridlake.operators.sequence import index_within_group
from tests.conftest import SF_ORACLE


def test_matches_row_number_including_hot_group(spark):
    ev = spark.read.parquet(f"{SF_ORACLE}/events.parquet")
    # a third of all rows in one group
    ev = ev.withColumn("g", F.when(F.col("event_id") % 3 == 0, F.lit("hot")).otherwise(F.col("event_type")))
    got = index_within_group(ev, ["g"], ["ts", "event_id"], num_partitions=16)
    want = ev.withColumn("idx", F.row_number().over(Window.partitionBy("g").orderBy("ts", "event_id")) - 1)
    assert got.count() == ev.count()
    assert got.select("event_id", "idx").exceptAll(want.select("event_id", "idx")).count() == 0


def test_block_means_full_blocks_only(spark):
    rows = [("a", i, float(v)) for i, v in enumerate([10, 20, 30, 41, 50])]
    df = spark.createDataFrame(rows, "g string, i int, v double").withColumn(
        "start", F.to_timestamp(F.lit("2026-03-03 00:00:00")))
    got = block_means(df, ["g"], ["i"], "v", 4, "start").collect()
    assert [(r.block, r.load_mw, r.points) for r in got] == [(0, 25.25, 4)]
