"""Message streams (A1-A5): ``(key, value)`` records on a topic.

With the Kafka connector on the classpath the format is ``kafka``; the
same functions accept any streaming file format (``text``/``json``), which
is what runs here (no Kafka jar in this image).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

WEATHER_TOPIC = "raw.weather.hourly"
ENERGY_TOPIC = "raw.energy.demand"


def read_topic(spark: SparkSession, topic: str | None = None, fmt: str = "kafka",
               path: str | None = None, max_per_trigger: int | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    """A1/A2/L1/L4: streaming ``key, value`` frame, earliest offsets first."""
    reader = spark.readStream.format(fmt)
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("subscribe", topic or "")
        opts.setdefault("startingOffsets", "earliest")
        if max_per_trigger:
            opts.setdefault("maxOffsetsPerTrigger", str(max_per_trigger))
    elif max_per_trigger:
        opts.setdefault("maxFilesPerTrigger", str(max_per_trigger))
    for k, v in opts.items():
        reader = reader.option(k, v)
    df = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        return df.select(F.col("key").cast("string"), F.col("value").cast("string"),
                         F.col("timestamp").alias("ingest_ts"))
    return df.select(F.lit(None).cast("string").alias("key"), F.col("value"),
                     F.current_timestamp().alias("ingest_ts"))


def write_topic(messages: DataFrame, topic: str | None = None, fmt: str = "kafka",
                path: str | None = None, options: dict[str, str] | None = None) -> dict:
    """A3/A4/A5: publish ``key, value`` rows; returns the write report.

    A failed write raises (the whole job fails and can be rerun); the
    report counts written rows in the same job through an Observation.
    """
    obs = Observation("published")
    counted = messages.observe(obs, F.count(F.lit(1)).alias("rows"),
                               F.count_if(F.col("key").isNull()).alias("without_key"))
    writer = counted.write.format(fmt)
    if fmt == "kafka":
        writer = writer.option("topic", topic)
    else:
        writer = writer.mode("append")
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path) if path else writer.save()
    return dict(obs.get)
