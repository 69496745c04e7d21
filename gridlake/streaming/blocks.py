"""Block means over a stream of points.

Points arrive in any order within the watermark's delay.  A block is n
consecutive points of its group by (time, id), so a late point moves all
later blocks of its group.  The state of a group is its points so far, as
packed arrays in order; a micro-batch merges its points in and emits the
blocks from the first changed one on (update mode).  Once the watermark has
passed the end of the group's window, its state is dropped: by then the
emitted blocks are final.

The sink keeps the last version of each block: ``write_blocks`` appends the
updates of a micro-batch under its batch id (a replay replaces them) and
``latest_blocks`` reads the greatest version.  Points that come after the
watermark has passed are dropped by Spark and are counted by its metrics.
The state of a group is bounded by the points of one window (a day).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gridlake.functions.numeric import READING_DECIMAL, TOTAL_DECIMAL, half_up_mean

STATE = "times binary, ids binary, values binary"
UPDATES = "event_type string, window_start timestamp, block long, points long, total string"


def block_stream(points: DataFrame, n: int, window: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Updates (event_type, window_start, block, points, total) of the blocks
    of a point stream (event_type, ts, event_id, value).

    ``total`` is the exact sum in units of 1e-16, as text; ``points`` is below
    n for a block that is not full yet.  Points without a value do not count.
    """
    span = pd.Timedelta(window)

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        kind, start = key
        # values travel as unscaled integers of the reading decimal: sums are exact
        new = pd.concat([p for p in parts if len(p)])
        times, ids = new["ts"].to_numpy("datetime64[us]").astype(np.int64), new["event_id"].to_numpy(np.int64)
        values = np.array([int(v.scaleb(16)) for v in new["value"]], dtype=object)
        had = 0
        if state.exists:
            t, i, v = state.get
            old = np.frombuffer(t, np.int64), np.frombuffer(i, np.int64)
            had = len(old[0])
            values = np.concatenate([np.array([int(x) for x in v.decode().split()], dtype=object), values])
            times, ids = np.concatenate([old[0], times]), np.concatenate([old[1], ids])
        order = np.lexsort((ids, times))
        again = np.zeros(len(order), dtype=bool)           # a replayed point counts once
        again[1:] = (times[order][1:] == times[order][:-1]) & (ids[order][1:] == ids[order][:-1])
        order = order[~again]
        moved = np.flatnonzero(order != np.arange(len(order)))
        first = min(had, int(moved[0]) if len(moved) else had) // n       # blocks before it are as they were
        times, ids, values = times[order], ids[order], values[order]
        state.update((times.tobytes(), ids.tobytes(), " ".join(str(x) for x in values).encode()))
        state.setTimeoutTimestamp(max(int((start + span).timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        rows = [(kind, start, b, len(values[b * n:(b + 1) * n]), str(int(sum(values[b * n:(b + 1) * n]))))
                for b in range(first, -(-len(values) // n))]
        yield pd.DataFrame(rows, columns=["event_type", "window_start", "block", "points", "total"])

    keyed = points.withWatermark("ts", delay).withColumn("window_start", F.window("ts", window)["start"]) \
        .withColumn("value", F.col("value").cast(READING_DECIMAL)).where("value is not null")
    return keyed.groupBy("event_type", "window_start").applyInPandasWithState(
        update, UPDATES, STATE, "update", GroupStateTimeout.EventTimeTimeout)


def write_blocks(updates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the updates of each micro-batch under its version."""
    def write(batch: DataFrame, version: int) -> None:
        batch.withColumn("version", F.lit(version).cast("long")).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)

    return updates.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def latest_blocks(stored: DataFrame, n: int) -> DataFrame:
    """(event_type, day, block, time, load_mw, points) of the full blocks, by their last version."""
    last = stored.groupBy("event_type", "window_start", "block").agg(
        F.max_by(F.struct("points", "total"), "version").alias("v"))
    total = (F.col("v.total").cast("decimal(38,0)") / F.lit(10**16).cast("decimal(17,0)")).cast(TOTAL_DECIMAL)
    return last.where(F.col("v.points") == n).select(
        "event_type", F.col("window_start").alias("day"), "block",
        (F.col("window_start") + F.make_interval(hours=F.col("block").cast("int"))).alias("time"),
        half_up_mean(total, F.lit(n)).alias("load_mw"), F.col("v.points").alias("points"))
