"""Block means over point *rows*.

For points stored one per row (a point table instead of a document), the
block of a point is ``position div n`` inside its group; the position
comes from ``index_within_group`` so that a huge group is still spread
over many tasks, and the block sums are a plain aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.numeric import exact_total, half_up_mean
from gridlake.operators.sequence import index_within_group


def block_means(points: DataFrame, group: list[str], order: list[str], value: str,
                n: int, start_col: str) -> DataFrame:
    """Mean of each full block of ``n`` consecutive points per group.

    Output: group columns, ``block``, ``time`` = group start + block hours,
    ``load_mw`` (half-up, 2 decimals) and ``points``.
    """
    idx = index_within_group(points, group, order, "pos")
    blocks = (idx.groupBy(*group, (F.col("pos") / n).cast("long").alias("block"))
              .agg(exact_total(value).alias("_s"), F.count(F.lit(1)).alias("points"),
                   F.min(start_col).alias("_start")))
    return (blocks.where(F.col("points") == n)
            .select(*group, "block",
                    (F.col("_start") + F.make_interval(hours=F.col("block").cast("int"))).alias("time"),
                    half_up_mean(F.col("_s"), F.lit(n)).alias("load_mw"), "points"))
