"""Dense 0-based position of each row inside its group, without ever
gathering a group in one task.

``row_number() over (partition by g order by o)`` sorts each whole group in
a single task; a group holding a third of the data would then run on one
core.  Here only the key columns are range-partitioned on ``(g, o)``, so a
big group is cut across many partitions (slices):

1. range-partition the rows, sort inside partitions, and tag each row with
   its slice (partition id) and ``monotonically_increasing_id``, which grows
   with the global order;
2. ``checkpoint()`` the tagged rows into the shared checkpoint folder: the
   range bounds are sampled once, and every later read (and any recompute
   after a lost executor) sees the same slices and ids;
3. per (group, slice): first id and row count - at most
   ``slices + groups`` rows - and a running sum of the counts over the
   slices of a group gives each slice's offset;
4. position = offset + (id - first id of the slice): a join of the rows
   with that small table on (group, slice), which AQE broadcasts once it has
   measured it.

``order`` must make the order total inside a group (end it with a unique
column) so that positions are deterministic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.session import ensure_checkpoint_dir


def index_within_group(df: DataFrame, group: list[str], order: list[str],
                       index_col: str = "idx", num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [F.col(c) for c in group + order]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_slice", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    slices = (tagged.groupBy(*group, "_slice")
              .agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n")))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    small = slices.select(*[F.col(c).alias(f"_s_{c}") for c in group],
                          F.col("_slice").alias("_s_slice"), "_first", "_offset")
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in group]
                  + [F.col("_slice") == F.col("_s_slice")])
    out = tagged.join(small, cond, "inner")
    return out.select(*df.columns, (F.col("_offset") + F.col("_mid") - F.col("_first")).alias(index_col))
