"""Connected components of an edge table, in Spark.

Alternating large-star / small-star rounds (each node hangs its larger,
then its smaller neighbours on the smallest neighbour) until nothing
changes; about log(diameter) rounds.  Minima are combined before the
shuffle and joined back, so a node with very many edges is an ordinary
skewed join; every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.staging import stage


def _hang(directed: DataFrame) -> DataFrame:
    """(u, v) -> (v, least of u's neighbours and u)."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return directed.join(least, "u")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: bigint, not
    null); component is the smallest node reachable.  Self-loops and
    repeated edges are allowed; an empty table gives an empty result."""
    now = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .filter("u <> v").distinct(), "edges")
    nodes = now
    before = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        small = _hang(large)
        now = stage(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = nodes.select(F.explode(F.array("u", "v")).alias("node")).distinct() \
        .join(stars.select("node"), "node", "left_anti").withColumn("component", F.col("node"))
    return stars.union(roots)
