"""Mixing sources to target weights (Efraimidis-Spirakis sampling, native).

Each document draws an exponential key ``-ln(u) / weight`` from its id (so
reruns agree); within a source, documents in key order are a weighted
sample without replacement.  A source's token budget is spent in complete
epochs first (every document once per epoch); what is left is the prefix
of the key order, the last document being cut so that the budget is met
to the word.  Only DataFrame functions are used.

Scale: texts are never shuffled, only (id, source, size, key).  The rows are
dealt by ranges of (source, key, id, size, row number), bounds sampled from
the rows themselves, into slices of about equal size whatever the weights
and however often an id repeats.  So a source with a third of all rows is
summed by many tasks; the slices' totals give each its offset.

Edge cases: a null text has size 0; a null source is a source of its own
(last); a null, non-positive or NaN weight counts as 1; a source without
words has target 0; ties in the key go by id, then size; rows that repeat
an id are mixed one by one; an empty table gives an empty result.  Other
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm.staging import shuffle_partitions, stage, uniform01

WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size in words) of each document."""
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sized: DataFrame, cycle: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5,
                   max_epochs: float = 2.0) -> DataFrame:
    """One row per source: (source, n_docs, source_size, weight, target).

    The sources, by code point with null last, weigh ``cycle`` repeating and
    share ``share`` x all words; a source stops at ``max_epochs`` x its size
    and its excess is shared again by weight.  The fixed point has a closed
    form: sources stop in the order of cap / weight, so with the first k
    stopped the rest get ``rate = (budget - caps) / weights`` per weight,
    and k is the first for which no further source would pass its cap.
    The windows below run over the table of sources, not over documents.
    """
    per = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    spot = (F.row_number().over(by_name) - 1) % len(cycle)
    weights = F.array(*[F.lit(float(c)) for c in cycle])
    per = per.withColumn("weight", F.element_at(weights, spot + 1)) \
        .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))) \
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
    stop_order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = stop_order.rowsBetween(Window.unboundedPreceding, -1)
    here_on = stop_order.rowsBetween(0, Window.unboundedFollowing)
    rate = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(here_on)
    per = per.withColumn("rate", rate)
    # the first source in stop order that stays below its cap fixes the rate of all later ones
    free = F.min(F.when(F.col("rate") * F.col("weight") <= F.col("cap"),
                        F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"),
                                 F.col("rate").alias("rate")))).over(every)
    per = per.withColumn("free_rate", free["rate"])
    return per.select("source", "n_docs", "source_size", "weight",
                      F.coalesce(F.least(F.col("cap"), F.col("free_rate") * F.col("weight")),
                                 F.col("cap")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        quality: DataFrame | None = None, seed: int = 0, cycle: tuple[float, ...] = (3.0, 1.0, 2.0),
        share: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """(id, source, size, source_size, target, weight, key, taken) per document.

    ``quality``: optional (id, weight) table; a document without a weight
    there counts as 1, an id with several rows there as their largest.
    """
    base = sizes(docs, id_col, text_col, source_col)
    return mix_sized(base, quality, seed, cycle, share, max_epochs)


def mix_sized(sized: DataFrame, quality: DataFrame | None = None, seed: int = 0,
              cycle: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5,
              max_epochs: float = 2.0) -> DataFrame:
    """``mix`` over a table that has (id, source, size), other columns kept."""
    if quality is not None:
        q = quality.toDF("id", "weight").groupBy("id").agg(F.max("weight").alias("weight"))
        sized = sized.join(q, "id", "left")
    else:
        sized = sized.withColumn("weight", F.lit(1.0))
    sized = sized.withColumn("weight", F.when((F.col("weight") > 0) & ~F.isnan(F.col("weight").cast("double")),
                                              F.col("weight").cast("double")).otherwise(1.0)) \
        .withColumn("key", exponential_key(F.col("weight"), F.col("id"), seed))
    sized = stage(sized.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    targets = stage(source_targets(sized, cycle, share, max_epochs), "mix-targets")

    # null sources need a key that joins; 0/1 marks them apart from any text
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("no_source", F.col("source").isNull()) \
            .withColumn("source_key", F.coalesce(F.col("source").cast("string"), F.lit("")))

    t = keyed(targets).select("no_source", "source_key", "source_size", "target")
    d = stage(in_slices(keyed(sized)), "mix-slices").join(t, ["no_source", "source_key"])
    place = ["no_source", "source_key", "slice"]
    totals = d.groupBy(*place).agg(F.sum("size").alias("slice_size"))
    earlier = Window.partitionBy("no_source", "source_key").orderBy("slice") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*place, F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*place).orderBy(*SAMPLE_ORDER) \
        .rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .join(offsets, place)
    # epochs that the target holds completely, then the rest in key order
    budget = F.round(F.col("target")).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("offset") - F.col("inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest))
    drop = ["no_source", "source_key", "slice", "inside", "offset", "row"]
    return d.withColumn("taken", taken.cast("long")).drop(*drop)


#: order of a source's rows; the row number makes it total
SAMPLE_ORDER = ["key", "id", "size", "row"]


def in_slices(keyed: DataFrame) -> DataFrame:
    """``keyed`` with ``slice``, a number that grows with a source's sample
    order; to be staged, so that every reader sees the same slices."""
    return keyed.repartitionByRange(shuffle_partitions(keyed.sparkSession), "no_source", "source_key", *SAMPLE_ORDER) \
        .withColumn("slice", F.spark_partition_id())


def exponential_key(weight: Column, ident: Column, seed: int = 0) -> Column:
    """Efraimidis-Spirakis key: exponential with rate ``weight``; small keys
    come first, so heavier documents tend to be taken earlier."""
    return -F.log(uniform01(ident, salt=seed)) / weight
