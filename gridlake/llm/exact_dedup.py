"""Exact dedup: 128-bit content hashes, with the bytes compared inside groups.

Texts are equal when they are identical without their white space (the six
ASCII characters space and 0x09-0x0D).  Rows meet by the MD5 of that
normalised text.  Inside every hash that two or more rows share, the least
and the greatest normalised text are compared byte by byte: where they
differ, the hash has collided, and its rows are grouped by the text itself.
Of equal texts the one with the most code points stays, then the one with
the smallest id.

Scale: only (hash, id, length) of a row are shuffled; counts, survivors and
the least and greatest text of a hash are combined before the shuffle, so
a group of copies that holds a third of all rows arrives as one row a task.
A bitmap with a fixed size bound keeps texts of hashes that no other row
has out of the comparison; what passes by chance is compared like the rest.

Edge cases: a null text is the empty text, equal to texts of white space
only; null ids come after all others (``keep_id`` is null only where every
id of the group is); rows that repeat id and length of the staying row say
``kept`` as well (``drop_copies`` gives out one row of each group); an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.llm import membership
from gridlake.llm.staging import stage

#: The characters that do not count.
WHITE = " \t\n\x0b\f\r"


def normalised(text: Column) -> Column:
    """``text`` without white space; the empty text for null."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def content_hash(text: Column) -> Column:
    """128 bits of a text as two longs."""
    md5 = F.md5(text.cast("binary"))
    half = [F.conv(F.substring(md5, at, 16), 16, -10).cast("long") for at in (1, 17)]
    return F.struct(half[0].alias("h1"), half[1].alias("h2"))


def hashed(docs: DataFrame, id_col: str, text_col: str, hash_of) -> DataFrame:
    """(id, length, h1, h2, plain) per row; ``plain`` is the normalised text."""
    base = docs.select(F.col(id_col).alias("id"), F.char_length(F.coalesce(text_col, F.lit(""))).cast("long").alias("length"),
                       F.explode(F.array(normalised(F.col(text_col)))).alias("plain"))
    return base.select("id", "length", hash_of(F.col("plain")).alias("h"), "plain") \
        .select("id", "length", "h.h1", "h.h2", "plain")


def best_row() -> Column:
    """Order of the rows of a group: most code points, then least id, null ids last."""
    return F.min(F.struct((-F.col("length")).alias("less"), F.col("id").isNull().alias("unnamed"), F.col("id").alias("id")))


def collided_hashes(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Staged (h1, h2) of the hashes whose rows do not all have the same bytes."""
    spark = rows.sparkSession
    shared = stage(groups.filter("group_size > 1").select("h1"), "exact-shared")
    # the bitmap takes the top bits of a well-mixed number
    mixed = shared.select(F.xxhash64("h1").alias("key"))
    sent = spark.sparkContext.broadcast(membership.build(mixed, "key", shared.count()))

    @F.arrow_udf(T.BooleanType())
    def may_repeat(keys: pa.Array) -> pa.Array:
        return pa.array(sent.value.contains(keys.to_numpy(zero_copy_only=False).view("uint64")))

    compared = rows.filter(may_repeat(F.xxhash64("h1"))).groupBy("h1", "h2") \
        .agg(F.min("plain").alias("low"), F.max("plain").alias("high"))
    return stage(compared.filter("low <> high").select("h1", "h2", F.lit(True).alias("collided")), "exact-collided")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=content_hash) -> DataFrame:
    """(id, length, h1, h2, own, keep_id, group_size, kept, text_sha256) per
    row; (h1, h2, own) names the group, ``own`` is the normalised text where
    its hash has collided and empty elsewhere."""
    rows = hashed(docs, id_col, text_col, hash_of)
    digest = F.sha2(F.col("plain").cast("binary"), 256).alias("text_sha256")
    totals = [F.count(F.lit(1)).alias("group_size"), best_row().alias("best")]
    groups = stage(rows.groupBy("h1", "h2").agg(*totals), "exact-groups")
    collided = collided_hashes(rows, groups)
    own = F.lit("")
    if not collided.isEmpty():
        rows = rows.join(collided, ["h1", "h2"], "left")
        own = F.when(F.col("collided"), F.col("plain")).otherwise(F.lit(""))
        groups = stage(rows.withColumn("own", own).groupBy("h1", "h2", "own").agg(*totals), "exact-groups")
    else:
        groups = groups.withColumn("own", F.lit(""))
    named = rows.select("id", "length", "h1", "h2", own.alias("own"), digest)
    # a hash that one row has needs no partner: only shared ones are joined
    shared = groups.filter("group_size > 1").select("h1", "h2", "own", "group_size", "best")
    placed = named.join(shared, ["h1", "h2", "own"], "left")
    alone = F.col("best").isNull()
    return placed.select(
        "id", "length", "h1", "h2", "own",
        F.when(alone, F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("length") == -F.col("best.less")))).alias("kept"),
        "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of=content_hash) -> DataFrame:
    """One row of ``docs`` for each group of equal texts, all its columns.

    The staying rows are found by id, length and hash; rows that repeat all
    three inside a group count once.
    """
    found = exact_groups(docs, id_col, text_col, hash_of).filter("kept").select("id", "length", "h1", "h2", "own").distinct()
    found = stage(found, "exact-kept")
    plain = normalised(F.col(text_col))
    keyed = docs.withColumn("_k", F.struct(F.col(id_col).alias("id"),
                                           F.char_length(F.coalesce(text_col, F.lit(""))).cast("long").alias("length"),
                                           hash_of(plain).alias("h"), plain.alias("plain")))
    names = found.select(F.col("id").alias("_id"), F.col("length").alias("_length"), F.col("h1").alias("_h1"),
                         F.col("h2").alias("_h2"), F.col("own").alias("_own"))
    k = F.col("_k")
    met = keyed.join(names, k["id"].eqNullSafe(F.col("_id")) & (k["length"] == F.col("_length"))
                     & (k["h"]["h1"] == F.col("_h1")) & (k["h"]["h2"] == F.col("_h2"))
                     & ((F.col("_own") == "") | (F.col("_own") == k["plain"])))
    return met.dropDuplicates(["_h1", "_h2", "_own"]).select(*[docs[c] for c in docs.columns])
