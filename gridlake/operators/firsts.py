"""First row per group.

``min_by`` over a struct is an ordinary aggregate: each task keeps only
its own best candidate per group before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, group: list[str], order: list[str],
                    columns: list[str] | None = None) -> DataFrame:
    """The row with the smallest ``order`` values in each group."""
    cols = columns or [c for c in df.columns if c not in group]
    best = F.min_by(F.struct(*cols), F.struct(*order)).alias("_first")
    return df.groupBy(*group).agg(best).select(*group, *[F.col(f"_first.{c}").alias(c) for c in cols])


def per_date_first(df: DataFrame, time_col: str, order: list[str],
                   columns: list[str]) -> DataFrame:
    """F8/H2: per event date, the record count and the first record."""
    best = F.min_by(F.struct(*columns), F.struct(*order)).alias("_first")
    return (df.groupBy(F.to_date(time_col).alias("event_date"))
            .agg(F.count(F.lit(1)).alias("records"), best)
            .select("event_date", "records", *[F.col(f"_first.{c}").alias(f"first_{c}") for c in columns]))


def resolve_entities(names: DataFrame, candidates: DataFrame, name_col: str = "query",
                     rank_col: str = "rank") -> DataFrame:
    """The top-ranked candidate of every queried name supplies the
    canonical name and coordinates (``city_name, latitude, longitude``).

    The candidates are reduced to one row per name first (an aggregation),
    so the join is 1:1 and a name with many candidates never lands whole in
    one task.
    """
    top = first_per_group(candidates, [name_col], [rank_col],
                          [c for c in candidates.columns if c not in (name_col, rank_col)])
    return names.join(top, name_col, "left")
