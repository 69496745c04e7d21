"""Deduplication on a business key.

The survivor is chosen deterministically: the copy with the greatest
``prefer`` values wins, remaining ties are broken by the whole row.  This
is a plain aggregation, so copies are already collapsed map-side before
the shuffle; a key repeated millions of times never reaches one task whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_one(df: DataFrame, key: list[str], prefer: list[Column | str] | None = None) -> DataFrame:
    others = [c for c in df.columns if c not in key]
    prefer_cols = [F.col(p) if isinstance(p, str) else p for p in (prefer or [])]
    ranked = F.struct(*[p.alias(f"_p{i}") for i, p in enumerate(prefer_cols)],
                      F.struct(*others).alias("_row"))
    return (df.groupBy(*key).agg(F.max(ranked).alias("_best"))
            .select(*key, *[F.col(f"_best._row.{c}").alias(c) for c in others])
            .select(*df.columns))
