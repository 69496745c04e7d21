"""Points-per-hour from an ISO-8601 duration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_RESOLUTION = "PT60M"
# Fixed table of the incremental loader: resolution -> points per hour.
FIXED_FACTORS = {"PT60M": 1, "PT30M": 2, "PT15M": 4}


def _minutes(res: Column) -> Column:
    digits = F.regexp_extract(res, r"^PT([0-9]+)M$", 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def points_per_hour(res: Column, strict: bool = False) -> Column:
    """Points per hour; NULL means the period cannot be aggregated.

    General rule (``strict=False``): ``PT<n>M`` gives ``60 div n``; any
    other shape is assumed hourly (1).  ``PT0M`` and resolutions over an
    hour give NULL (division by zero / a block that never fills).
    ``strict=True`` is the fixed table (PT60M/PT30M/PT15M, else NULL).
    """
    res = F.coalesce(res, F.lit(DEFAULT_RESOLUTION))
    if strict:
        expr = F.lit(None).cast("int")
        for key, val in FIXED_FACTORS.items():
            expr = F.when(res == key, F.lit(val)).otherwise(expr)
        return expr
    shaped = res.startswith("PT") & res.endswith("M")
    minutes = _minutes(res)
    return (F.when(~shaped, F.lit(1))
            .when(minutes.isNull() | (minutes == 0) | (minutes > 60), F.lit(None))
            .otherwise((F.lit(60) / minutes).cast("int")))


def resolution_reason(res: Column) -> Column:
    """Why a resolution is rejected (NULL when usable)."""
    res = F.coalesce(res, F.lit(DEFAULT_RESOLUTION))
    shaped = res.startswith("PT") & res.endswith("M")
    minutes = _minutes(res)
    return (F.when(~shaped, F.lit(None))
            .when(minutes.isNull(), F.lit("unparsable_resolution"))
            .when(minutes == 0, F.lit("zero_resolution"))
            .when(minutes > 60, F.lit("resolution_over_one_hour")))
