"""Data-quality checks (N1, N2, N4, uniqueness) and the publish gate.

Each check is a single aggregation pass over the table (partial counts
per task, one tiny final row), returned as rows
``table, column, check, failures`` so that results of many tables can be
unioned, stored and asserted on before anything is published.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake import dims


def _unpivot(counts: DataFrame, table: str, check: str, columns: list[str]) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) as (column, failures)").select(
        F.lit(table).alias("table"), "column", F.lit(check).alias("check"),
        F.col("failures").cast("long").alias("failures"))


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows where the column is NULL, per column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unpivot(counts, table, "not_null", columns)


def accepted_values(df: DataFrame, table: str, column: str,
                    values: list[str] | None = None) -> DataFrame:
    """Non-NULL values outside the list (default: the reference list)."""
    allowed = values if values is not None else dims.ACCEPTED_COUNTRIES
    bad = F.col(column).isNotNull() & ~F.col(column).isin(allowed)
    counts = df.agg(F.count_if(bad).alias(column))
    return _unpivot(counts, table, "accepted_values", [column])


def rejected_values(df: DataFrame, column: str, values: list[str] | None = None) -> DataFrame:
    """N2 detail: each rejected value with its row count."""
    allowed = values if values is not None else dims.ACCEPTED_COUNTRIES
    return (df.where(F.col(column).isNotNull() & ~F.col(column).isin(allowed))
            .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("failures")))


def unique_key(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Keys that occur more than once (duplicates multiply in the join)."""
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    counts = dup.agg(F.count(F.lit(1)).alias("|".join(key)))
    return _unpivot(counts, table, "unique", ["|".join(key)])


def partition_ready(df: DataFrame, time_col: str = "time", expected_hours: int = 24,
                    by: list[str] | None = None) -> DataFrame:
    """Rows and distinct hours per date (and per ``by``); complete flag.

    Hours are bits of one integer, so distinct ones are counted in a single
    aggregation with map-side combine.
    """
    keys = list(by or []) + [F.to_date(time_col).alias("event_date")]
    hours = F.coalesce(F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(time_col)))), F.lit(0)).cast("long")
    return (df.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("rows"), hours.alias("hours"))
            .withColumn("complete", F.col("hours") >= expected_hours))


def table_checks(df: DataFrame, table: str, not_null_cols: list[str],
                 accepted_col: str | None = None, accepted: list[str] | None = None) -> DataFrame:
    """All checks of one table in a single aggregation pass."""
    exprs = [F.count_if(F.col(c).isNull()).alias(f"nn_{i}") for i, c in enumerate(not_null_cols)]
    if accepted_col:
        allowed = accepted if accepted is not None else dims.ACCEPTED_COUNTRIES
        bad = F.col(accepted_col).isNotNull() & ~F.col(accepted_col).isin(allowed)
        exprs.append(F.count_if(bad).alias("av"))
    counts = df.agg(*exprs)
    checks = [(c, "not_null", f"nn_{i}") for i, c in enumerate(not_null_cols)]
    if accepted_col:
        checks.append((accepted_col, "accepted_values", "av"))
    rows = ", ".join(f"'{c}', '{k}', `{a}`" for c, k, a in checks)
    return counts.selectExpr(f"stack({len(checks)}, {rows}) as (column, check, failures)").select(
        F.lit(table).alias("table"), "column", "check", F.col("failures").cast("long").alias("failures"))


def run_checks(tables: dict[str, tuple[DataFrame, list[str]]],
               countries: dict[str, str] | None = None,
               accepted: list[str] | None = None) -> DataFrame:
    """Every check of every table; one scan per table."""
    countries = countries or {}
    parts = [table_checks(df, name, cols, countries.get(name), accepted)
             for name, (df, cols) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


class QualityGateError(RuntimeError):
    pass


def assert_passed(results: DataFrame) -> None:
    """Raise before publishing when any check failed (Q12)."""
    failed = results.where(F.col("failures") > 0).collect()      # at most one row per declared check
    if failed:
        lines = ", ".join(f"{r['table']}.{r['column']} {r['check']}={r['failures']}" for r in failed)
        raise QualityGateError(f"data tests failed: {lines}")
