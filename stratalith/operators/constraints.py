"""Checks on rows, keys and table sizes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

STATUSES = ("INIT", "RUNNING", "SUCCESS", "FAILED")


def allowed_values(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isin(*values)


def violations(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows that do not satisfy ``predicate``; an unknown result counts as a violation."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def enforce(df: DataFrame, predicate: Column, name: str) -> DataFrame:
    """The same rows, but the job that reads them fails at the first violation.

    The test runs inside the job, so it needs no pass of its own before a write.
    """
    broken = ~F.coalesce(predicate, F.lit(False))
    told = F.concat(F.lit(f"check {name} violated by "), F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    return df.filter(F.when(broken, F.raise_error(told).cast("boolean")).otherwise(True))


def repeated_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    names = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One ``(table_name, cnt)`` row per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
        for name, df in tables.items()
    ]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out
