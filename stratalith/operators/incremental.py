"""Reading only what is newer than a stored high-water mark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

FIRST_MARK = "1900-01-01 00:00:00"


def first_mark() -> Column:
    return F.lit(FIRST_MARK).cast("timestamp")


def newer_than(df: DataFrame, column: str, mark: Column | None) -> DataFrame:
    """Rows strictly above the mark; all rows when there is none."""
    return df if mark is None else df.filter(F.col(column) > mark)


def unmarked(df: DataFrame, column: str) -> DataFrame:
    """Rows no mark can ever select, because their mark column is NULL."""
    return df.filter(F.col(column).isNull())


def changed_since(
    df: DataFrame, mark: Column | None, columns: Sequence[str] = ("updated_at", "created_at")
) -> DataFrame:
    """Rows where any of ``columns`` is above the mark."""
    if mark is None:
        return df
    test = F.lit(False)
    for c in columns:
        test = test | (F.col(c) > mark)
    return df.filter(test)


def next_mark(
    df: DataFrame,
    columns: Sequence[str],
    previous: Column | None = None,
    by: Sequence[str] = (),
    name: str = "next_mark",
) -> DataFrame:
    """Greatest value over ``columns``; the previous mark for an empty or all-NULL batch."""
    tops = [F.max(c) for c in columns]
    top = F.greatest(*tops) if len(tops) > 1 else tops[0]
    value = top if previous is None else F.coalesce(top, previous)
    return df.groupBy(*by).agg(value.alias(name)) if by else df.agg(value.alias(name))


def stored_mark(control: DataFrame, table_name: str) -> DataFrame:
    """The stored mark of one table, whatever its status; the first mark if it has none.

    Only a finished load moves the mark, so it is also right while a load runs and after
    one has failed.
    """
    return control.filter(F.col("table_name") == table_name).agg(
        F.coalesce(F.max("last_run_ts"), first_mark()).alias("last_run_ts")
    )
