"""Versions of a keyed table as validity intervals.

A version row carries ``_version``, ``_commit_ts`` and ``_op`` (see ``operators.versions``); here it also has ``_to`` and
``_to_ts``, the version and time at which its key was written or deleted next. The state at version ``n`` is then the rows
with ``_version <= n < _to``: a filter on two columns, which the statistics of sorted files answer for most of
them, in place of a ranking of all versions at every reading.

A key may have one row per version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stratalith.operators.joins import names_of
from stratalith.operators.layout import cluster_by
from stratalith.operators.versions import DELETED, VERSION_COLUMNS

INTERVAL_COLUMNS = ("_to", "_to_ts")
# The end of rows that nothing has replaced yet: ordinary values, so that one comparison tells it all.
OPEN = 2**31 - 1
OPEN_TS = "9999-12-31 00:00:00"


def _open_ts(rows: DataFrame) -> Column:
    return F.lit(OPEN_TS).cast(rows.schema["_commit_ts"].dataType)


def with_intervals(rows: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """All version rows with the end of their validity: one ranking, when the versions are written."""
    following = Window.partitionBy(*names_of(keys)).orderBy("_version")
    return rows.withColumns({
        "_to": F.coalesce(F.lead("_version").over(following), F.lit(OPEN)).cast("int"),
        "_to_ts": F.coalesce(F.lead("_commit_ts").over(following), _open_ts(rows)),
    })


def extend(still_open: DataFrame, batch: DataFrame, keys: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(rows that the batch closes, rows that are open now)`` from the open rows and the rows of one new version.

    Closed rows never change again, so a load adds the first part to them and replaces the open ones by the second. A
    row that deletes its key is open until the key is written again. Nothing is ranked: the batch has a key once.
    """
    names = names_of(keys)
    new = batch.withColumns({"_to": F.lit(OPEN), "_to_ts": _open_ts(batch)}).select(*still_open.columns)
    ends = batch.select(*names, F.col("_version").alias("_next"), F.col("_commit_ts").alias("_next_ts"))
    closed = still_open.join(ends, names, "inner").withColumns({"_to": F.col("_next"), "_to_ts": F.col("_next_ts")})
    kept = still_open.join(ends.select(*names), names, "left_anti").select(*still_open.columns)
    return closed.select(*still_open.columns), kept.unionByName(new)


def placed(intervals: DataFrame, files: int) -> DataFrame:
    """Rows over ``files`` files along a curve of beginning and end: files whose rows all ended before a version, or began after it, are not read for it."""
    return cluster_by(intervals, ["_version", "_to"], files=files)


def commits_of(rows: DataFrame) -> DataFrame:
    """The small table of versions and their times, which is kept beside the rows."""
    return rows.groupBy("_version").agg(F.min("_commit_ts").alias("_commit_ts"))


def version_number(commits: DataFrame, number: int) -> int:
    """The greatest kept version up to ``number``; an error if it is older than what is kept, or does not exist yet."""
    row = commits.agg(F.max("_version").alias("top"), F.max(F.when(F.col("_version") <= number, F.col("_version"))).alias("low")).first()
    if row["low"] is None or row["top"] < number:
        raise LookupError(f"version {number} is not kept")
    return row["low"]


def version_number_at(commits: DataFrame, ts: Column) -> int:
    """The last version committed at or before ``ts``; an error if none is kept."""
    found = commits.agg(F.max(F.when(F.col("_commit_ts") <= ts, F.col("_version")))).first()[0]
    if found is None:
        raise LookupError("no version that old is kept")
    return found


def as_of(intervals: DataFrame, number: int) -> DataFrame:
    """The state at a version: a range filter and nothing else. See :func:`version_number` for the number."""
    valid = (F.col("_version") <= number) & (F.col("_to") > number) & (F.col("_op") != DELETED)
    return intervals.filter(valid).drop(*VERSION_COLUMNS, *INTERVAL_COLUMNS)


def expire(intervals: DataFrame, commits: DataFrame, cutoff: Column) -> DataFrame:
    """Drop the rows that were superseded by the time of ``cutoff``.

    What stands at the cutoff begins with the last version up to it from now on, whose number and time it gets;
    keys that were deleted by then are gone. Later versions stay. Without a version up to the cutoff nothing changes.
    """
    base = commits.filter(F.col("_commit_ts") <= cutoff).agg(F.max("_version").alias("v"), F.max("_commit_ts").alias("t")).first()
    if base["v"] is None:
        return intervals
    old = F.col("_version") <= base["v"]
    kept = intervals.filter((F.col("_to") > base["v"]) & ~(old & (F.col("_op") == DELETED)))
    began = F.lit(base["t"]).cast(intervals.schema["_commit_ts"].dataType)
    return kept.withColumns({
        "_version": F.when(old, F.lit(base["v"])).otherwise(F.col("_version")).cast(T.IntegerType()),
        "_commit_ts": F.when(old, began).otherwise(F.col("_commit_ts")),
    })
