"""Reading a table as it was.

Rows carry ``_version``, ``_commit_ts`` and ``_op``. A *keyed* table keeps what each load
wrote, and its state at version *n* is the latest row per key up to *n*, without the
deleted keys. A *snapshot* table keeps whole states, and its state at *n* is the rows of
the greatest version up to *n*.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratalith.operators.dedup import latest_per_key
from stratalith.operators.joins import only_keys_of

VERSION_COLUMNS = ("_version", "_commit_ts", "_op")
WROTE, DELETED = "WRITE", "DELETE"


def stamp(df: DataFrame, version: int, commit_ts: Column, op: str = WROTE) -> DataFrame:
    """Mark the rows of one load."""
    return df.withColumns(
        {"_version": F.lit(version).cast("int"), "_commit_ts": commit_ts, "_op": F.lit(op)}
    )


def unstamp(df: DataFrame) -> DataFrame:
    return df.drop(*VERSION_COLUMNS)


def _resolved(commits: DataFrame, reached: Column, asked: str) -> Column:
    """The version to read, as a one-value subquery that fails the job if none is kept."""
    told = F.lit(f"no version {asked} is kept")
    return commits.agg(
        F.coalesce(F.max(F.when(reached, F.col("_version"))), F.raise_error(told).cast("int"))
    ).scalar()


def version_at(rows: DataFrame, number: int) -> Column:
    """Version ``number``; an error if it is older than what is kept, or does not exist yet."""
    top = F.max("_version")
    low = F.max(F.when(F.col("_version") <= number, F.col("_version")))
    told = F.lit(f"version {number} is not kept")
    return rows.agg(F.when(top < number, F.raise_error(told).cast("int")).otherwise(
        F.coalesce(low, F.raise_error(told).cast("int"))
    )).scalar()


def version_when(rows: DataFrame, ts: Column) -> Column:
    """The last version committed at or before ``ts``; an error if none is kept."""
    return _resolved(rows, F.col("_commit_ts") <= ts, "that old")


def keyed_state(rows: DataFrame, keys: str | Sequence[str], version: Column | None = None) -> DataFrame:
    """State of a keyed table, now or at ``version``."""
    seen = rows if version is None else rows.filter(F.col("_version") <= version)
    return unstamp(latest_per_key(seen, keys, ["_version"]).filter(F.col("_op") != DELETED))


def snapshot_state(rows: DataFrame, version: Column | None = None) -> DataFrame:
    """State of a snapshot table, now or at ``version``."""
    at = rows.agg(F.max("_version")).scalar() if version is None else version
    return unstamp(rows.filter(F.col("_version") == at))


def keyed_state_touching(
    rows: DataFrame, key: str, parents: DataFrame, parent_key: str
) -> DataFrame:
    """Current rows of a keyed table that belong to ``parents``, without ranking the rest.

    A row that once belonged to a parent may since have moved away, so every version of a
    touched key is ranked before the parent test is applied to the survivor.
    """
    touched = only_keys_of(rows, parents, parent_key).select(key).distinct()
    return only_keys_of(keyed_state(only_keys_of(rows, touched, key), key), parents, parent_key)


def changed_keys(rows: DataFrame, keys: str, seen: int | None) -> DataFrame:
    """Keys that a version above ``seen`` wrote or deleted, each once; all keys if nothing was seen yet."""
    new = rows if seen is None else rows.filter(F.col("_version") > seen)
    return new.select(keys).dropna().distinct()


def state_of_keys(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Current state of the ``wanted`` keys only: the filter comes before the rank, so nothing else is moved for it."""
    return keyed_state(only_keys_of(rows, wanted, key), key)


def history(rows: DataFrame) -> DataFrame:
    """One row per kept version: when it was committed and how many rows it wrote."""
    return rows.groupBy("_version").agg(
        F.min("_commit_ts").alias("commit_ts"),
        F.count_if(F.col("_op") == WROTE).alias("rows_written"),
        F.count_if(F.col("_op") == DELETED).alias("rows_deleted"),
    ).withColumnRenamed("_version", "version")


def _horizon(rows: DataFrame, cutoff: Column) -> tuple[Column, Column]:
    past = rows.filter(F.col("_commit_ts") <= cutoff)
    return past.agg(F.max("_version")).scalar(), past.agg(F.max("_commit_ts")).scalar()


def expire_keyed(rows: DataFrame, keys: str | Sequence[str], cutoff: Column) -> DataFrame:
    """Drop the rows that were superseded by the time of ``cutoff``.

    What stands at the cutoff becomes one base version carrying the number and time of the
    last version up to it; later versions stay. Older versions can no longer be asked for.
    """
    version, ts = _horizon(rows, cutoff)
    base = latest_per_key(rows.filter(F.col("_commit_ts") <= cutoff), keys, ["_version"])
    base = base.filter(F.col("_op") != DELETED).withColumns({"_version": version, "_commit_ts": ts})
    return base.unionByName(rows.filter(F.col("_commit_ts") > cutoff))


def expire_snapshots(rows: DataFrame, cutoff: Column) -> DataFrame:
    """Drop the snapshots that were replaced by the time of ``cutoff``."""
    version, _ = _horizon(rows, cutoff)
    return rows.filter(F.col("_version") >= F.coalesce(version, F.lit(0)))
