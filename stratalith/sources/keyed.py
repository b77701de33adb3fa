"""Keyed tables: the current rows in buckets by key, and beside them the rows that were replaced.

    <path>/open/v=<n>       a catalog table of the rows that hold now, bucketed and sorted by key
    <path>/closed/_to=<n>   the rows that version n replaced
    <path>/commits          one row per version: number, time and rows written

A load writes the rows it closes, the new open table and its commit, each in a place of its own that a repeated attempt
overwrites, and then gives the new table the name of the old one. All of it is plain partitioned and bucketed writing; the state at any
version is a range filter over both folders, see ``operators.intervals``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratalith.operators import intervals, versions
from stratalith.sources import bucketed
from stratalith.sources.files import read_if_any, remove, stored


class MissingTable(LookupError):
    """The table has no rows yet."""


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    name: str
    path: str
    key: str
    buckets: int

    @property
    def _next(self) -> str:
        return f"{self.name}__next"

    def exists(self) -> bool:
        """Finishes a change of names that was cut off."""
        there = self.spark.catalog.tableExists(self.name)
        if not there and self.spark.catalog.tableExists(self._next) and self._property(self._next) is not None:
            self.spark.sql(f"ALTER TABLE {self._next} RENAME TO {self.name}")
            return True
        return there

    def _property(self, table: str) -> int | None:
        found = self.spark.sql(f"SHOW TBLPROPERTIES {table}").filter("key = 'version'").first()
        return None if found is None else int(found["value"])

    def version(self) -> int:
        """The number of the current version; -1 before the first."""
        return self._property(self.name) if self.exists() else -1

    def rows(self) -> DataFrame:
        """The current rows, with the version that wrote each."""
        if not self.exists():
            raise MissingTable(f"{self.name} has no rows yet")
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def current(self) -> DataFrame:
        return versions.unstamp(self.rows().filter(F.col("_op") != versions.DELETED))

    def closed(self) -> DataFrame:
        """The rows that were replaced, with the version and time at which they were; what a load that was cut off closed is left out."""
        like, reached = self.rows(), self.version()
        found = read_if_any(self.spark, f"{self.path}/closed")
        if found is None:
            return like.limit(0).withColumns({"_to": F.lit(0), "_to_ts": F.col("_commit_ts")})
        held = set(found.columns)
        lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields if f.name not in held]
        return found.filter(F.col("_to") <= reached).select("*", *lacking).select(*like.columns, "_to", "_to_ts")

    def all_rows(self) -> DataFrame:
        """Every kept version of every row as an interval; see ``operators.intervals``."""
        still = self.rows().withColumns({"_to": F.lit(intervals.OPEN), "_to_ts": F.lit(intervals.OPEN_TS).cast("timestamp")})
        return still.unionByName(self.closed())

    def changed_since(self, version: int | None) -> DataFrame:
        """Rows that came after a version, and those that went: old and new state of every key that changed. All current rows for None."""
        if version is None:
            return versions.unstamp(self.rows())
        new = self.rows().filter(F.col("_version") > version)
        old = self.closed().filter(F.col("_to") > version).drop(*intervals.INTERVAL_COLUMNS)
        return versions.unstamp(new.unionByName(old))

    def commits(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/commits").filter(F.col("_version") <= self.version())

    def as_of_version(self, number: int) -> DataFrame:
        return intervals.as_of(self.all_rows(), intervals.version_number(self.commits(), number))

    def as_of_timestamp(self, ts: Column) -> DataFrame:
        return intervals.as_of(self.all_rows(), intervals.version_number_at(self.commits(), ts))

    def history(self) -> DataFrame:
        """One row per kept version: when it was committed and how many rows it wrote."""
        return self.commits().select(F.col("_version").alias("version"), F.col("_commit_ts").alias("commit_ts"), "rows_written")

    def upsert(self, batch: DataFrame) -> int:
        """Replace the rows of the batch's keys and add the new ones, as the next version; gives the rows written.

        The batch has a key once. Columns that only one side has are NULL on the other. Only the batch is moved. An empty batch makes no version.
        """
        number, now = self.version() + 1, F.lit(datetime.now(timezone.utc))
        batch = stored(versions.stamp(batch, number, now), "batch")
        written = batch.count()
        if written == 0:
            return 0
        made = batch
        if number > 0:
            target = _aligned(self.rows(), batch)
            batch = _aligned(batch, target).select(*target.columns)
            ended = target.join(batch.select(self.key), self.key, "left_semi").withColumns({"_to": F.lit(number), "_to_ts": now})
            ended.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_to").parquet(f"{self.path}/closed")
            made = bucketed.upsert_bucketed(target, batch, self.key, self.buckets)
        commit = self.spark.range(1).select(F.lit(number).alias("_version"), now.alias("_commit_ts"), F.lit(written).cast("long").alias("rows_written"))
        commit.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_version").parquet(f"{self.path}/commits")
        self._replace(made, number)
        return written

    def _replace(self, made: DataFrame, number: int) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._next}")
        write = bucketed.write_bucketed if number == 0 else bucketed.write_dealt
        write(made, self._next, self.key, self.buckets, f"{self.path}/open/v={number}")
        self.spark.sql(f"ALTER TABLE {self._next} SET TBLPROPERTIES ('version' = '{number}')")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(f"ALTER TABLE {self._next} RENAME TO {self.name}")
        remove(self.spark, f"{self.path}/open/v={number - 1}")

    def expire(self, cutoff: Column) -> int:
        """Drop what was replaced by the time of ``cutoff``; gives the number of versions that can no longer be read.

        Whole folders go, no row is read: those closed by a version up to the last one of that time.
        """
        commits = self.commits()
        base = commits.agg(F.max(F.when(F.col("_commit_ts") <= cutoff, F.col("_version")))).first()[0]
        old = [] if base is None else [r["_version"] for r in commits.filter(F.col("_version") <= base).collect()]
        for number in old:
            remove(self.spark, f"{self.path}/closed/_to={number}")
            if number < base:
                remove(self.spark, f"{self.path}/commits/_version={number}")
        return len(old) - 1 if old else 0


def _aligned(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with the columns that only ``other`` has, as NULL."""
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields if f.name not in df.columns])
