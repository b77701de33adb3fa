"""The two control tables: stored marks and the run log."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stratalith.functions.columns import mark_literal, mark_micros
from stratalith.operators.constraints import STATUSES, allowed_values, enforce
from stratalith.operators.incremental import first_mark
from stratalith.operators.upsert import insert_missing, merge_columns, update_where


def _column(name: str, kind: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, kind, True, {"comment": comment})


WATERMARK = T.StructType([
    _column("table_name", T.StringType(), "Table whose progress is kept"),
    _column("last_run_ts", T.TimestampType(), "Greatest mark value that was loaded"),
    _column("last_run_id", T.StringType(), "Run that moved the mark last"),
    _column("status", T.StringType(), "One of " + ", ".join(STATUSES)),
    _column("updated_at", T.TimestampType(), "When this row changed"),
])

RUN_LOG = T.StructType([
    _column("run_id", T.StringType(), "The run"),
    _column("layer_name", T.StringType(), "BRONZE, SILVER, GOLD, OPTIMIZE or VACUUM"),
    _column("table_name", T.StringType(), "Table the run wrote"),
    _column("run_status", T.StringType(), "SUCCESS or FAILED"),
    _column("row_count", T.LongType(), "Rows written"),
    _column("message", T.StringType(), "Summary, or the error"),
    _column("run_start_ts", T.TimestampType(), "Start"),
    _column("run_end_ts", T.TimestampType(), "End"),
])


MARK_CHANGES = T.StructType([*WATERMARK.fields, T.StructField("change", T.LongType())])


def new_run_id() -> str:
    return str(uuid.uuid4())


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    nothing = spark.range(0, numPartitions=1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return nothing.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema.fields])


def log_entry(
    spark: SparkSession, run_id: str, layer: str, table: str, status: str, rows: int,
    message: str, start: datetime, end: datetime,
) -> DataFrame:
    values = (run_id, layer, table, status, int(rows), message, start, end)
    return spark.range(1, numPartitions=1).select(
        *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, RUN_LOG.fields, strict=True)]
    )


def names(spark: SparkSession, *tables: str) -> DataFrame:
    """The given table names, one per row."""
    return spark.range(1, numPartitions=1).select(F.explode(F.array(*[F.lit(t) for t in tables])).alias("table_name"))


def seeds(spark: SparkSession, tables: Iterable[str], now: Column | None = None) -> DataFrame:
    """A first row per table: the first mark, no run, status INIT."""
    return names(spark, *tables).select(
        "table_name",
        first_mark().alias("last_run_ts"),
        F.lit(None).cast("string").alias("last_run_id"),
        F.lit("INIT").alias("status"),
        (F.current_timestamp() if now is None else now).alias("updated_at"),
    )


def seed_marks(control: DataFrame, new: DataFrame) -> DataFrame:
    """Add the rows that are missing; may be repeated."""
    return insert_missing(control, new, "table_name")


def mark_running(control: DataFrame, starting: DataFrame, now: Column) -> DataFrame:
    """Set RUNNING for the tables named in ``starting``, adding a first row for a new one."""
    return merge_columns(
        control, starting, "table_name", similar_size=True,
        update={"status": F.lit("RUNNING"), "updated_at": now},
        insert={
            "table_name": "table_name", "last_run_ts": first_mark(),
            "status": F.lit("RUNNING"), "updated_at": now,
        },
    )


def mark_failed(control: DataFrame, table: str, now: Column) -> DataFrame:
    """Set FAILED; the mark stays where the last success left it."""
    return update_where(
        control, F.col("table_name") == table, {"status": F.lit("FAILED"), "updated_at": now}
    )


def mark_success(
    control: DataFrame, new: DataFrame, columns: Sequence[str] = ("last_run_ts", "last_run_id", "status", "updated_at")
) -> DataFrame:
    """Move marks forward. Only ``columns`` of known tables change; a NULL mark keeps the old one."""
    update: dict[str, str | Column] = {c: c for c in columns}
    if "last_run_ts" in update:
        update["last_run_ts"] = F.coalesce(F.col("s.last_run_ts"), F.col("t.last_run_ts"))
    return merge_columns(
        control, new, "table_name", similar_size=True,
        update=update, insert={c: c for c in ("table_name", *columns)},
    )


def checked(control: DataFrame) -> DataFrame:
    return enforce(control, allowed_values("status", STATUSES), "valid_status")


@dataclass(frozen=True)
class ControlTables:
    """Marks and run log as plain Parquet folders, to which rows are only added."""

    spark: SparkSession
    root: str

    @property
    def log_path(self) -> str:
        return f"{self.root}/pipeline_run_log"

    @property
    def mark_path(self) -> str:
        return f"{self.root}/pipeline_watermark"

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return empty(self.spark, schema)
            raise

    def create(self) -> None:
        """Empty tables, so that they can be read before the first run; may be repeated."""
        for schema, path in ((RUN_LOG, self.log_path), (MARK_CHANGES, self.mark_path)):
            empty(self.spark, schema).write.mode("append").parquet(path)

    def run_log(self) -> DataFrame:
        return self._read(self.log_path, RUN_LOG).select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in RUN_LOG.fields])

    def append_log(self, entry: DataFrame) -> None:
        entry.coalesce(1).write.mode("append").parquet(self.log_path)

    def last_message(self, layer: str, table: str) -> str | None:
        """What the last successful run about a table told."""
        done = self.run_log().filter((F.col("run_status") == "SUCCESS") & (F.col("layer_name") == layer.upper()) & (F.col("table_name") == table))
        return done.agg(F.max_by("message", "run_end_ts")).first()[0]

    def marks(self) -> DataFrame:
        """The last state of every mark."""
        found, names = self._read(self.mark_path, MARK_CHANGES), WATERMARK.fieldNames()
        last = found.groupBy("table_name").agg(F.max_by(F.struct(*names), "change").alias("last")).select("last.*")
        return last.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in WATERMARK.fields])

    def change_marks(self, change: Callable[[DataFrame], DataFrame]) -> None:
        """Add the rows that ``change`` of the marks makes different. Loads of different tables add different rows, so none loses the other's."""
        last, before = self._read(self.mark_path, MARK_CHANGES).agg(F.max("change")).first()[0], self.marks()
        state = checked(change(before)).select(*WATERMARK.fieldNames()).exceptAll(before)
        state.withColumn("change", F.lit(0 if last is None else last + 1).cast("long")).coalesce(1).write.mode("append").parquet(self.mark_path)

    def mark(self, name: str) -> Column | None:
        """The stored mark as a literal; None while nothing was loaded."""
        row = self.marks().filter(F.col("table_name") == name).agg(F.max(mark_micros("last_run_ts")).alias("at"), F.max("last_run_id").alias("run")).first()
        return None if row["at"] is None or row["run"] is None else mark_literal(row["at"])

    def view_texts(self) -> dict[str, str]:
        """Both tables as SQL over their files."""
        names = ", ".join(WATERMARK.fieldNames())
        return {
            "pipeline_run_log": f"SELECT {', '.join(RUN_LOG.fieldNames())} FROM parquet.`{self.log_path}`",
            "pipeline_watermark": f"SELECT {names} FROM (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY change DESC) AS _rank FROM parquet.`{self.mark_path}`) WHERE _rank = 1",
        }
