"""Plain Parquet folders: intermediates in the shared folder, and tables of which only some partitions are replaced."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from stratalith.operators.layout import by_partition

# Fixed value: the folder name of a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session that names none gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = "file://" + tempfile.mkdtemp(prefix="stratalith-")
    return _local_folders[app]


def _hadoop(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    files, there = _hadoop(spark, path)
    files.mkdirs(there)
    files.deleteOnExit(there)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, wherever it is kept; one that is not there is no error."""
    files, there = _hadoop(spark, path)
    files.delete(there, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a result that is read more than once and read it back, so a lost executor costs no recomputation."""
    path = new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_any(spark: SparkSession, path: str, merge: bool = True) -> DataFrame | None:
    """A folder of Parquet files, whose columns are merged; None where there is no folder, or no file in it yet."""
    try:
        return spark.read.option("mergeSchema", merge).parquet(path)
    except AnalysisException as e:
        # A folder without files is told in one of two ways, by the kind of its listing.
        if e.getCondition() == "PATH_NOT_FOUND" or "infer schema" in str(e):
            return None
        raise


def overwrite_partitions(df: DataFrame, path: str, cols: Sequence[str], observe: Mapping[str, Column] | None = None) -> dict:
    """Write ``df`` into a partitioned folder; only partitions that it has rows for are replaced.

    The new files are moved in when the job commits, so a job that fails leaves the folder as it was. Large
    partition values are split over several files and small ones share a task. Gives the ``observe`` aggregates of the rows.
    """
    placed = by_partition(df, cols)
    seen = Observation()
    if observe:
        placed = placed.observe(seen, *[c.alias(name) for name, c in observe.items()])
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)
    return seen.get if observe else {}


def partition_numbers(spark: SparkSession, path: str, column: str) -> list[int]:
    """The values of an integer partition column, from the names of the folders."""
    files, there = _hadoop(spark, path)
    names = [str(f.getPath().getName()) for f in files.listStatus(there)] if files.exists(there) else []
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{column}="))


def partition_path(path: str, values: Mapping[str, object]) -> str:
    """The folder of one partition of integer values."""
    return "/".join([path, *[f"{c}={NULL_PARTITION if v is None else int(v)}" for c, v in values.items()]])
