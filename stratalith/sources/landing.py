"""Deliveries into a watched folder, each file of which is taken once.

Spark's file source keeps in its checkpoint which files were handed out, and its file sink which of them were written, so a run that fails is
continued with the same files and none is lost or written twice. No list of files is kept beside it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def is_folder(spark: SparkSession, path: str) -> bool:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(there) and files.getFileStatus(there).isDirectory()


def append_new_files(rows: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str], observe: Mapping[str, Column]) -> list[dict]:
    """Write what a stream of new files has now to a folder of Parquet files, and stop; gives the ``observe`` aggregates of each part."""
    watched = rows.observe("taken", *[c.alias(n) for n, c in observe.items()])
    query = (
        watched.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    told = [p.observedMetrics.get("taken") for p in query.recentProgress]
    return [r.asDict() for r in told if r is not None]
