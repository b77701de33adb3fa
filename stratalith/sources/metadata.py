"""Namespaces and tables of the session catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def create_namespace(spark: SparkSession, name: str, comment: str) -> None:
    told = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}` COMMENT '{told}'")


def namespaces(spark: SparkSession, among: Sequence[str]) -> DataFrame:
    found = [(d.name,) for d in spark.catalog.listDatabases() if d.name in set(among)]
    return spark.createDataFrame(found, "object_name string")


def tables(spark: SparkSession, namespace: str, among: Sequence[str]) -> DataFrame:
    found = [(t.name,) for t in spark.catalog.listTables(namespace) if t.name in set(among)]
    return spark.createDataFrame(found, "object_name string")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make DataFrames readable by name in ``spark.sql``."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def create_view(spark: SparkSession, namespace: str, name: str, text: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW `{namespace}`.`{name}` AS {text}")


def setup_check(
    spark: SparkSession, schemas: Sequence[str], control_schema: str, control_tables: Sequence[str], marks: DataFrame
) -> DataFrame:
    """What the setup left behind: schemas, control tables and the seeded marks."""
    found = (
        namespaces(spark, schemas).select(F.lit("SCHEMAS").alias("check_type"), "object_name", F.lit("EXISTS").alias("status"))
        .unionByName(
            tables(spark, control_schema, control_tables)
            .select(F.lit("TABLE").alias("check_type"), "object_name", F.lit("EXISTS").alias("status"))
        )
        .unionByName(
            marks.select(F.lit("WATERMARK_SEED").alias("check_type"), F.col("table_name").alias("object_name"), "status")
        )
    )
    return found.orderBy("check_type", "object_name")
