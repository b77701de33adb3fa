"""Reading delivered CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratalith.spec import TableSpec

SOURCE_FILE = "source_file_name"
DAMAGED = "damaged_line"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read CSV with a header. Types come from ``schema``; only without one are they inferred,
    which costs a pass over the files."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_by_header(spark: SparkSession, path: str, spec: TableSpec, reserved: Sequence[str] = (), watch: bool = False) -> DataFrame:
    """A delivery as text, bound by the names in its header, with the file each row came from.

    Columns the spec does not list are kept (renamed where their name is ``reserved``), listed ones that
    are absent are NULL; without the key or the mark column the delivery is refused. Every file is
    checked against the header of the first, so a file with another order fails instead of being misread.
    A line with too many or too few fields, or with a quote that is not closed, is kept whole in DAMAGED; what could be read of it
    is in its columns. In whole lines DAMAGED is NULL. With ``watch`` the rows are a stream of the files that come to the folder.
    """
    header = spark.read.option("header", True).csv(path).columns
    lacking = [c for c in (spec.key, spec.watermark_col) if c not in header]
    if lacking:
        raise ValueError(f"{path} has no column {', '.join(lacking)}")
    if DAMAGED in header:
        raise ValueError(f"{path} may not have a column {DAMAGED}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, DAMAGED]])
    reader = (spark.readStream if watch else spark.read).schema(schema).option("header", True).option("enforceSchema", False)
    found = with_source_file(reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", DAMAGED).csv(path))
    extra = [c for c in header if c not in spec.columns]
    return found.select(
        *[F.col(c) if c in header else F.lit(None).cast("string").alias(c) for c in spec.columns],
        *[F.col(f"`{c}`").alias(f"delivered_{c}" if c in reserved else c) for c in extra],
        DAMAGED, SOURCE_FILE,
    )


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the file each row came from; must sit directly on a file scan."""
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
