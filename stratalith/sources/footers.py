"""Counts and bounds of stored tables from the footers of their Parquet files.

The footers hold the number of rows, and for every column its least and greatest value and its NULLs. Spark's second
reader of Parquet answers such aggregates from them alone. It is switched on in a session beside the caller's, whose own reads stay
as they are. It finds a column by its place, so all files of a table must have the same columns in the same order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
# Types whose bounds Parquet keeps in an order that Spark takes over.
_BOUNDED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)
_sessions: dict[str, SparkSession] = {}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that answers counts, minima and maxima from footers."""
    app = spark.sparkContext.applicationId
    if app not in _sessions:
        other = spark.newSession()
        for key, value in {"spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"), **_SETTINGS}.items():
            other.conf.set(key, value)
        _sessions[app] = other
    return _sessions[app]


def row_counts(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``(table_name, cnt)`` of each table, given by its path; no row is read."""
    session, out = footer_session(spark), None
    for name, path in tables.items():
        one = session.read.parquet(path).agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table_name"), "cnt")
        out = one if out is None else out.unionByName(one)
    return out


def bounded_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns of a table whose bounds its footers tell: whole numbers and dates."""
    return [f.name for f in footer_session(spark).read.parquet(path).schema.fields if isinstance(f.dataType, _BOUNDED)]


def column_bounds(spark: SparkSession, path: str, cols: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """``(column_name, low, high, known)`` of the columns that footers can tell, as numbers; ``known`` counts values that are not NULL.

    ``where`` may choose partitions, no other rows. A date is its days since 1970. All columns are answered by one pass over the footers. A
    file that holds nothing but NULLs in a column has no bounds for it and fails the job; ``where`` can leave its partition out.
    """
    session = footer_session(spark)
    cols = bounded_columns(spark, path) if cols is None else list(cols)
    if not cols:
        return session.createDataFrame([], "column_name string, low long, high long, known long")
    table = session.read.parquet(path)
    table = table if where is None else table.filter(where)
    dates = {f.name for f in table.schema.fields if isinstance(f.dataType, T.DateType)}
    found = table.agg(*[made(c).alias(f"{name} {c}") for c in cols for name, made in (("low", F.min), ("high", F.max), ("known", F.count))])

    def number(name: str, column: str):
        value = F.col(f"`{name} {column}`")
        return (F.unix_date(value) if name != "known" and column in dates else value).cast("long").alias(name)

    told = F.array(*[F.struct(F.lit(c).alias("column_name"), *[number(n, c) for n in ("low", "high", "known")]) for c in cols])
    return found.select(F.explode(told).alias("told")).select("told.*")
