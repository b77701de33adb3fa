"""Tables bucketed by their key, so that a merge moves the batch only.

Target and batch are dealt by the same hash into the same number of buckets. The target is read bucket by bucket as
it lies in its files, the batch is shuffled to it, and the result of the join is dealt like the target: written
again it needs no shuffle either and has one sorted file per bucket.

Rows without a key share one bucket, so they belong into a table of rejects; a few do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalith.operators.upsert import source_keys


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` buckets by ``key``, each one sorted file, and read it back."""
    return write_dealt(df.repartition(buckets, key), table, key, buckets, path)


def write_dealt(dealt: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """The same for rows that are dealt by the key into so many partitions already, as those of :func:`upsert_bucketed`."""
    writer = dealt.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return dealt.sparkSession.table(table)


def buckets_of(spark: SparkSession, table: str) -> tuple[str, int]:
    """Key and number of buckets of a table with one bucket column."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name IN ('Num Buckets', 'Bucket Columns')").collect()}
    names = told.get("Bucket Columns", "").strip("[]").replace("`", "").split(", ")
    if names == [""] or len(names) > 1:
        raise ValueError(f"{table} is not bucketed by one column")
    return names[0], int(told["Num Buckets"])


def upsert_bucketed(target: DataFrame, source: DataFrame, key: str, buckets: int, *, only_if_newer: str | None = None, check: bool = False) -> DataFrame:
    """Replace the target rows that the source has a row for and add the rest, each side read and the target not moved.

    ``target`` reads a table of ``buckets`` buckets by ``key``. With ``only_if_newer`` a matched row is replaced only
    by one with a greater value in that column; a NULL counts as oldest. With ``check`` a key that the source
    repeats fails the job; without it, its rows must be unique. NULL keys match nothing: such rows of both sides are kept.
    """
    dealt = source.select(*target.columns).repartition(buckets, key)
    if check:
        # Dealt by key already, so this test costs no shuffle.
        dealt = dealt.join(source_keys(dealt, key, True), key, "left_semi").unionByName(dealt.filter(F.col(key).isNull()))
        dealt = dealt.repartition(buckets, key)
    t, s = target.withColumn("_old", F.lit(True)).alias("t"), dealt.withColumn("_new", F.lit(True)).alias("s")
    wins = F.col("_new").isNotNull()
    if only_if_newer:
        old, new = F.col(f"t.{only_if_newer}"), F.col(f"s.{only_if_newer}")
        wins = wins & (F.col("_old").isNull() | (new.isNotNull() & (old.isNull() | (new > old))))
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    return joined.select(*[F.when(wins, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns])


def upsert_table(spark: SparkSession, table: str, source: DataFrame, into: str, *, path: str | None = None, only_if_newer: str | None = None, check: bool = False) -> DataFrame:
    """Upsert into a bucketed table and write the result as table ``into`` with the same buckets, without a shuffle of the target."""
    key, buckets = buckets_of(spark, table)
    made = upsert_bucketed(spark.table(table), source, key, buckets, only_if_newer=only_if_newer, check=check)
    return write_dealt(made, into, key, buckets, path)
