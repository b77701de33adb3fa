from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalith.operators.upsert import insert_missing, merge_columns, update_where, upsert

SCHEMA = "k long, v string, at int"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, None, None), (None, "n", 1)], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, "B", 9), (3, "C", 5), (4, "D", 1), (None, "N", 2)], SCHEMA)


def test_insert_missing_leaves_matched_rows_alone(target, source):
    assert rows_of(insert_missing(target, source, "k")) == [
        (1, "a", 10), (2, "b", 10), (3, None, None), (4, "D", 1), (None, "N", 2), (None, "n", 1),
    ]


def test_upsert_last_batch_wins_and_null_keys_never_match(target, source):
    after = upsert(target, source, "k", check=True)
    assert rows_of(after) == [
        (1, "a", 10), (2, "B", 9), (3, "C", 5), (4, "D", 1), (None, "N", 2), (None, "n", 1),
    ]
    keyed = after.filter("k IS NOT NULL")
    assert rows_of(upsert(keyed, source.filter("k IS NOT NULL"), "k")) == rows_of(keyed)


def test_upsert_only_if_newer(target, source, spark):
    assert rows_of(upsert(target, source, "k", only_if_newer="at", check=True)) == [
        (1, "a", 10), (2, "b", 10), (3, "C", 5), (4, "D", 1), (None, "N", 2), (None, "n", 1),
    ]
    same_age = spark.createDataFrame([(1, "z", 10)], SCHEMA)
    assert (1, "a", 10) in rows_of(upsert(target, same_age, "k", only_if_newer="at"))


def test_upsert_by_two_keys(spark):
    t = spark.createDataFrame([(1, "x", 1), (1, "y", 1), (1, None, 1)], SCHEMA)
    s = spark.createDataFrame([(1, "y", 2), (1, None, 2)], SCHEMA)
    assert rows_of(upsert(t, s, ["k", "v"])) == [(1, "x", 1), (1, "y", 2), (1, None, 1), (1, None, 2)]


@pytest.mark.parametrize("similar", [False, True])
def test_merge_columns_updates_some_and_inserts_some(target, source, similar):
    after = merge_columns(
        target, source, "k", update={"v": "v"}, insert={"k": "k", "v": F.upper("s.v")}, check=True, similar_size=similar
    )
    assert rows_of(after) == [
        (1, "a", 10), (2, "B", 10), (3, "C", None), (4, "D", None), (None, "N", None), (None, "n", 1),
    ]


@pytest.mark.parametrize("similar", [False, True])
def test_merge_columns_null_overwrites_and_both_sides_are_named(spark, target, similar):
    s = spark.createDataFrame([(1, None, 5)], SCHEMA)
    after = merge_columns(
        target, s, "k", update={"v": "v", "at": F.col("s.at") + F.col("t.at")}, insert={}, similar_size=similar
    )
    assert rows_of(after) == [(1, None, 15), (2, "b", 10), (3, None, None), (None, "n", 1)]


def test_merge_columns_full_row_insert_by_default(target, source):
    assert (4, "D", 1) in rows_of(merge_columns(target, source, "k", update={"v": F.col("s.k").cast("string")}))
    assert (2, "2", 10) in rows_of(merge_columns(target, source, "k", update={"v": F.col("s.k").cast("string")}))


@pytest.mark.parametrize("merge", [
    lambda t, s: upsert(t, s, "k", check=True),
    lambda t, s: upsert(t, s, "k", only_if_newer="at", check=True),
    lambda t, s: merge_columns(t, s, "k", update={"v": "v"}, check=True),
])
def test_repeated_source_key_fails_when_checked(target, source, merge):
    twice = source.unionByName(source.filter("k = 2"))
    with pytest.raises(Exception, match="merge source repeats key"):
        merge(target, twice).collect()


def test_update_where_ignores_unknown(target):
    after = update_where(target, F.col("at") > 5, {"v": F.lit("old"), "at": F.col("at") + 1})
    assert rows_of(after) == [(1, "old", 11), (2, "old", 11), (3, None, None), (None, "n", 1)]


def test_small_batch_leaves_the_target_unshuffled(spark, tmp_path):
    big = str(tmp_path / "big")
    spark.range(200000).selectExpr("id k", "'v' v", "1 at").write.parquet(big)
    target = spark.read.parquet(big)
    batch = spark.createDataFrame([(5, "x", 2), (-1, "y", 2)], SCHEMA)
    for after in (
        upsert(target, F.broadcast(batch), "k"),
        merge_columns(target, F.broadcast(batch), "k", update={"v": "v"}),
    ):
        assert after.count() == 200001
        plan = after._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
