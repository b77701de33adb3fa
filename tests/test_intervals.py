"""Versions as validity intervals, against ranking all versions."""

from __future__ import annotations

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalith.operators import intervals, versions

ROWS = "id long, x string, _version int, _commit_ts timestamp_ntz, _op string"


def commit(number: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=number)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def made_versions(spark, numbers=range(6), keys=200, seed=1):
    rng, rows = random.Random(seed), []
    for number in numbers:
        for key in [*rng.sample(range(keys), keys // 3), *([None] if number % 2 else [])]:
            op = versions.DELETED if rng.random() < 0.2 else versions.WROTE
            rows.append((key, f"{key}-{number}", number, commit(number), op))
    return spark.createDataFrame(rows, ROWS).repartition(3)


@pytest.fixture(scope="module")
def rows(spark):
    return made_versions(spark).cache()


def test_every_version_reads_the_same(spark, rows):
    held = intervals.with_intervals(rows, "id").cache()
    for number in range(6):
        state = intervals.as_of(held, number)
        assert rows_of(state) == rows_of(versions.keyed_state(rows, "id", F.lit(number)))
        assert state.columns == ["id", "x"]


def test_extending_load_by_load_gives_the_same_intervals(spark, rows):
    closed, still_open = None, intervals.with_intervals(rows.filter("_version = 0"), "id")
    for number in range(1, 6):
        ended, still_open = intervals.extend(still_open, rows.filter(F.col("_version") == number), "id")
        closed = ended if closed is None else closed.unionByName(ended)
    without_null = rows.filter("id IS NOT NULL")
    found = closed.unionByName(still_open).filter("id IS NOT NULL")
    assert rows_of(found) == rows_of(intervals.with_intervals(without_null, "id").select(*found.columns))


def test_extending_ranks_nothing(spark):
    held = spark.createDataFrame([(1, "a", 0, commit(0), "WRITE", intervals.OPEN, commit(9))], ROWS + ", _to int, _to_ts timestamp_ntz")
    for part in intervals.extend(held, made_versions(spark, [1]), "id"):
        assert "Window" not in plan_of(part)


def test_rows_without_a_key_are_never_closed_by_a_batch(spark):
    first = spark.createDataFrame([(None, "a", 0, commit(0), "WRITE"), (1, "b", 0, commit(0), "WRITE")], ROWS)
    batch = spark.createDataFrame([(None, "c", 1, commit(1), "WRITE"), (1, "d", 1, commit(1), "DELETE")], ROWS)
    closed, still_open = intervals.extend(intervals.with_intervals(first, "id"), batch, "id")
    assert [(r["x"], r["_to"]) for r in closed.collect()] == [("b", 1)]
    assert sorted(r["x"] for r in still_open.collect()) == ["a", "c", "d"]
    assert rows_of(intervals.as_of(closed.unionByName(still_open), 1)) == [(None, "a"), (None, "c")]


def test_expiry_keeps_what_the_ranking_keeps(spark, rows):
    held, commits = intervals.with_intervals(rows, "id"), intervals.commits_of(rows)
    for days in (-1, 0, 2.5, 4, 9):
        cutoff = F.lit(commit(0) + dt.timedelta(days=days)).cast("timestamp_ntz")
        kept = intervals.expire(held, commits, cutoff)
        expected = intervals.with_intervals(versions.expire_keyed(rows, "id", cutoff), "id") if days >= 0 else held
        assert rows_of(kept.select(*expected.columns)) == rows_of(expected)


def test_numbers_that_are_not_kept_are_errors(spark, rows):
    commits = intervals.commits_of(rows.filter("_version IN (2, 4)"))
    assert [intervals.version_number(commits, n) for n in (2, 3, 4)] == [2, 2, 4]
    assert intervals.version_number_at(commits, F.lit(commit(3)).cast("timestamp_ntz")) == 2
    for number in (1, 5):
        with pytest.raises(LookupError):
            intervals.version_number(commits, number)
    with pytest.raises(LookupError):
        intervals.version_number_at(commits, F.lit(commit(1)).cast("timestamp_ntz"))


def test_reading_is_a_pushed_filter_that_skips_files(spark, tmp_path):
    path, files = str(tmp_path / "intervals"), 12
    rows = made_versions(spark, range(12), keys=3000)
    intervals.placed(intervals.with_intervals(rows, "id"), files).write.parquet(path)
    state = intervals.as_of(spark.read.parquet(path), 3)
    plan = plan_of(state)
    assert not any(x in plan for x in ("Window", "Exchange", "Sort", "Aggregate"))
    # The plan cuts long lists of filters short.
    assert "LessThanOrEqual(_version,3)" in plan and "GreaterThan(_t" in plan
    admitted = 0
    for file in (tmp_path / "intervals").glob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        held = {group.column(k).path_in_schema: group.column(k).statistics for k in range(group.num_columns)}
        admitted += held["_version"].min <= 3 < held["_to"].max
    assert 0 < admitted <= files // 2
    assert rows_of(state) == rows_of(versions.keyed_state(rows, "id", F.lit(3)))


def test_empty_tables(spark):
    none = spark.createDataFrame([], ROWS)
    held = intervals.with_intervals(none, "id")
    assert intervals.as_of(held, 0).count() == 0
    assert [x.count() for x in intervals.extend(held, none, "id")] == [0, 0]
    assert intervals.expire(held, intervals.commits_of(none), F.current_timestamp().cast("timestamp_ntz")).count() == 0
