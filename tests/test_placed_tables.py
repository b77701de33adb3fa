"""Bucketed merges and the fact that is refreshed month by month."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalith.operators.upsert import upsert
from stratalith.plans import gold, refresh
from stratalith.sources import bucketed
from stratalith.sources.files import overwrite_partitions, partition_path


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def side(spark, first, last, word, step=1):
    ids = spark.range(first, last, step)
    return ids.select("id", F.concat(F.lit(word), F.col("id").cast("string")).alias("x"), (F.col("id") * 7 % 50).cast("int").alias("at"))


def exchanges_of_target(plan: str) -> list[str]:
    """Exchanges above the scan of the bucketed table: those of its branch of the join."""
    lines = plan.splitlines()
    scan = next(k for k, line in enumerate(lines) if "Bucketed: true" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    found, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            level = depth(line)
            if "Exchange" in line:
                found.append(line)
    return found


def test_the_target_of_a_bucketed_merge_is_not_moved(spark, no_broadcast, name, tmp_path):
    target = bucketed.write_bucketed(side(spark, 0, 2000, "old"), name, "id", 6, str(tmp_path / "a"))
    source = side(spark, 1500, 2500, "new")
    made = bucketed.upsert_bucketed(target, source, "id", 6)
    assert "SortMergeJoin" in plan_of(made) and exchanges_of_target(plan_of(made)) == []
    plain = upsert(side(spark, 0, 2000, "old"), source, "id")
    assert "Exchange" in plan_of(plain) and rows_of(made) == rows_of(plain)


def test_rounds_of_merges_stay_bucketed(spark, no_broadcast, name, tmp_path):
    spark_rows = side(spark, 0, 300, "r0")
    bucketed.write_bucketed(spark_rows, f"{name}_0", "id", 5, str(tmp_path / "0"))
    for k in (1, 2, 3):
        batch = side(spark, 100 * k, 100 * k + 250, f"r{k}-", step=k)
        made = bucketed.upsert_table(spark, f"{name}_{k - 1}", batch, f"{name}_{k}", path=str(tmp_path / str(k)), check=True)
        spark_rows = upsert(spark_rows, batch, "id")
        assert bucketed.buckets_of(spark, f"{name}_{k}") == ("id", 5)
        assert rows_of(made) == rows_of(spark_rows)
        assert len([f for f in os.listdir(tmp_path / str(k)) if f.endswith(".parquet")]) == 5
    joined = spark.table(f"{name}_2").join(spark.table(f"{name}_3"), "id")
    assert "Exchange" not in plan_of(joined)


def test_null_keys_match_nothing_and_newer_rows_win(spark, name, tmp_path):
    schema = "id long, x string, at int"
    old = spark.createDataFrame([(None, "old", 1), (1, "old", 5), (2, "old", 5), (3, "old", None), (4, "old", 1)], schema)
    new = spark.createDataFrame([(None, "new", 9), (1, "new", 4), (2, "new", 6), (3, "new", None), (5, "new", None)], schema)
    target = bucketed.write_bucketed(old, name, "id", 3, str(tmp_path / "n"))
    for newer in (None, "at"):
        found = bucketed.upsert_bucketed(target, new, "id", 3, only_if_newer=newer, check=True)
        assert rows_of(found) == rows_of(upsert(old, new, "id", only_if_newer=newer))
    twice = new.unionByName(new.filter("id = 5"))
    with pytest.raises(Exception, match="repeats key"):
        bucketed.upsert_bucketed(target, twice, "id", 3, check=True).collect()


def test_tables_without_buckets_are_refused(spark, name, tmp_path):
    side(spark, 0, 5, "x").write.option("path", str(tmp_path / "p")).saveAsTable(name)
    with pytest.raises(ValueError, match="not bucketed"):
        bucketed.buckets_of(spark, name)


# The fact by month

ORDERS = "order_id long, order_date timestamp_ntz"


def stored_fact(spark, known, path):
    fact = gold.fact_sales(enrich(known))
    refresh.write_fact(fact, path)
    return refresh.read_fact(spark, path, fact)


def orders(spark, *rows):
    return spark.createDataFrame([(k, None if d is None else dt.datetime.fromisoformat(d)) for k, d in rows], ORDERS)


def enrich(some):
    """Two items for every order."""
    items = some.withColumn("item", F.explode(F.array(F.lit(1), F.lit(2))))
    return items.select((F.col("order_id") * 10 + F.col("item")).alias("order_item_id"), "order_id", "order_date")


def files_below(path) -> dict[str, float]:
    return {
        os.path.relpath(os.path.join(folder, f), path): os.stat(os.path.join(folder, f)).st_mtime_ns
        for folder, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def months_of(files) -> set[str]:
    return {os.path.dirname(f) for f in files}


def test_only_touched_months_are_written_again(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = orders(spark, (1, "2020-01-05"), (2, "2020-01-06"), (3, "2020-02-01"), (4, "2020-03-01"), (5, None), (6, "2021-01-01"))
    fact, before = stored_fact(spark, first, path), files_below(path)
    assert months_of(before) == {
        "order_year=2020/order_month=1", "order_year=2020/order_month=2", "order_year=2020/order_month=3", "order_year=2021/order_month=1",
        "order_year=__HIVE_DEFAULT_PARTITION__/order_month=__HIVE_DEFAULT_PARTITION__",
    }
    # Order 2 moves to March, 3 to a month of its own, 5 gets a date, 6 is taken away, 7 is new.
    after = orders(spark, (1, "2020-01-05"), (2, "2020-03-06"), (3, "2020-05-01"), (4, "2020-03-01"), (5, "2020-05-05"), (7, "2020-05-06"))
    changed = spark.createDataFrame([(2,), (3,), (5,), (6,), (7,), (7,)], "order_id long")
    done = refresh.refresh_fact(path, fact, after, changed, enrich)
    assert done == refresh.Refreshed([(2020, 1), (2020, 3), (2020, 5)], [(None, None), (2020, 2), (2021, 1)])
    assert rows_of(refresh.read_fact(spark, path, fact)) == rows_of(gold.fact_sales(enrich(after)).select(*fact.columns))
    # A late change of one order in May leaves all other months' files as they are.
    held = files_below(path)
    last = after.filter("order_id <> 7").unionByName(orders(spark, (7, "2020-05-07")))
    done = refresh.refresh_fact(path, refresh.read_fact(spark, path, fact), last, spark.createDataFrame([(7,)], "order_id long"), enrich)
    assert done == refresh.Refreshed([(2020, 5)], [])
    now = files_below(path)
    may = "order_year=2020/order_month=5"
    assert {f: t for f, t in now.items() if not f.startswith(may)} == {f: t for f, t in held.items() if not f.startswith(may)}
    assert not {f for f in now if f.startswith(may)} & held.keys()
    assert rows_of(refresh.read_fact(spark, path, fact)) == rows_of(gold.fact_sales(enrich(last)).select(*fact.columns))


def test_a_refresh_that_failed_is_repeated(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact = stored_fact(spark, orders(spark, (1, "2020-01-05"), (2, "2020-02-06")), path)
    before, changed = files_below(path), spark.createDataFrame([(2,)], "order_id long")
    after = orders(spark, (1, "2020-01-05"), (2, "2020-01-07"))

    def broken(some):
        return enrich(some).withColumn("order_id", F.raise_error(F.lit("no luck")).cast("long"))

    with pytest.raises(Exception, match="no luck"):
        refresh.refresh_fact(path, fact, after, changed, broken)
    assert files_below(path) == before
    for _ in range(2):
        refresh.refresh_fact(path, refresh.read_fact(spark, path, fact), after, changed, enrich)
        assert rows_of(refresh.read_fact(spark, path, fact)) == rows_of(gold.fact_sales(enrich(after)).select(*fact.columns))


def test_nothing_changed_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "fact")
    known = orders(spark, (1, "2020-01-05"))
    fact, before = stored_fact(spark, known, path), files_below(path)
    none = spark.createDataFrame([], "order_id long")
    assert refresh.refresh_fact(path, fact, known, none, enrich) == refresh.Refreshed([], [])
    assert files_below(path) == before


def test_partition_folders(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, 2, "a"), (None, 3, "b")], "y int, m int, x string")
    assert overwrite_partitions(df, path, ["y", "m"], {"n": F.count("x")}) == {"n": 2}
    for values in ({"y": 1, "m": 2}, {"y": None, "m": 3}):
        assert os.path.isdir(partition_path(path, values))
