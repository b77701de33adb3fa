"""Distinct counts from bitmaps, and the aggregates that follow from them."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalith.operators import distinct
from stratalith.plans import gold

SALES = "order_date timestamp_ntz, state string, order_id long, customer_id long, sales_amount double"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sales(spark, n=3000, seed=3):
    rng = random.Random(seed)
    edges = [None, 0, 1, -1, 32768, 32769, -32767, -32768, -32769, 2**62, -(2**62), 2**63 - 1, -(2**63)]

    def key():
        return rng.choice(edges) if rng.random() < 0.3 else rng.randrange(-100_000, 100_000)

    rows = []
    for _ in range(n):
        day = None if rng.random() < 0.05 else dt.datetime(2020, rng.randrange(1, 4), rng.randrange(1, 4), rng.randrange(24))
        rows.append((day, rng.choice([None, "A", "B"]), key(), key(), rng.choice([None, 0.1, 2.25, 1e6])))
    rows.append((dt.datetime(2021, 1, 1), "no ids", None, None, None))
    return spark.createDataFrame(rows, SALES).repartition(4)


def test_parts_give_the_same_as_counting_all_rows(spark):
    df = sales(spark)
    parts = gold.daily_parts(df).cache()
    assert rows_of(gold.daily_sales_of(parts)) == rows_of(gold.daily_sales(df))
    assert rows_of(gold.monthly_sales_of(parts)) == rows_of(gold.monthly_sales(df))
    assert rows_of(gold.revenue_by_state_of(gold.sales_parts(df, "state"))) == rows_of(gold.revenue_by_state(df))


def test_months_from_stored_days(spark, tmp_path):
    df, path = sales(spark), str(tmp_path / "parts")
    gold.daily_parts(df).write.parquet(path)
    months = gold.monthly_sales_of(spark.read.parquet(path))
    assert rows_of(months) == rows_of(gold.monthly_sales(df))
    assert "Expand" not in plan_of(months) and "sales_amount" not in plan_of(months)


def test_no_row_is_repeated_per_key(spark):
    df = sales(spark, 50)
    assert "Expand" in plan_of(gold.revenue_by_state(df))
    for made in (gold.revenue_by_state_of(gold.sales_parts(df, "state")), gold.monthly_sales_of(gold.daily_parts(df))):
        plan = plan_of(made)
        assert "Expand" not in plan and "Generate" not in plan
        # Keys are never shuffled, only bitmaps and sums.
        assert not any("order_id" in line or "customer_id" in line for line in plan.splitlines() if "Exchange" in line)


def test_merging_is_by_members_and_not_by_number(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("b", 5), ("b", None), ("c", None)], "g string, id long")
    parts = distinct.group_parts(df, ["g"], {"ids": "id"}, {"rows": F.lit(1)})
    assert rows_of(distinct.totals(parts, ["g"], {"rows": "rows"}, {"n": "ids"})) == [("a", 2.0, 1), ("b", 2.0, 1), ("c", 1.0, 0)]
    everything = distinct.merged(parts.unionByName(parts), {"all": F.lit("x")})
    assert rows_of(distinct.totals(everything, ["all"], {"rows": "rows"}, {"n": "ids"})) == [("x", 10.0, 1)]


def test_empty_tables_and_names_in_use(spark):
    none = spark.createDataFrame([], SALES)
    assert gold.monthly_sales_of(gold.daily_parts(none)).count() == 0
    with pytest.raises(ValueError, match="bucket"):
        distinct.key_sets(none.withColumnRenamed("state", "bucket"), ["bucket"], {"orders": "order_id"})
