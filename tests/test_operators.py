from __future__ import annotations

import datetime as dt
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from conftest import rows_of
from pyspark.sql import functions as F, types as T

from stratalith.functions.columns import average_per, mark_literal, mark_micros, money_total
from stratalith.operators import constraints, incremental, layout, versions
from stratalith.operators.clean import clean, parse_timestamps, rejects
from stratalith.operators.dedup import latest_per_key
from stratalith.operators.joins import hot_keys, only_keys_of, spread_join
from stratalith.plans import enrich, gold, reports
from stratalith.sources import bucketed, control, footers
from stratalith.sources.csv_files import read_csv, with_source_file
from stratalith.spec import CUSTOMERS, ENTITIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def customers(spark, *rows):
    return spark.createDataFrame(
        list(rows), "customer_id string, name string, city string, state string, signup_date string, "
        "created_at string, updated_at string",
    )


# Cleaning


def test_clean_types_trims_and_keeps_rejects(spark):
    df = customers(
        spark,
        (" 7 ", " Ann  Lee ", " new york-city", "ny ", "2020-01-01", "2020-01-01 10:00:00", "never"),
        ("1e", "x", "x", "x", None, None, None),
        (None, "y", "y", "y", None, None, None),
    )
    assert rows_of(clean(df, CUSTOMERS)) == [
        (7, "Ann  Lee", "New York-city", "NY", datetime(2020, 1, 1), datetime(2020, 1, 1, 10), None)
    ]
    bad = rejects(df, CUSTOMERS)
    assert rows_of(bad.select("customer_id", "reject_reason")) == [("1e", "unreadable key"), (None, "missing key")]
    assert clean(df, CUSTOMERS).count() + bad.count() == df.count()


def test_clean_without_description_changes_nothing(spark):
    df = spark.createDataFrame([(" a ",)], "x string")
    assert clean(df, None) is df


def test_parse_timestamps_skips_absent_and_keeps_typed_columns(spark):
    df = spark.sql("SELECT '2020-01-02' a, timestamp_ntz'2020-01-02 03:00:00' b, date'2020-01-02' c, 'x' d")
    out = parse_timestamps(df, ["a", "b", "c", "missing"])
    assert [f.dataType for f in out.schema.fields] == [
        T.TimestampType(), T.TimestampNTZType(), T.TimestampType(), T.StringType()
    ]
    assert parse_timestamps(df, ["missing"]) is df


def test_csv_scan_with_schema_and_inferred(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,price\n1,2.5\n2,\n")
    inferred = read_csv(spark, str(tmp_path))
    assert inferred.dtypes == [("id", "int"), ("price", "double")]
    given = read_csv(spark, str(tmp_path), T.StructType.fromDDL("id string, price string"))
    assert rows_of(given) == [("1", "2.5"), ("2", None)]
    assert with_source_file(given).first()["source_file_name"].endswith("a.csv")


# Deduplication and joins


def test_latest_per_key_orders_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(1, None, "z"), (1, 5, "a"), (1, 5, "b"), (2, None, "only"), (None, 1, "p"), (None, 2, "q")],
        "k int, at int, v string",
    )
    for parts in (1, 5):
        got = latest_per_key(df.repartition(parts), "k", ["at", "v"])
        assert rows_of(got) == [(1, 5, "b"), (2, None, "only"), (None, 2, "q")]


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 k", "id at")
    plan = plan_of(latest_per_key(df, "k", ["at"]))
    before_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_hot_keys_finds_large_shares_only(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 7L, id + 100) a", "if(id % 3 = 1, null, id) b")
    assert hot_keys(df, ["a", "b"], 0.05) == {"a": [7], "b": []}


@pytest.mark.parametrize("hot", [(), (7,)])
@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_spread_join_equals_plain_join(spark, hot, how):
    left = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id % 50 END AS k"
    )
    right = spark.range(40).selectExpr("id AS k", "'n' || id AS name").unionByName(
        spark.createDataFrame([(None, "none")], "k long, name string")
    )
    got = spread_join(left, right, "k", how, row_id="id", hot=hot)
    assert rows_of(got) == rows_of(left.join(right, "k", how).select(*got.columns))


def test_spread_join_splits_null_and_hot_keys(spark):
    """A third of the rows has one key and a third has none; no task gets either third."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(30000).selectExpr(
            "id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS k"
        )
        right = spark.range(30000).selectExpr("id AS k", "id AS v")
        hot = hot_keys(left, ["k"])["k"]

        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        plain = largest(left.join(right, "k", "left"))
        spread = largest(spread_join(left, right, "k", "left", row_id="id", hot=hot))
        assert hot == [7] and plain >= 10000 and spread < 5000
    finally:
        for key, value in (("autoBroadcastJoinThreshold", "10MB"), ("adaptive.enabled", "true"), ("shuffle.partitions", "4")):
            spark.conf.set(f"spark.sql.{key}", value)


def test_only_keys_of_keeps_each_row_once(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows_of(only_keys_of(df, keys, "k")) == [(1, "a"), (1, "b")]
    assert "Aggregate" not in plan_of(only_keys_of(df, keys, "k"))


# Increments


def test_marks(spark):
    ts = datetime(2020, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([(1, ts), (2, datetime(2020, 1, 1)), (3, None)], "id int, at timestamp")
    micros = df.agg(F.max(mark_micros("at"))).first()[0]
    assert df.filter(F.col("at") == mark_literal(micros)).count() == 1
    assert rows_of(incremental.newer_than(df, "at", mark_literal(micros))) == []
    assert incremental.newer_than(df, "at", None) is df
    assert rows_of(incremental.unmarked(df, "at")) == [(3, None)]


def test_next_mark_of_empty_batch_is_the_previous_one(spark):
    df = spark.createDataFrame([], "a timestamp, b timestamp")
    before = F.lit("2020-01-01").cast("timestamp")
    assert incremental.next_mark(df, ["a", "b"], before).first()[0] == datetime(2020, 1, 1)
    assert incremental.next_mark(df, ["a"]).first()[0] is None


def test_next_mark_skips_null_side(spark):
    df = spark.createDataFrame([(None, datetime(2020, 1, 5)), (None, datetime(2020, 1, 4))], "a timestamp, b timestamp")
    assert incremental.next_mark(df, ["a", "b"]).first()[0] == datetime(2020, 1, 5)


def test_mark_state_machine(spark):
    now = F.lit("2024-01-01").cast("timestamp")
    marks = control.seed_marks(control.empty(spark, control.WATERMARK), control.seeds(spark, ["a", "b"], now))
    run = spark.createDataFrame(
        [("a", datetime(2023, 5, 1), "r1", "SUCCESS", datetime(2024, 1, 2))], control.WATERMARK
    )
    marks = control.mark_success(marks, run)
    # A failure and a running load leave the mark where it was, and it can still be read.
    failed = control.mark_failed(marks, "a", now)
    assert incremental.stored_mark(failed, "a").first()[0] == datetime(2023, 5, 1)
    assert incremental.stored_mark(marks, "zzz").first()[0] == datetime(1900, 1, 1)
    # An empty batch brings no mark; the 2-column form leaves the run id alone.
    empty = spark.createDataFrame([("a", None, "r2", "SUCCESS", datetime(2024, 1, 3))], control.WATERMARK)
    got = control.mark_success(failed, empty, ("last_run_ts", "status", "updated_at")).filter("table_name = 'a'")
    assert rows_of(got) == [("a", datetime(2023, 5, 1), "r1", "SUCCESS", datetime(2024, 1, 3))]


def test_mark_state_pattern(spark):
    marks = spark.createDataFrame(
        [("silver_a", None, None, "INIT", None), ("silverXb", None, None, "INIT", None)], control.WATERMARK
    )
    assert [r[0] for r in reports.mark_state(marks, "silver_%").collect()] == ["silverXb", "silver_a"]
    assert [r[0] for r in reports.mark_state(marks, "silver\\_%").collect()] == ["silver_a"]


def test_control_schemas_carry_comments(spark):
    df = control.empty(spark, control.RUN_LOG)
    assert df.schema["row_count"].metadata == {"comment": "Rows written"} and df.count() == 0


# Constraints


def test_check_counts_unknown_as_violation(spark):
    df = spark.createDataFrame([("INIT",), ("DONE",), (None,)], "status string")
    rule = constraints.allowed_values("status", constraints.STATUSES)
    assert rows_of(constraints.violations(df, rule)) == [("DONE",), (None,)]
    with pytest.raises(Exception, match="check valid_status violated"):
        constraints.enforce(df, rule, "valid_status").collect()
    good = df.filter("status = 'INIT'")
    assert rows_of(constraints.enforce(good, rule, "valid_status")) == [("INIT",)]


def test_repeated_keys_and_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows_of(constraints.repeated_keys(df, "k")) == [(1, 2), (None, 2)]
    assert rows_of(constraints.repeated_keys(df.dropDuplicates(), "k")) == []
    assert rows_of(constraints.row_counts({"a": df, "b": df.limit(0)})) == [("a", 5), ("b", 0)]


# Versions


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [
            (1, "a", 0, datetime(2024, 1, 1), "WRITE"), (2, "b", 0, datetime(2024, 1, 1), "WRITE"),
            (3, "c", 0, datetime(2024, 1, 1), "WRITE"), (2, "B", 1, datetime(2024, 1, 2), "WRITE"),
            (3, None, 1, datetime(2024, 1, 2), "DELETE"), (4, "D", 2, datetime(2024, 1, 3), "WRITE"),
        ],
        "k int, v string, _version int, _commit_ts timestamp, _op string",
    )


def at(text):
    return F.lit(text).cast("timestamp")


def test_keyed_state_at_version_and_time(rows):
    assert rows_of(versions.keyed_state(rows, "k")) == [(1, "a"), (2, "B"), (4, "D")]
    assert rows_of(versions.keyed_state(rows, "k", versions.version_at(rows, 0))) == [(1, "a"), (2, "b"), (3, "c")]
    noon = versions.version_when(rows, at("2024-01-02 12:00:00"))
    assert rows_of(versions.keyed_state(rows, "k", noon)) == [(1, "a"), (2, "B")]
    with pytest.raises(Exception, match="no version that old is kept"):
        versions.keyed_state(rows, "k", versions.version_when(rows, at("2023-12-31"))).collect()
    for missing in (-1, 3):
        with pytest.raises(Exception, match=f"version {missing} is not kept"):
            versions.keyed_state(rows, "k", versions.version_at(rows, missing)).collect()


def test_snapshot_state(rows):
    assert rows_of(versions.snapshot_state(rows)) == [(4, "D")]
    assert rows_of(versions.snapshot_state(rows, versions.version_at(rows, 1))) == [(2, "B"), (3, None)]


def test_history(rows):
    assert rows_of(versions.history(rows)) == [
        (0, datetime(2024, 1, 1), 3, 0), (1, datetime(2024, 1, 2), 1, 1), (2, datetime(2024, 1, 3), 1, 0),
    ]


def test_expire_keeps_every_later_state(rows):
    left = versions.expire_keyed(rows, "k", at("2024-01-02 06:00:00"))
    for n in (1, 2):
        assert rows_of(versions.keyed_state(left, "k", versions.version_at(left, n))) == rows_of(
            versions.keyed_state(rows, "k", versions.version_at(rows, n))
        )
    assert left.count() == 3
    with pytest.raises(Exception, match="version 0 is not kept"):
        versions.keyed_state(left, "k", versions.version_at(left, 0)).collect()
    assert rows_of(versions.expire_keyed(rows, "k", at("2023-01-01"))) == rows_of(rows)
    assert rows_of(versions.expire_snapshots(rows, at("2024-01-02"))) == rows_of(rows.filter("_version >= 1"))
    assert rows_of(versions.expire_snapshots(rows, at("2023-01-02"))) == rows_of(rows)


def test_touching_state_follows_moved_rows(spark):
    rows = spark.createDataFrame(
        [(1, 100, 0), (1, 200, 1), (2, 100, 0), (3, 300, 0)], "k int, parent int, _version int"
    ).withColumns({"_commit_ts": F.current_timestamp(), "_op": F.lit("WRITE")})
    parents = spark.createDataFrame([(100,)], "parent int")
    assert rows_of(versions.keyed_state_touching(rows, "k", parents, "parent")) == [(100, 2)] or rows_of(
        versions.keyed_state_touching(rows, "k", parents, "parent").select("k", "parent")
    ) == [(2, 100)]


# Layout


def test_z_address_interleaves_bits(spark):
    df = spark.createDataFrame([(0b10, 0b01), (0b11, 0b11), (0, 0)], "a int, b int")
    got = df.select(layout.z_address([F.col("a"), F.col("b")], 2)).collect()
    assert [r[0] for r in got] == [0b1001, 0b1111, 0]


def test_buckets_count_cut_points(spark):
    df = spark.createDataFrame([(v, f"s{v}") for v in (None, 1, 2, 3, 9)], "a int, b string")
    got, names = layout.with_buckets(df, {"a": [2, 3, 5], "b": [int.from_bytes(b"s2".ljust(layout.PREFIX, b"\0"))]}, 2)
    assert [tuple(r) for r in got.select(*names).collect()] == [(0, 1), (0, 0), (1, 1), (2, 1), (3, 1)]
    none, names = layout.with_buckets(df, {"a": []})
    assert [r[0] for r in none.select(*names).collect()] == [0] * 5
    full, names = layout.with_buckets(spark.range(64), {"id": list(range(1, 64))})
    assert [r[0] for r in full.select(*names).collect()] == list(range(64))


def test_cluster_by_keeps_rows_and_narrows_files(spark, tmp_path):
    df = spark.range(20000).selectExpr("id", "pmod(hash(id), 1000) a", "pmod(hash(id, 1), 1000) b", "'s' || id % 7 s")
    out = str(tmp_path / "z")
    clustered = layout.cluster_by(df, ["a", "b"], files=16, cuts=layout.cut_points(df, ["a", "b"]))
    clustered.write.parquet(out)
    back = spark.read.parquet(out)
    assert rows_of(back) == rows_of(df) and len(back.inputFiles()) == 16
    for c in ("a", "b"):
        width = back.groupBy(F.input_file_name()).agg((F.max(c) - F.min(c)).alias("w")).agg(F.avg("w")).first()[0]
        assert width < 500, (c, width)
    assert rows_of(layout.cluster_by(df, ["s"])) == rows_of(df)
    assert rows_of(layout.cluster_by(df, ["s", "a"], within=["b"])) == rows_of(df)


def test_placing_rises_with_every_kind_of_column(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1, 1.5D, date'1969-12-31', timestamp'1969-12-31 23:00:00', timestamp_ntz'2020-01-01', 'a', true, cast(1.5 AS decimal(9,2))),
        (-7, -1e300D, date'2020-01-01', timestamp'2020-01-01', timestamp_ntz'1900-01-01', '', false, cast(-3 AS decimal(9,2))),
        (9, 2.5D, date'1900-01-01', timestamp'1900-01-01', timestamp_ntz'2020-01-02', 'aé', true, cast(99 AS decimal(9,2))),
        (NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL) AS t(i, d, day, at, wall, text, yes, money)""")
    for c in df.columns:
        rows = df.select(F.col(c), layout.placing(df, c)).orderBy(F.col(c).asc_nulls_first()).collect()
        assert rows[0][1] is None and [r[1] for r in rows[1:]] == sorted(r[1] for r in rows[1:]), c
    assert layout.cut_points(df.limit(0), ["i", "text"]) == {"i": [], "text": []}


def test_cut_points_are_few_and_split_evenly(spark):
    df = spark.range(100_000).selectExpr("pmod(hash(id), 100000) a", "concat('k', lpad(id, 6, '0')) s")
    cuts = layout.cut_points(df, ["a", "s"], bits=4)
    assert [len(v) for v in cuts.values()] == [15, 15]
    bucketed, names = layout.with_buckets(df, cuts, 4)
    for name in names:
        sizes = [r["count"] for r in bucketed.groupBy(name).count().collect()]
        assert len(sizes) == 16 and max(sizes) < 1.2 * 100_000 / 16


def test_a_filter_on_each_clustered_column_reads_few_files(spark, tmp_path):
    """Of 64 files clustered by three columns, a value of one is looked for in less than half, as the footers tell."""
    out = tmp_path / "z"
    df = spark.range(60_000).selectExpr("pmod(hash(id, 1), 5000) a", "date_add(date'2020-01-01', int(pmod(hash(id, 2), 900))) b", "concat('c', pmod(hash(id, 3), 3000)) c")
    layout.cluster_by(df, ["a", "b", "c"], files=64).write.parquet(str(out))
    footers = [pq.ParquetFile(f).metadata.row_group(0) for f in out.glob("*.parquet")]
    assert len(footers) == 64
    for k, value in enumerate((1234, dt.date(2021, 2, 3), "c1500")):
        admitted = sum(g.column(k).statistics.min <= value <= g.column(k).statistics.max for g in footers)
        assert 0 < admitted < 32, (k, admitted)


def test_footers_answer_counts_and_bounds(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 1000, 1, 4).selectExpr("id", "if(id % 3 = 0, null, int(-id)) n", "date_add(date'1970-01-01', int(id)) day", "'x' text", "timestamp'2020-01-01' at", "int(id % 2) part")
    df.write.partitionBy("part").parquet(path)
    counted = footers.row_counts(spark, {"t": path, "again": path})
    assert rows_of(counted) == [("again", 1000), ("t", 1000)] and "PushedAggregation: [COUNT(*)]" in plan_of(counted)
    bounds = footers.column_bounds(spark, path, ["id", "n", "day"])
    assert rows_of(bounds) == [("day", 0, 999, 1000), ("id", 0, 999, 1000), ("n", -998, -1, 666)]
    assert "PushedAggregation: [MIN(id)" in plan_of(bounds)
    odd = footers.column_bounds(spark, path, ["id"], F.col("part") == 1)
    assert rows_of(odd) == [("id", 1, 999, 500)] and "PushedAggregation: [MIN(id)" in plan_of(odd)
    assert footers.column_bounds(spark, path, []).count() == 0 and footers.bounded_columns(spark, path)[:3] == ["id", "n", "day"]
    # The caller's own session reads as before.
    assert "PushedAggregation" not in plan_of(spark.read.parquet(path).agg(F.count(F.lit(1))))


def test_aggregates_from_one_pass(spark):
    rows = [(k % 7, k % 5 or None, f"s{k % 3}" if k % 4 else None, k % 6 or None, f"p{k % 6}", f"c{k % 2}", k % 9, dt.datetime(2020, 1 + k % 3, 1 + k % 4), k / 8) for k in range(400)]
    schema = "order_id long, customer_id long, state string, product_id long, product_name string, category string, quantity int, order_date timestamp_ntz, sales_amount double"
    fact = gold.fact_sales(spark.createDataFrame(rows, schema))
    assert plan_of(gold.sales_cube(fact)).count("Scan ") == 1
    cube = gold.sales_cube(fact).cache()
    made = gold.aggregates_of(cube)
    assert set(made) == set(gold.AGGREGATES)
    for name, build in gold.AGGREGATES.items():
        expected = build(fact)
        assert made[name].columns == expected.columns and rows_of(made[name]) == rows_of(expected), name
    assert [x.count() for x in gold.aggregates_of(gold.sales_cube(fact.limit(0))).values()] == [0] * 5


def test_cluster_by_spreads_a_value_that_fills_the_table(spark):
    df = spark.range(16000).repartition(8).selectExpr("1 a", "'x' b", "1L id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = layout.cluster_by(df, ["a", "b"], files=8).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and sum(r[1] for r in sizes) == 16000


def test_partitioned_write_splits_large_partitions(spark, tmp_path):
    df = spark.range(0, 200000, 1, 8).selectExpr("2024 y", "if(id % 10 = 0, 2, 1) m", "id", "uuid() u")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        layout.by_partition(df, ["y", "m"]).write.partitionBy("y", "m").parquet(str(tmp_path / "p"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128MB")
    back = spark.read.parquet(str(tmp_path / "p"))
    files = dict(back.select("m", F.input_file_name().alias("f")).groupBy("m").agg(F.count_distinct("f")).collect())
    assert back.count() == 200000 and files[1] > 1
    assert "PartitionFilters: [isnotnull(m" in plan_of(back.filter("m = 2").select("id"))


# Money, enrichment, gold


def test_money_is_exact_whatever_the_partitioning(spark):
    df = spark.range(100000).selectExpr("id % 7 k", "cast(id % 100 as double) / 100 + 1e6 v")
    got = [
        rows_of(df.repartition(n).groupBy("k").agg(money_total("v").alias("t"), average_per("v", "k").alias("a")))
        for n in (1, 7)
    ]
    assert got[0] == got[1]
    assert spark.sql("SELECT 1.005D v").agg(money_total("v")).first()[0] == 1.01
    assert spark.sql("SELECT CAST(NULL AS DOUBLE) v").agg(money_total("v")).first()[0] is None


def sales_tables(spark):
    t = "timestamp'2024-01-31 23:00:00'"
    return {
        "order_items": spark.sql(
            "SELECT * FROM VALUES (1L, 10L, 100L, 2, 1.5D), (2L, 10L, NULL, 1, 4.0D), (3L, 11L, 999L, 1, 1.0D), "
            "(4L, NULL, 100L, 1, 1.0D) AS t(order_item_id, order_id, product_id, quantity, price)"
        ),
        "orders": spark.sql(
            f"SELECT order_id, customer_id, {t} order_date, 'NEW' order_status, 9.0D total_amount, {t} created_at, "
            f"{t} updated_at FROM VALUES (10L, 1L), (11L, NULL), (12L, 1L) AS t(order_id, customer_id)"
        ),
        "customers": spark.sql("SELECT 1L customer_id, 'Ann' name, 'X' city, 'NY' state"),
        "products": spark.sql("SELECT 100L product_id, 'Pen' product_name, 'Tools' category"),
    }


@pytest.mark.parametrize("few", [False, True])
@pytest.mark.parametrize("hot", [enrich.HotKeys(), enrich.HotKeys(order_id=[10], customer_id=[1], product_id=[100])])
def test_enrichment_keeps_misses(spark, few, hot):
    t = sales_tables(spark)
    got = enrich.enrich_sales(**t, few_orders=few, hot=hot)
    assert rows_of(got.select("order_item_id", "customer_name", "product_name", "sales_amount")) == [
        (1, "Ann", "Pen", 3.0), (2, "Ann", None, 4.0), (3, None, None, 1.0),
    ]
    assert len(got.columns) == 17


def test_gold_groups_null_and_reads_dates(spark):
    sales = enrich.enrich_sales(**sales_tables(spark))
    assert rows_of(gold.revenue_by_state(sales)) == [("NY", 7.0, 1, 1), (None, 1.0, 1, 0)]
    fact = gold.fact_sales(sales)
    assert rows_of(fact.select("order_year", "order_month", "order_day").distinct()) == [(2024, 1, 31)]
    assert rows_of(reports.average_order_value(fact)) == [(2024, 1, 4.0)]
    many = spark.range(1000).selectExpr(
        "id product_id", "'p' product_name", "'c' category", "1 quantity", "1.0D * (id div 2) sales_amount"
    )
    best = reports.top_products(gold.top_products(many).withColumn("product_name", F.col("product_id").cast("string")), 3)
    assert "TakeOrderedAndProject" in plan_of(best)
    assert [r["product_name"] for r in best.collect()] == ["998", "999", "996"]


def test_affected_orders_reach_through_every_table(spark):
    t = sales_tables(spark)
    stamp = {"created_at": F.lit("2024-01-01").cast("timestamp"), "updated_at": F.lit("2024-01-01").cast("timestamp")}
    later = F.lit("2024-03-01").cast("timestamp")
    items, customers_, products = (t[n].withColumns(stamp) for n in ("order_items", "customers", "products"))
    mark = F.lit("2024-02-15").cast("timestamp")
    ids = lambda df: sorted(r["order_id"] for r in df.collect())
    assert ids(enrich.affected_orders(t["orders"], mark)) == []
    assert ids(enrich.affected_orders(t["orders"], mark, customers=customers_.withColumn("updated_at", later))) == [10, 12]
    changed = products.withColumn("updated_at", later)
    assert ids(enrich.affected_orders(t["orders"], mark, order_items=items, products=changed)) == [10]
    late = items.withColumn("created_at", F.when(F.col("order_item_id") == 3, later).otherwise(F.col("created_at")))
    assert ids(enrich.affected_orders(t["orders"], mark, order_items=late)) == [11]
    assert ids(enrich.affected_orders(t["orders"], None)) == [10, 11, 12]


def test_every_entity_has_a_total_order():
    for spec in ENTITIES.values():
        assert set(spec.order_by) == set(spec.columns) - {spec.key}


@pytest.mark.parametrize("hot", [enrich.HotKeys(), enrich.HotKeys(order_id=[10], customer_id=[1], product_id=[100])])
def test_enrichments_share_stored_items_dealt_by_order(spark, hot, tmp_path):
    """Stored items with their products give the rows of the tables themselves, also of few orders, and are not moved again."""
    t = sales_tables(spark)
    name = f"shared_{len(hot.order_id)}"
    sold = bucketed.write_bucketed(enrich.sold_items(t["order_items"], t["products"], hot=hot), name, "order_id", 4, str(tmp_path / "sold"))
    try:
        for orders in (t["orders"], t["orders"].filter("order_id = 10"), t["orders"].filter("false")):
            want = enrich.enrich_sales(t["order_items"], orders, t["customers"], t["products"], hot=hot)
            got = enrich.enrich_sales(None, orders, t["customers"], None, hot=hot, few_orders=True, sold=sold)
            assert got.columns == want.columns and rows_of(got) == rows_of(want)
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_the_refreshed_fact_ranks_items_and_orders_once(spark, monkeypatch):
    """Both loads read the same stored items and orders; the items were ranked for each load, the orders for each use."""
    from testbed import catalogue, fixtures

    made, real = [], fixtures.silver
    monkeypatch.setattr(fixtures, "silver", lambda s, d, name: (made.append(name), real(s, d, name))[1])
    fact = catalogue.refreshed_fact(spark, "/root/testdata/sf0.001")
    assert fact.count() > 0 and made.count("order_items") == made.count("products") == made.count("orders") == 1
