"""The load jobs, end to end, over delivered CSV files."""

from __future__ import annotations

import csv
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalith.plans import gold, loads, reports, upkeep
from stratalith.plans.enrich import enrich_sales
from stratalith.sources import bucketed, control
from stratalith.sources.metadata import create_namespace, setup_check
from stratalith.sources.keyed import KeyedTable, MissingTable
from stratalith.sources.tables import Store
from stratalith.spec import ENTITIES, Layout

FIRST = {
    "customers": [
        ("1", " Ann ", "new york", "ny ", "2023-01-01", "2023-01-01 00:00:00", "2023-01-02 00:00:00"),
        ("2", "Bob", " york-city", "ca", "2023-01-03", "2023-01-03 00:00:00", "2023-01-03 00:00:00"),
        ("x9", "Bad key", "a", "b", "2023-01-03", "2023-01-03 00:00:00", "2023-01-03 00:00:00"),
        ("", "No key", "a", "b", "2023-01-03", "2023-01-03 00:00:00", "2023-01-03 00:00:00"),
        ("3", "No mark", "a", "b", "2023-01-03", "2023-01-03 00:00:00", "soon"),
    ],
    "products": [
        ("10", "Pen", "office tools", "1.5", "2023-01-01 00:00:00", "2023-01-01 00:00:00"),
        ("11", "Ink", "office tools", "oops", "2023-01-01 00:00:00", "2023-01-01 00:00:00"),
    ],
    "orders": [
        ("100", "1", "2023-02-01 10:00:00", " new ", "30.0", "2023-02-01 10:00:00", "2023-02-01 10:00:00"),
        ("100", "1", "2023-02-01 10:00:00", " paid ", "30.0", "2023-02-01 10:00:00", "2023-02-01 11:00:00"),
        ("101", "", "2023-02-03 09:00:00", "new", "5", "2023-02-03 09:00:00", "2023-02-03 09:00:00"),
        ("102", "2", "2023-03-03 09:00:00", "new", "7", "2023-03-03 09:00:00", "2023-03-03 09:00:00"),
    ],
    "order_items": [
        ("1000", "100", "10", "2", "1.5", "2023-02-01 10:00:00", "2023-02-01 10:00:00"),
        ("1001", "100", "11", "3", "9.0", "2023-02-01 10:00:00", "2023-02-01 10:00:00"),
        ("1002", "101", "12", "1", "5.0", "2023-02-03 09:00:00", "2023-02-03 09:00:00"),
    ],
}
# A later delivery repeats everything and adds changes.
SECOND = {
    "customers": [("2", "Bob B", "boston", "ma", "2023-01-03", "2023-01-03 00:00:00", "2023-05-01 00:00:00")],
    "products": [("12", "Cap", "hats", "5.0", "2023-05-01 00:00:00", "2023-05-01 00:00:00")],
    "orders": [
        ("101", "2", "2023-02-03 09:00:00", "paid", "5", "2023-02-03 09:00:00", "2023-05-02 00:00:00"),
        ("103", "1", "2023-05-02 09:00:00", "new", "8", "2023-05-02 09:00:00", "2023-05-02 09:00:00"),
    ],
    "order_items": [
        ("1003", "103", "12", "4", "2.0", "2023-05-02 09:00:00", "2023-05-02 09:00:00"),
        ("1001", "103", "11", "3", "9.0", "2023-02-01 10:00:00", "2023-05-02 09:00:00"),
    ],
}


def deliver(folder, *batches) -> None:
    for name, spec in ENTITIES.items():
        with open(folder / f"{name}.csv", "w", newline="") as f:
            out = csv.writer(f)
            out.writerow(spec.columns)
            for batch in batches:
                out.writerows(batch[name])


def open_store(spark, folder, prefix="") -> Store:
    """A store whose names in the catalog are its own."""
    specs = {n: replace(s, source_path=str(folder / f"{n}.csv")) for n, s in ENTITIES.items()}
    names = {layer: f"{prefix}{layer}" for layer in ("bronze", "silver", "gold", "control")}
    return Store(spark, Layout(root=str(folder / "store"), specs=specs, buckets=3, **names))


def bytes_in(folder) -> int:
    return sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())


def fact_files(folder) -> set[tuple[str, str]]:
    """Month and name of each file."""
    return {(f"{p.parent.parent.name}/{p.parent.name}", p.name) for p in folder.rglob("*.parquet")}


def mark_of(wh, name):
    row = wh.control.marks().filter(F.col("table_name") == name).first()
    return None if row is None else (row["last_run_ts"].isoformat(sep=" "), row["status"])


def load_all(wh) -> dict[str, loads.Outcome]:
    """Bronze, silver and enrichment."""
    done = {f"bronze.{t}": o for t, o in loads.run_layer(loads.load_bronze, wh).items()}
    done |= {f"silver.{t}": o for t, o in loads.run_layer(loads.load_silver, wh).items()}
    return done | {"silver.sales_enriched": loads.load_enriched(wh)}


@pytest.fixture(scope="module")
def story(spark, tmp_path_factory):
    """Two deliveries and one with nothing new; the facts each step left behind."""
    folder = tmp_path_factory.mktemp("story")
    wh = open_store(spark, folder)
    loads.setup(wh)
    loads.setup(wh)
    seen = {"seeds": rows_of(wh.control.marks().select("table_name", "status"))}
    deliver(folder, FIRST)
    seen["one"] = load_all(wh)
    seen["one_fact"] = loads.load_fact(wh)
    seen["one_files"] = fact_files(folder / "store/gold/fact_sales")
    seen["one_enriched"] = rows_of(wh.current("silver", "sales_enriched").select("order_item_id", "order_id", "order_status"))
    deliver(folder, FIRST, SECOND)
    seen["two"] = loads.run_all(wh)
    seen["two_files"] = fact_files(folder / "store/gold/fact_sales")
    seen["marks_two"] = rows_of(wh.control.marks().select("table_name", "last_run_ts", "status"))
    seen["three"] = load_all(wh)
    seen["marks_three"] = rows_of(wh.control.marks().select("table_name", "last_run_ts", "status"))
    return wh, seen


def test_setup_is_repeatable(story, spark):
    wh, seen = story
    assert seen["seeds"] == [(t, "INIT") for t in sorted(ENTITIES)]
    loads.publish(wh, [])
    control_tables = ["pipeline_watermark", "pipeline_run_log"]
    found = setup_check(spark, ["bronze", "silver", "gold"], "control", control_tables, wh.control.marks()).collect()
    assert [tuple(r)[:2] for r in found[:5]] == [
        ("SCHEMAS", "bronze"), ("SCHEMAS", "gold"), ("SCHEMAS", "silver"),
        ("TABLE", "pipeline_run_log"), ("TABLE", "pipeline_watermark"),
    ]
    assert {r["status"] for r in found[:5]} == {"EXISTS"} and len(found) == 5 + 9
    assert spark.sql("SELECT 1 FROM control.pipeline_watermark").count() == 9
    assert spark.sql("SELECT 1 FROM control.pipeline_run_log ORDER BY run_start_ts DESC").columns == ["1"]


def test_tables_are_readable_by_name(story, spark):
    """The dashboard and check queries, as SQL over the published tables."""
    wh, _ = story
    assert len(loads.publish(wh)) == 4 + 1 + 8 + 2
    for layer, table in [("bronze", "orders_raw"), ("silver", "orders"), ("silver", "customers_rejects"),
                         ("silver", "sales_enriched"), ("gold", "fact_sales")]:
        named = spark.table(f"{layer}.{table}")
        read = wh.rows(layer, table) if wh.is_keyed(layer, table) else wh.current(layer, table)
        assert rows_of(named) == rows_of(read.select(*named.columns)), table
    by_report = {
        reports.revenue_by_state: ("agg_revenue_by_state", """
            SELECT state, total_revenue, total_orders, total_customers FROM gold.agg_revenue_by_state
            ORDER BY total_revenue DESC"""),
        reports.top_products: ("agg_top_products", """
            SELECT product_name, category, units_sold, revenue FROM gold.agg_top_products
            ORDER BY revenue DESC LIMIT 10"""),
        reports.daily_trend: ("agg_daily_sales", """
            SELECT order_date_only AS sales_date, daily_revenue, daily_orders, daily_customers
            FROM gold.agg_daily_sales ORDER BY sales_date"""),
        reports.monthly_trend: ("agg_monthly_sales", """
            SELECT order_year, order_month, monthly_revenue, monthly_orders, monthly_customers
            FROM gold.agg_monthly_sales ORDER BY order_year, order_month"""),
        reports.category_revenue: ("agg_category_sales", """
            SELECT category, category_revenue, units_sold FROM gold.agg_category_sales
            ORDER BY category_revenue DESC"""),
        reports.average_order_value: ("fact_sales", """
            SELECT order_year, order_month,
                   round(sum(sales_amount) / count(DISTINCT order_id), 2) AS avg_order_value
            FROM gold.fact_sales GROUP BY order_year, order_month ORDER BY order_year, order_month"""),
    }
    for report, (table, text) in by_report.items():
        assert [tuple(r) for r in report(wh.current("gold", table)).collect()] == [tuple(r) for r in spark.sql(text).collect()]
    assert spark.sql("SELECT order_id, COUNT(1) AS cnt FROM silver.orders GROUP BY order_id HAVING COUNT(1) > 1").isEmpty()


def test_bronze_takes_each_row_once(story):
    wh, seen = story
    assert [seen["one"][f"bronze.{t}"].rows for t in ENTITIES] == [4, 2, 4, 3]
    assert [seen["two"][f"bronze.{t}"].rows for t in ENTITIES] == [1, 1, 2, 2]
    assert [seen["three"][f"bronze.{t}"].rows for t in ENTITIES] == [0, 0, 0, 0]
    assert wh.current("bronze", "orders_raw").count() == 6
    bad = wh.rows("bronze", "customers_raw").filter("rejected = 1")
    assert {r["rejected_value"] for r in bad.collect()} == {"soon"}
    names = {r[0].rsplit("/", 1)[1] for r in wh.current("bronze", "orders_raw").select("source_file_name").collect()}
    assert names == {"orders.csv"}


def test_silver_holds_latest_clean_rows(story):
    wh, seen = story
    assert rows_of(wh.current("silver", "customers").select("customer_id", "name", "city", "state")) == [
        (1, "Ann", "New York", "NY"), (2, "Bob B", "Boston", "MA"),
    ]
    assert rows_of(wh.current("silver", "products").select("product_id", "category", "price")) == [
        (10, "Office Tools", 1.5), (11, "Office Tools", None), (12, "Hats", 5.0),
    ]
    assert rows_of(wh.current("silver", "orders").select("order_id", "order_status")) == [
        (100, "PAID"), (101, "PAID"), (102, "NEW"), (103, "NEW"),
    ]
    kept = wh.current("silver", "customers_rejects")
    assert rows_of(kept.select("customer_id", "reject_reason")) == [("x9", "unreadable key"), (None, "missing key")]
    assert seen["one"]["silver.customers"].message == "rows_in=4 rows_rejected=2 rows_out=2"


def test_increment_equals_rebuild(story):
    wh, seen = story
    now = {t: wh.current("silver", t) for t in ENTITIES}
    full = enrich_sales(now["order_items"], now["orders"], now["customers"], now["products"])
    kept = wh.current("silver", "sales_enriched").select(*full.columns)
    # Item 1001 moved from order 100 to 103; the unchanged order 100 keeps only item 1000.
    assert rows_of(kept) == rows_of(full)
    assert seen["one_enriched"] == [(1000, 100, "PAID"), (1001, 100, "PAID"), (1002, 101, "NEW")]
    assert [seen[k]["silver.sales_enriched"].rows for k in ("one", "two", "three")] == [3, 3, 0]


def test_empty_delivery_keeps_marks(story):
    _, seen = story
    assert seen["marks_three"] == seen["marks_two"]
    assert all(status == "SUCCESS" for _, _, status in seen["marks_two"])
    assert len(seen["marks_two"]) == 9


def test_gold_follows_the_fact(story):
    wh, seen = story
    fact = wh.current("gold", "fact_sales")
    assert fact.count() == 4 and {"gold_run_id", "gold_load_ts", "order_year"} <= set(fact.columns)
    for name, build in gold.AGGREGATES.items():
        stored = wh.current("gold", name).drop("gold_run_id", "gold_load_ts")
        assert rows_of(stored) == rows_of(build(fact).select(*stored.columns)), name
    assert rows_of(wh.current("gold", "dim_customers").select("customer_id", "name")) == [(1, "Ann"), (2, "Bob B")]
    best = reports.top_products(wh.current("gold", "agg_top_products"), 1).first()
    assert (best["product_name"], best["revenue"]) == ("Ink", 27.0)
    plan = fact.filter("order_year = 2023 AND order_month = 5")._jdf.queryExecution().executedPlan().toString()
    scans = [part.split("PushedFilters")[0] for part in plan.split("PartitionFilters")[1:]]
    assert any("order_year" in s and "order_month" in s for s in scans), plan


def test_the_fact_is_refreshed_by_month(story):
    """The second delivery changes an order of February and adds one in May; an item leaves February."""
    wh, seen = story
    assert seen["one_fact"].message.startswith("fact_sales built") and seen["two"]["gold.fact_sales"].message.startswith("months_written=2 months_emptied=0")
    assert {month for month, _ in seen["one_files"]} == {"order_year=2023/order_month=2"}
    assert {month for month, _ in seen["two_files"]} == {"order_year=2023/order_month=2", "order_year=2023/order_month=5"}
    assert loads.load_fact(wh).message.startswith("no changed months")
    assert seen["two_files"] == fact_files(Path(wh.path("gold", "fact_sales")))


def test_run_log_and_mark_reports(story):
    wh, _ = story
    log = wh.control.run_log()
    assert log.filter("run_status <> 'SUCCESS'").count() == 0
    latest = reports.recent_runs(log, ("GOLD",), 20).collect()
    assert len(latest) >= 9 and latest[0]["run_start_ts"] >= latest[-1]["run_start_ts"]
    names = [r["table_name"] for r in reports.mark_state(wh.control.marks(), "silver\\_%").collect()]
    assert names == sorted(f"silver_{t}" for t in [*ENTITIES, "sales_enriched"])


def test_time_travel_on_stored_tables(story):
    wh, _ = story
    orders = wh.keyed("orders")
    assert rows_of(orders.as_of_version(0).select("order_id", "order_status")) == [(100, "PAID"), (101, "NEW"), (102, "NEW")]
    assert rows_of(orders.as_of_version(1)) == rows_of(orders.current())
    told = orders.history().orderBy("version").collect()
    assert [(r["version"], r["rows_written"]) for r in told] == [(0, 3), (1, 2)]
    assert orders.as_of_timestamp(F.lit(told[0]["commit_ts"])).count() == 3
    plan = orders.as_of_version(0)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Window", "Exchange", "Sort "))
    with pytest.raises(LookupError, match="is not kept"):
        orders.as_of_version(7)
    with pytest.raises(LookupError, match="no version that old is kept"):
        orders.as_of_timestamp(F.current_timestamp() - F.expr("INTERVAL 1 DAY"))


def test_merges_leave_the_stored_table_where_it_lies(story, spark):
    """Of a merge into a silver table only the batch is shuffled."""
    wh, _ = story
    table = wh.keyed("orders")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = bucketed.upsert_bucketed(table.rows(), table.rows().limit(2), "order_id", table.buckets)
        plan = made._jdf.queryExecution().executedPlan().toString()
        joined = table.rows().join(table.rows().select("order_id"), "order_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Bucketed: true" in plan and "Exchange" not in joined


def test_upkeep_keeps_the_rows(spark, tmp_path):
    wh = open_store(spark, tmp_path, "kept_")
    loads.setup(wh)
    deliver(tmp_path, FIRST)
    loads.run_all(wh)
    deliver(tmp_path, FIRST, SECOND)
    loads.run_all(wh)
    tables = [("kept_bronze", "customers_raw"), ("kept_silver", "orders"), ("kept_gold", "fact_sales"), ("kept_gold", "dim_customers")]
    plain = {t: upkeep.CLUSTERING[(t[0].removeprefix("kept_"), t[1])] for t in tables}
    before = {t: rows_of(wh.rows(*t).select(*sorted(wh.rows(*t).columns))) for t in tables}
    done = upkeep.optimize(wh, plain)
    assert all(isinstance(o, loads.Outcome) for o in done.values()), done
    assert done["kept_silver.orders"].message == "kept in buckets by order_id"
    assert {t: rows_of(wh.rows(*t).select(*sorted(wh.rows(*t).columns))) for t in tables} == before

    # Nothing is old yet; later the rows that the second load replaced are.
    orders = wh.keyed("orders")
    assert upkeep.vacuum(wh, tables)["kept_silver.orders"].rows == 0 and orders.closed().count() == 1
    later = F.current_timestamp() + F.expr("INTERVAL 200 HOURS")
    current, size = rows_of(orders.current()), bytes_in(tmp_path / "store/kept_silver/orders")
    done = upkeep.vacuum(wh, tables, now=later)
    assert done["kept_silver.orders"].rows == 1 and done["kept_bronze.customers_raw"].rows == 0
    assert bytes_in(tmp_path / "store/kept_silver/orders") < size and orders.closed().count() == 0
    assert rows_of(orders.current()) == current == rows_of(orders.as_of_version(1))
    assert [r["version"] for r in orders.history().collect()] == [1]
    with pytest.raises(LookupError, match="version 0 is not kept"):
        orders.as_of_version(0)

    # Loads go on after upkeep.
    late = {n: [] for n in ENTITIES} | {
        "orders": [("104", "1", "2023-06-01", "new", "1", "2023-06-01 00:00:00", "2023-06-01 00:00:00")]
    }
    deliver(tmp_path, FIRST, SECOND, late)
    loads.run_layer(loads.load_bronze, wh)
    loads.run_layer(loads.load_silver, wh)
    assert orders.current().count() == 5 and orders.as_of_version(1).count() == 4

    # Changed orders without items still move the mark.
    assert loads.load_enriched(wh).rows == 0
    assert mark_of(wh, "silver_sales_enriched") == ("2023-06-01 00:00:00", "SUCCESS")
    assert reports.recent_runs(wh.control.run_log(), ("OPTIMIZE", "VACUUM"), 30).count() == 12


def test_upkeep_errors(spark, tmp_path):
    wh = open_store(spark, tmp_path, "none_")
    missing = {("none_gold", "dim_products"): ("product_id",)}
    assert isinstance(upkeep.optimize(wh, missing)["none_gold.dim_products"], MissingTable)
    assert wh.control.run_log().first()["run_status"] == "FAILED"
    with pytest.raises(MissingTable):
        upkeep.optimize(wh, missing, on_error="raise")


def test_failed_load_keeps_mark_and_is_repeatable(spark, tmp_path, monkeypatch):
    wh = open_store(spark, tmp_path, "failed_")
    bronze = "failed_bronze"
    loads.setup(wh)
    deliver(tmp_path, FIRST)
    loads.load_bronze(wh, "orders")
    before = mark_of(wh, "orders")[0]
    deliver(tmp_path, FIRST, SECOND)
    write = Store.overwrite

    def dies(self, *args, **kwargs):
        write(self, *args, **kwargs)
        raise OSError("lost after writing")

    monkeypatch.setattr(Store, "overwrite", dies)
    with pytest.raises(OSError):
        loads.load_bronze(wh, "orders")
    assert mark_of(wh, "orders") == (before, "FAILED")
    assert wh.control.run_log().filter("run_status = 'FAILED'").first()["message"] == "lost after writing"

    # The rows are there, the mark is not: the next load takes none twice and moves the mark.
    monkeypatch.setattr(Store, "overwrite", write)
    assert loads.load_bronze(wh, "orders").rows == 0
    assert wh.current(bronze, "orders_raw").count() == 6
    assert mark_of(wh, "orders") == ("2023-05-02 09:00:00", "SUCCESS")

    late = {n: [] for n in ENTITIES} | {
        "orders": [("104", "1", "2023-06-01", "new", "1", "2023-06-01 00:00:00", "2023-06-01 00:00:00")]
    }
    deliver(tmp_path, FIRST, SECOND, late)
    move = control.mark_success
    monkeypatch.setattr(control, "mark_success", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        loads.load_bronze(wh, "orders")
    monkeypatch.setattr(control, "mark_success", move)
    assert wh.current(bronze, "orders_raw").count() == 7
    assert loads.load_bronze(wh, "orders").rows == 0
    assert mark_of(wh, "orders") == ("2023-06-01 00:00:00", "SUCCESS")
    assert wh.current(bronze, "orders_raw").count() == 7


@pytest.mark.parametrize("step", ["closed", "commit", "open", "rename"])
def test_a_merge_that_was_cut_off_is_repeated(spark, tmp_path, monkeypatch, step):
    """Wherever a merge stops, the table is as before or as after it, and repeating it gives the same."""
    create_namespace(spark, "cut", "for a test")
    table = KeyedTable(spark, f"cut.t_{step}", str(tmp_path / "t"), "id", 3)
    rows = lambda *r: spark.createDataFrame(list(r), "id long, x string")
    table.upsert(rows((1, "a"), (2, "a")))
    batch = rows((2, "b"), (3, "b"))

    def stop(*args, **kwargs):
        raise OSError("cut off")

    with monkeypatch.context() as cut:
        if step == "closed":
            cut.setattr(bucketed, "upsert_bucketed", stop)
        elif step == "commit":
            cut.setattr(KeyedTable, "_replace", stop)
        elif step == "open":
            cut.setattr(bucketed, "write_dealt", stop)
        else:
            said = spark.sql
            cut.setattr(type(spark), "sql", lambda self, text, *a, **k: stop() if "RENAME" in text else said(text, *a, **k))
        with pytest.raises(OSError):
            table.upsert(batch)
    seen = rows_of(table.current())
    assert seen == ([(1, "a"), (2, "a")] if step != "rename" else [(1, "a"), (2, "b"), (3, "b")])
    table.upsert(batch)
    assert rows_of(table.current()) == [(1, "a"), (2, "b"), (3, "b")]
    assert rows_of(table.as_of_version(0)) == [(1, "a"), (2, "a")]
    assert rows_of(table.as_of_version(table.version())) == rows_of(table.current())


def test_keyed_tables_take_new_columns_and_nothing(spark, tmp_path):
    create_namespace(spark, "cols", "for a test")
    table = KeyedTable(spark, "cols.t", str(tmp_path / "t"), "id", 2)
    with pytest.raises(MissingTable):
        table.rows()
    assert table.upsert(spark.createDataFrame([], "id long, x string")) == 0 and not table.exists()
    table.upsert(spark.createDataFrame([(1, "a"), (2, "a")], "id long, x string"))
    table.upsert(spark.createDataFrame([(2, 7)], "id long, y int"))
    assert rows_of(table.current().select("id", "x", "y")) == [(1, "a", None), (2, None, 7)]
    assert rows_of(table.as_of_version(0).select("id", "x", "y")) == [(1, "a", None), (2, "a", None)]
    assert table.upsert(spark.createDataFrame([], "id long, x string")) == 0 and table.version() == 1
    assert rows_of(table.changed_since(0).select("id", "x")) == [(2, "a"), (2, None)]
