"""Every registered query: a callable over ``(spark, sf_dir)`` that returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratalith.operators import clean as cleaning, constraints, distinct, incremental, intervals, joins, layout, upsert, versions
from stratalith.operators.clean import parse_timestamps, rejects
from stratalith.plans import enrich, gold, refresh, reports
from stratalith.sources import bucketed, control, footers
from stratalith.sources.files import new_folder, stored
from stratalith.sources.metadata import register_views
from stratalith.spec import CUSTOMERS, ENTITIES
from testbed import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MARK = "2000-01-01 00:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, the type the test tables use."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


# Cleaning and deduplication ---------------------------------------------------------------


@query
def clean_customers(spark: SparkSession, d: str) -> DataFrame:
    return fx.cleaned(spark, d, "customers")


@query
def clean_products(spark: SparkSession, d: str) -> DataFrame:
    return fx.cleaned(spark, d, "products")


@query
def clean_orders(spark: SparkSession, d: str) -> DataFrame:
    return fx.cleaned(spark, d, "orders")


@query
def clean_order_items(spark: SparkSession, d: str) -> DataFrame:
    return fx.cleaned(spark, d, "order_items")


@query
def clean_rejects(spark: SparkSession, d: str) -> DataFrame:
    return rejects(fx.raw(spark, d, "customers"), CUSTOMERS)


def _orders_as_text(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose timestamps arrive as text, some of them unreadable."""
    return fx.raw(spark, d, "orders").select(
        "order_id",
        "order_status",
        F.col("order_date").cast("string").alias("order_date"),
        F.expr("CASE WHEN order_id % 11 = 3 THEN 'unknown' ELSE cast(updated_at as string) END").alias("updated_at"),
    )


@query
def standardize_timestamps(spark: SparkSession, d: str) -> DataFrame:
    text = _orders_as_text(spark, d)
    return without_zone(parse_timestamps(text, ["order_date", "created_at", "updated_at"]))


@query
def dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    return fx.latest(fx.raw(spark, d, "order_items"), ENTITIES["order_items"])


# Enrichment and reporting tables ------------------------------------------------------------


@query
def sales_enriched(spark: SparkSession, d: str) -> DataFrame:
    return fx.enriched(spark, d)


@query
def dim_customers(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_customers(fx.cleaned(spark, d, "customers"))


@query
def dim_products(spark: SparkSession, d: str) -> DataFrame:
    return gold.dim_products(fx.cleaned(spark, d, "products"))


@query
def fact_sales(spark: SparkSession, d: str) -> DataFrame:
    return gold.fact_sales(fx.enriched(spark, d))


@query
def partitioned_fact(spark: SparkSession, d: str) -> DataFrame:
    return layout.by_partition(gold.fact_sales(fx.enriched(spark, d)), gold.FACT_PARTITIONS)


@query
def revenue_by_state(spark: SparkSession, d: str) -> DataFrame:
    return gold.revenue_by_state(fx.enriched(spark, d))


@query
def top_products_agg(spark: SparkSession, d: str) -> DataFrame:
    return gold.top_products(fx.enriched(spark, d))


@query
def daily_sales(spark: SparkSession, d: str) -> DataFrame:
    return gold.daily_sales(fx.enriched(spark, d))


@query
def monthly_sales(spark: SparkSession, d: str) -> DataFrame:
    return gold.monthly_sales(fx.enriched(spark, d))


@query
def category_sales(spark: SparkSession, d: str) -> DataFrame:
    return gold.category_sales(fx.enriched(spark, d))


@query
def daily_parts(spark: SparkSession, d: str) -> DataFrame:
    """Mergeable parts of every day: how many ids each bitmap holds, and the amount."""
    parts = gold.daily_parts(fx.enriched(spark, d))
    return parts.select("order_date_only", "counted", "bucket", F.bitmap_count("members").alias("ids"), F.col("amount").cast("double").alias("amount"))


@query
def revenue_by_state_from_parts(spark: SparkSession, d: str) -> DataFrame:
    return gold.revenue_by_state_of(gold.sales_parts(fx.enriched(spark, d), "state"))


@query
def daily_sales_from_parts(spark: SparkSession, d: str) -> DataFrame:
    return gold.daily_sales_of(gold.daily_parts(fx.enriched(spark, d)))


@query
def monthly_sales_from_parts(spark: SparkSession, d: str) -> DataFrame:
    """Months from the stored parts of their days; the sales are read once, for the days."""
    return gold.monthly_sales_of(stored(gold.daily_parts(fx.enriched(spark, d)), "daily-parts"))


@query
def sales_from_merged_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Parts that two deliveries of items made by themselves, merged: an order that both hold counts once."""
    sales = fx.enriched(spark, d)
    both = [gold.sales_parts(sales.filter(F.pmod("order_item_id", F.lit(2)) == k), "state") for k in (0, 1)]
    return gold.revenue_by_state_of(distinct.merged(both[0].unionByName(both[1]), {"state": F.col("state")}))


@query
def aggregates_in_one_scan(spark: SparkSession, d: str) -> DataFrame:
    """All five aggregates from one stored pass over the fact, one below the other."""
    made = gold.aggregates_of(stored(gold.sales_cube(gold.fact_sales(fx.enriched(spark, d))), "sales-cube"))
    out = None
    for name, table in made.items():
        part = table.withColumn("aggregate", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


# Reports ------------------------------------------------------------------------------------


@query
def report_revenue_by_state(spark: SparkSession, d: str) -> DataFrame:
    return reports.revenue_by_state(revenue_by_state(spark, d))


@query
def report_top10_products(spark: SparkSession, d: str) -> DataFrame:
    return reports.top_products(top_products_agg(spark, d), 10)


@query
def report_daily_trend(spark: SparkSession, d: str) -> DataFrame:
    return reports.daily_trend(daily_sales(spark, d))


@query
def report_monthly_trend(spark: SparkSession, d: str) -> DataFrame:
    return reports.monthly_trend(monthly_sales(spark, d))


@query
def report_category_revenue(spark: SparkSession, d: str) -> DataFrame:
    return reports.category_revenue(category_sales(spark, d))


@query
def report_avg_order_value(spark: SparkSession, d: str) -> DataFrame:
    return reports.average_order_value(gold.fact_sales(fx.enriched(spark, d)))


@query
def sql_category_revenue(spark: SparkSession, d: str) -> DataFrame:
    """A report written in SQL over the named table."""
    register_views({"stratalith_fact_sales": gold.fact_sales(fx.enriched(spark, d))})
    return spark.sql("""
        SELECT category, CAST(round(sum(CAST(sales_amount AS DECIMAL(24,6))), 2) AS DOUBLE) AS category_revenue,
               sum(quantity) AS units_sold
        FROM stratalith_fact_sales GROUP BY category ORDER BY category_revenue DESC""")


# Merges -------------------------------------------------------------------------------------


@query
def merge_insert_only(spark: SparkSession, d: str) -> DataFrame:
    return upsert.insert_missing(*fx.merge_sides(spark, d), "order_id")


@query
def merge_partial_update(spark: SparkSession, d: str) -> DataFrame:
    return upsert.merge_columns(
        *fx.merge_sides(spark, d),
        "order_id",
        update={"order_status": "order_status", "updated_at": "updated_at"},
        insert={c: c for c in ("order_id", "order_status", "created_at", "updated_at")},
    )


@query
def merge_upsert_all(spark: SparkSession, d: str) -> DataFrame:
    return upsert.upsert(*fx.merge_sides(spark, d), "order_id", check=True)


@query
def merge_upsert_newer(spark: SparkSession, d: str) -> DataFrame:
    """Rows that are older than what is there replace nothing."""
    return upsert.upsert(*fx.merge_sides(spark, d), "order_id", only_if_newer="updated_at", null_keys=True)


def _bucketed_target(spark: SparkSession, target: DataFrame) -> DataFrame:
    path = new_folder(spark, "bucketed")
    return bucketed.write_bucketed(target, "stratalith_" + path.rsplit("-", 1)[-1], "order_id", fx.BUCKETS, path)


@query
def merge_upsert_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The merge into a table that is stored in buckets by its key: only the batch is moved."""
    target, source = fx.merge_sides(spark, d)
    return bucketed.upsert_bucketed(_bucketed_target(spark, target), source, "order_id", fx.BUCKETS, check=True)


@query
def merge_upsert_bucketed_newer(spark: SparkSession, d: str) -> DataFrame:
    target, source = fx.merge_sides(spark, d)
    return bucketed.upsert_bucketed(_bucketed_target(spark, target), source, "order_id", fx.BUCKETS, only_if_newer="updated_at")


@query
def conditional_update(spark: SparkSession, d: str) -> DataFrame:
    late = (F.col("order_status") == "O") & (F.col("updated_at") < fx.ntz("1998-01-01 00:00:00"))
    return upsert.update_where(
        fx.silver(spark, d, "orders"),
        late,
        {"order_status": F.lit("LATE"), "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAY")},
    )


# Increments ---------------------------------------------------------------------------------


@query
def incremental_filter(spark: SparkSession, d: str) -> DataFrame:
    return incremental.newer_than(fx.raw(spark, d, "orders"), "updated_at", fx.ntz(MARK))


@query
def incremental_chosen_column(spark: SparkSession, d: str) -> DataFrame:
    """The same with another mark column, as configured."""
    spec = replace(ENTITIES["orders"], watermark_col="created_at")
    return incremental.newer_than(fx.raw(spark, d, "orders"), spec.watermark_col, fx.ntz(MARK))


@query
def unmarked_rows(spark: SparkSession, d: str) -> DataFrame:
    parsed = parse_timestamps(_orders_as_text(spark, d), ["order_date", "updated_at"])
    return without_zone(incremental.unmarked(parsed, "updated_at"))


@query
def next_watermark(spark: SparkSession, d: str) -> DataFrame:
    tagged = fx.cleaned(spark, d, "orders").withColumn("batch", fx.batch_number())
    return incremental.next_mark(tagged, enrich.CLOCKS, fx.ntz(incremental.FIRST_MARK), by=["batch"])


def _marks(spark: SparkSession, d: str) -> DataFrame:
    """A control table after one successful load of every entity."""
    loaded = None
    for name in ENTITIES:
        top = fx.raw(spark, d, name).agg(F.max("updated_at").cast("timestamp").alias("last_run_ts"))
        row = top.select(
            F.lit(name).alias("table_name"),
            "last_run_ts",
            F.lit("run-1").alias("last_run_id"),
            F.lit("SUCCESS").alias("status"),
            F.lit("2024-01-01 06:00:00").cast("timestamp").alias("updated_at"),
        )
        loaded = row if loaded is None else loaded.unionByName(row)
    return loaded


@query
def last_watermark(spark: SparkSession, d: str) -> DataFrame:
    marks, out = _marks(spark, d), None
    for name in [*ENTITIES, "never_loaded"]:
        one = incremental.stored_mark(marks, name).select(F.lit(name).alias("table_name"), "last_run_ts")
        out = one if out is None else out.unionByName(one)
    return without_zone(out)


def _worked_marks(spark: SparkSession, d: str) -> DataFrame:
    now = F.lit("2024-01-01 07:00:00").cast("timestamp")
    marks = control.seed_marks(control.empty(spark, control.WATERMARK), control.seeds(spark, ENTITIES, now))
    marks = control.mark_running(marks, control.names(spark, "orders", "silver_orders"), now)
    marks = control.mark_success(marks, _marks(spark, d).filter("table_name <> 'orders'"))
    return control.checked(control.mark_failed(marks, "products", now))


@query
def mark_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    """Seeds, two loads that start, one success per other entity, and a later failure."""
    return without_zone(reports.mark_state(_worked_marks(spark, d)))


@query
def silver_marks(spark: SparkSession, d: str) -> DataFrame:
    """Marks whose name is like a pattern; the bare ``_`` stands for any letter."""
    return without_zone(reports.mark_state(_worked_marks(spark, d), "%ord_r%"))


@query
def changed_orders(spark: SparkSession, d: str) -> DataFrame:
    return incremental.changed_since(fx.silver(spark, d, "orders"), fx.ntz(MARK))


@query
def affected_orders(spark: SparkSession, d: str) -> DataFrame:
    return enrich.affected_orders(
        fx.silver(spark, d, "orders"),
        fx.ntz("1996-01-01 00:00:00"),
        order_items=fx.silver(spark, d, "order_items"),
        customers=fx.silver(spark, d, "customers"),
        products=fx.silver(spark, d, "products"),
    )


@query
def semi_join_items(spark: SparkSession, d: str) -> DataFrame:
    return joins.only_keys_of(fx.silver(spark, d, "order_items"), changed_orders(spark, d), "order_id")


@query
def incremental_enriched(spark: SparkSession, d: str) -> DataFrame:
    return fx.enriched(spark, d, orders=changed_orders(spark, d), few_orders=True)


# Checks -------------------------------------------------------------------------------------


@query
def row_counts(spark: SparkSession, d: str) -> DataFrame:
    # Two columns of the enriched sales are enough to count them and the fact that is made of them.
    sales = stored(fx.enriched(spark, d).select("order_item_id", "order_date"), "counted")
    tables = {f"brz_{n}_raw": fx.raw(spark, d, n) for n in ENTITIES}
    tables |= {f"slv_{n}": fx.silver(spark, d, n) for n in ENTITIES}
    return constraints.row_counts(tables | {"slv_sales_enriched": sales, "gld_fact_sales": gold.fact_sales(sales)})


@query
def file_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every stored table, from the footers of its files."""
    return footers.row_counts(spark, {t: f"{d}/{t}.parquet" for t in fx.TABLES})


@query
def file_column_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Least and greatest key of every stored table, from the footers of its files."""
    out = None
    for table, cols in fx.KEYS.items():
        part = footers.column_bounds(spark, f"{d}/{table}.parquet", cols).select(F.lit(table).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for name, spec in ENTITIES.items():
        found = constraints.repeated_keys(fx.cleaned(spark, d, name), spec.key)
        part = found.select(F.lit(name).alias("table_name"), F.col(spec.key).alias("key"), "cnt")
        out = part if out is None else out.unionByName(part)
    return out


@query
def cast_failures(spark: SparkSession, d: str) -> DataFrame:
    """Values of every entity and column that are no value of the column's type."""
    out = None
    for name, spec in ENTITIES.items():
        found = cleaning.cast_failures(fx.as_text(spark, d, name), spec)
        part = found.select(F.lit(name).alias("table_name"), "column_name", "failed")
        out = part if out is None else out.unionByName(part)
    return out


@query
def check_constraint(spark: SparkSession, d: str) -> DataFrame:
    return constraints.violations(
        fx.cleaned(spark, d, "orders"), constraints.allowed_values("order_status", ["O", "F", "P"])
    )


def _run_log(spark: SparkSession, d: str) -> DataFrame:
    """One run per order day and status, as if each day had been processed by itself."""
    days = fx.read(spark, d, "orders").groupBy("o_orderdate", "o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"))
    return days.selectExpr(
        "o_orderstatus || '-' || cast(cast(o_orderdate as date) as string) AS run_id",
        "CASE o_orderstatus WHEN 'F' THEN 'GOLD' WHEN 'O' THEN 'OPTIMIZE' ELSE 'VACUUM' END AS layer_name",
        "'orders' AS table_name",
        "'SUCCESS' AS run_status",
        "row_count",
        "o_orderdate AS run_start_ts",
    )


@query
def recent_runs(spark: SparkSession, d: str) -> DataFrame:
    return reports.recent_runs(_run_log(spark, d), ("GOLD",), 20)


@query
def recent_layout_runs(spark: SparkSession, d: str) -> DataFrame:
    return reports.recent_runs(_run_log(spark, d), ("OPTIMIZE", "VACUUM"), 30)


# Versions and layout ------------------------------------------------------------------------


@query
def as_of_version(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.order_versions(spark, d)
    return versions.keyed_state(rows, "order_id", versions.version_at(rows, 1))


@query
def as_of_timestamp(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.order_versions(spark, d)
    a_day_before = fx.ntz("2024-01-02 12:00:00") - F.expr("INTERVAL 1 DAY")
    return versions.keyed_state(rows, "order_id", versions.version_when(rows, a_day_before))


@query
def current_state(spark: SparkSession, d: str) -> DataFrame:
    """Without the keys that were deleted last."""
    return versions.keyed_state(fx.order_versions(spark, d), "order_id")


@query
def version_increment(spark: SparkSession, d: str) -> DataFrame:
    """Current state of the keys written after version 1; the filter comes before the rank."""
    rows = fx.order_versions(spark, d)
    return versions.state_of_keys(rows, "order_id", versions.changed_keys(rows, "order_id", 1))


@query
def version_history(spark: SparkSession, d: str) -> DataFrame:
    return versions.history(fx.order_versions(spark, d))


@query
def expire_versions(spark: SparkSession, d: str) -> DataFrame:
    return versions.expire_keyed(fx.order_versions(spark, d), "order_id", fx.ntz("2024-01-02 00:00:00"))


@query
def expire_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """The batches as whole states: the one that stands at the cutoff and later ones stay."""
    return versions.expire_snapshots(fx.order_versions(spark, d), fx.ntz("2024-01-02 00:00:00"))


@query
def fact_as_of_timestamp(spark: SparkSession, d: str) -> DataFrame:
    """The fact as it stood a day before; it is rebuilt whole at every version of the orders."""
    orders = fx.order_versions(spark, d)
    a_day_before = fx.ntz("2024-01-03 12:00:00") - F.expr("INTERVAL 1 DAY")
    # The version is known before anything is built, so only its snapshot is.
    number = intervals.version_number_at(intervals.commits_of(orders), a_day_before)
    state = versions.keyed_state(orders, "order_id", F.lit(number))
    snapshot = versions.stamp(gold.fact_sales(fx.enriched(spark, d, orders=state)), number, fx.ntz(fx.COMMITS[number]))
    return versions.snapshot_state(snapshot, F.lit(number))


# Validity intervals -------------------------------------------------------------------------


def _intervals(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The stored interval form of the orders, and its small table of versions."""
    rows = fx.order_versions(spark, d)
    made = stored(intervals.placed(intervals.with_intervals(rows, "order_id"), joins.partitions_of(rows)), "order-intervals")
    return made, stored(intervals.commits_of(made), "order-commits")


@query
def order_intervals(spark: SparkSession, d: str) -> DataFrame:
    return intervals.with_intervals(fx.order_versions(spark, d), "order_id")


@query
def order_intervals_extended(spark: SparkSession, d: str) -> DataFrame:
    """The same, kept up load by load: each version closes the open rows of its keys."""
    rows = fx.order_versions(spark, d)
    closed, still_open = None, intervals.with_intervals(rows.filter("_version = 0"), "order_id")
    for number in (1, 2):
        ended, still_open = intervals.extend(still_open, rows.filter(F.col("_version") == number), "order_id")
        closed = ended if closed is None else closed.unionByName(ended)
    return closed.unionByName(still_open)


@query
def interval_as_of_version(spark: SparkSession, d: str) -> DataFrame:
    rows, commits = _intervals(spark, d)
    return intervals.as_of(rows, intervals.version_number(commits, 1))


@query
def interval_as_of_timestamp(spark: SparkSession, d: str) -> DataFrame:
    rows, commits = _intervals(spark, d)
    a_day_before = fx.ntz("2024-01-02 12:00:00") - F.expr("INTERVAL 1 DAY")
    return intervals.as_of(rows, intervals.version_number_at(commits, a_day_before))


@query
def interval_current_state(spark: SparkSession, d: str) -> DataFrame:
    """The newest version, without the keys that it deleted."""
    rows, commits = _intervals(spark, d)
    return intervals.as_of(rows, intervals.version_number(commits, len(fx.COMMITS) - 1))


@query
def interval_expire(spark: SparkSession, d: str) -> DataFrame:
    rows, commits = _intervals(spark, d)
    return intervals.expire(rows, commits, fx.ntz("2024-01-02 00:00:00"))


def _stored_sold(spark: SparkSession, d: str) -> DataFrame:
    """All items with their products, dealt by order so that no load moves them; where an order is hot they lie as they come."""
    hot = fx.hot(spark, d)
    sold = enrich.sold_items(fx.silver(spark, d, "order_items"), fx.silver(spark, d, "products"), hot=hot)
    if hot.order_id:
        return stored(sold, "sold")
    path = new_folder(spark, "sold")
    return bucketed.write_bucketed(sold, "stratalith_" + path.rsplit("-", 1)[-1], "order_id", joins.partitions_of(sold), path)


@query
def refreshed_fact(spark: SparkSession, d: str) -> DataFrame:
    """The fact stored by month from the first two batches of orders; the last one refreshes the months that it touches.

    What both loads read is made once and stored: the items with their products, the orders and the changed ids.
    """
    path = new_folder(spark, "fact")
    sold = _stored_sold(spark, d)
    fact = gold.fact_sales(fx.enriched(spark, d, orders=fx.order_batch(spark, d, 0, 1), sold=sold))
    refresh.write_fact(fact, path)
    before = refresh.read_fact(spark, path, fact)
    orders = stored(fx.silver(spark, d, "orders"), "fact-orders")
    changed = stored(fx.order_batch(spark, d, 2).select("order_id"), "fact-changed")
    refresh.refresh_fact(path, before, orders, changed, lambda some: fx.enriched(spark, d, orders=some, few_orders=True, sold=sold))
    return refresh.read_fact(spark, path, before)


@query
def zorder_rewrite(spark: SparkSession, d: str) -> DataFrame:
    return layout.cluster_by(fx.raw(spark, d, "orders"), ["order_id", "customer_id", "order_date"])
