"""The dashboard queries, over the reporting tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalith.functions.columns import average_per


def revenue_by_state(agg_revenue_by_state: DataFrame) -> DataFrame:
    return agg_revenue_by_state.select("state", "total_revenue", "total_orders", "total_customers").orderBy(
        F.desc("total_revenue"), "state"
    )


def top_products(agg_top_products: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best by revenue; equal revenue goes to the smaller product id."""
    best = agg_top_products.orderBy(F.desc("revenue"), F.asc_nulls_last("product_id")).limit(k)
    return best.select("product_name", "category", "units_sold", "revenue")


def daily_trend(agg_daily_sales: DataFrame) -> DataFrame:
    return agg_daily_sales.select(
        F.col("order_date_only").alias("sales_date"), "daily_revenue", "daily_orders", "daily_customers"
    ).orderBy("sales_date")


def monthly_trend(agg_monthly_sales: DataFrame) -> DataFrame:
    return agg_monthly_sales.select(
        "order_year", "order_month", "monthly_revenue", "monthly_orders", "monthly_customers"
    ).orderBy("order_year", "order_month")


def category_revenue(agg_category_sales: DataFrame) -> DataFrame:
    return agg_category_sales.select("category", "category_revenue", "units_sold").orderBy(
        F.desc("category_revenue"), "category"
    )


def average_order_value(fact_sales: DataFrame) -> DataFrame:
    return (
        fact_sales.groupBy("order_year", "order_month")
        .agg(average_per("sales_amount", "order_id").alias("avg_order_value"))
        .orderBy("order_year", "order_month")
    )


def recent_runs(run_log: DataFrame, layers: tuple[str, ...], k: int) -> DataFrame:
    """The ``k`` runs of ``layers`` that started last."""
    return (
        run_log.filter(F.col("layer_name").isin(*layers))
        .orderBy(F.desc("run_start_ts"), "run_id")
        .limit(k)
    )


def mark_state(control: DataFrame, like: str | None = None) -> DataFrame:
    """Marks in name order; ``like`` is a LIKE pattern, in which a bare ``_`` is a wildcard."""
    seen = control if like is None else control.filter(F.col("table_name").like(like))
    return seen.select("table_name", "last_run_ts", "last_run_id", "status", "updated_at").orderBy("table_name")
