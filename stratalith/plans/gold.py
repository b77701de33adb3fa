"""Reporting tables: two dimensions, the sales fact and five aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratalith.functions.columns import MONEY, date_parts, money_sum, money_total
from stratalith.operators import distinct
from stratalith.operators.dedup import latest_per_key
from stratalith.spec import CUSTOMERS, PRODUCTS, TableSpec

FACT_PARTITIONS = ("order_year", "order_month")


def _dimension(df: DataFrame, spec: TableSpec) -> DataFrame:
    return latest_per_key(df.select(*spec.columns), spec.key, spec.order_by)


def dim_customers(customers: DataFrame) -> DataFrame:
    return _dimension(customers, CUSTOMERS)


def dim_products(products: DataFrame) -> DataFrame:
    return _dimension(products, PRODUCTS)


def fact_sales(enriched: DataFrame) -> DataFrame:
    """The enriched sales with their calendar columns; one row per order item."""
    return enriched.withColumns(date_parts("order_date"))


def _per_order(sales: DataFrame, *group: str) -> DataFrame:
    """One row per group, order and customer, with its exact amount.

    Two distinct counts repeat every row that reaches them; here these are orders, not items.
    """
    return sales.groupBy(*group, "order_id", "customer_id").agg(money_sum("sales_amount").alias("amount"))


def _sums(revenue: str, orders: str, customers: str) -> list[Column]:
    return [
        F.round(F.sum("amount"), 2).cast("double").alias(revenue),
        F.count_distinct("order_id").alias(orders),
        F.count_distinct("customer_id").alias(customers),
    ]


def revenue_by_state(sales: DataFrame) -> DataFrame:
    return _per_order(sales, "state").groupBy("state").agg(*_sums("total_revenue", "total_orders", "total_customers"))


def top_products(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id", "product_name", "category").agg(
        F.sum("quantity").alias("units_sold"),
        money_total("sales_amount").alias("revenue"),
    )


def daily_sales(sales: DataFrame) -> DataFrame:
    days = _per_order(sales.withColumn("order_date_only", F.to_date("order_date")), "order_date_only")
    return days.groupBy("order_date_only").agg(*_sums("daily_revenue", "daily_orders", "daily_customers"))


def monthly_sales(sales: DataFrame) -> DataFrame:
    months = sales.withColumns({"order_year": F.year("order_date"), "order_month": F.month("order_date")})
    months = _per_order(months, "order_year", "order_month")
    return months.groupBy("order_year", "order_month").agg(*_sums("monthly_revenue", "monthly_orders", "monthly_customers"))


def category_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("category").agg(
        money_total("sales_amount").alias("category_revenue"),
        F.sum("quantity").alias("units_sold"),
    )


# What the parts of an aggregate count and add up, for any group of sales.
COUNTED = {"orders": "order_id", "customers": "customer_id"}


def sales_parts(sales: DataFrame, *group: str) -> DataFrame:
    """Mergeable parts of the sales per group: sets of orders and customers, and the exact amount; see ``operators.distinct``."""
    return distinct.group_parts(sales, group, COUNTED, {"amount": F.col("sales_amount")})


def daily_parts(sales: DataFrame) -> DataFrame:
    """The parts of each day, from which the daily and the monthly aggregate follow without reading the sales again."""
    return sales_parts(sales.withColumn("order_date_only", F.to_date("order_date")), "order_date_only")


def _totals(parts: DataFrame, by: Sequence[str], revenue: str, orders: str, customers: str) -> DataFrame:
    return distinct.totals(parts, by, {revenue: "amount"}, {orders: "orders", customers: "customers"})


def revenue_by_state_of(parts: DataFrame) -> DataFrame:
    return _totals(parts, ["state"], "total_revenue", "total_orders", "total_customers")


def daily_sales_of(parts: DataFrame) -> DataFrame:
    return _totals(parts, ["order_date_only"], "daily_revenue", "daily_orders", "daily_customers")


def monthly_sales_of(parts: DataFrame) -> DataFrame:
    day = F.col("order_date_only")
    months = distinct.merged(parts, {"order_year": F.year(day), "order_month": F.month(day)})
    return _totals(months, ["order_year", "order_month"], "monthly_revenue", "monthly_orders", "monthly_customers")


# The finest groups that the aggregates need: orders, and products.
BY_ORDER = ("state", "order_date_only", "order_year", "order_month", "order_id", "customer_id")
BY_PRODUCT = ("product_id", "product_name", "category")


def sales_cube(fact: DataFrame) -> DataFrame:
    """Sums per order and per product from one pass over the fact; ``by_product`` tells which a row is.

    All five aggregates follow from it, see :func:`aggregates_of`, so it is stored once and the fact read once.
    """
    fact = fact.select(*BY_ORDER, *BY_PRODUCT, F.col("sales_amount").cast(MONEY).alias("amount"), "quantity")
    sets = [[F.col(c) for c in group] for group in (BY_ORDER, BY_PRODUCT)]
    summed = fact.groupingSets(sets, *BY_ORDER, *BY_PRODUCT).agg(
        F.sum("amount").cast(MONEY).alias("amount"), F.sum("quantity").alias("quantity"), F.grouping("order_id").alias("by_product")
    )
    return summed.select(*BY_ORDER, *BY_PRODUCT, "amount", "quantity", (F.col("by_product") == 1).alias("by_product"))


def aggregates_of(cube: DataFrame) -> dict[str, DataFrame]:
    """The five stored aggregates by name, from a stored :func:`sales_cube`."""
    orders, products = cube.filter("NOT by_product"), cube.filter("by_product")
    revenue, units = F.round(F.sum("amount"), 2).cast("double"), F.sum("quantity").alias("units_sold")
    return {
        "agg_revenue_by_state": orders.groupBy("state").agg(*_sums("total_revenue", "total_orders", "total_customers")),
        "agg_top_products": products.groupBy(*BY_PRODUCT).agg(units, revenue.alias("revenue")),
        "agg_daily_sales": orders.groupBy("order_date_only").agg(*_sums("daily_revenue", "daily_orders", "daily_customers")),
        "agg_monthly_sales": orders.groupBy("order_year", "order_month").agg(*_sums("monthly_revenue", "monthly_orders", "monthly_customers")),
        "agg_category_sales": products.groupBy("category").agg(revenue.alias("category_revenue"), units),
    }


# Stored name of each aggregate. All read the fact, which is written first: it is the
# current state of the enriched sales, so no aggregate has to rank versions again.
AGGREGATES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "agg_revenue_by_state": revenue_by_state,
    "agg_top_products": top_products,
    "agg_daily_sales": daily_sales,
    "agg_monthly_sales": monthly_sales,
    "agg_category_sales": category_sales,
}
