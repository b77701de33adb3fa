"""Order items joined to their order, customer and product."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from stratalith.operators.incremental import changed_since
from stratalith.operators.joins import hot_keys, only_keys_of, spread_join

CLOCKS = ("created_at", "updated_at")


@dataclass(frozen=True)
class HotKeys:
    """Join keys that hold a large share of the orders or items."""

    order_id: Sequence[Any] = ()
    customer_id: Sequence[Any] = ()
    product_id: Sequence[Any] = ()

    @classmethod
    def of(cls, orders: DataFrame, order_items: DataFrame, share: float | None = None) -> HotKeys:
        """Found in two passes over three columns, before any join."""
        return cls(
            **hot_keys(orders, ["customer_id"], share),
            **hot_keys(order_items, ["order_id", "product_id"], share),
        )


def _sold(order_items: DataFrame, products: DataFrame, hot: HotKeys, of: DataFrame | None) -> DataFrame:
    """Items, only those of the orders in ``of`` if there is one, with the product of each."""
    sold = order_items.select(
        "order_item_id", "order_id", "product_id", "quantity", F.col("price").alias("unit_price")
    )
    if of is not None:
        sold = only_keys_of(sold, of, "order_id")
    return spread_join(
        sold, products.select("product_id", "product_name", "category"), "product_id", "left",
        row_id="order_item_id", hot=hot.product_id,
    )


def sold_items(order_items: DataFrame, products: DataFrame, *, hot: HotKeys = HotKeys()) -> DataFrame:
    """Items of any order with their product, to be stored where several enrichments read the same ones."""
    return _sold(order_items.filter("order_id IS NOT NULL"), products, hot, None)


def enrich_sales(
    order_items: DataFrame | None,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame | None,
    *,
    hot: HotKeys = HotKeys(),
    few_orders: bool = False,
    sold: DataFrame | None = None,
) -> DataFrame:
    """One row per item of the given orders.

    Orders meet customers and items meet products before the two sides meet: each lookup
    shuffles its narrow side, and the wide rows are shuffled once, by order. With
    ``few_orders`` (an increment) the items are first reduced to those of the orders. With ``sold``,
    stored :func:`sold_items`, items and products are not read; dealt by order, they are not moved either.
    """
    if sold is None:
        sold = _sold(order_items, products, hot, orders if few_orders else None)
    placed = spread_join(
        orders.select(
            "order_id", "customer_id", "order_date", "order_status", "total_amount", "created_at", "updated_at"
        ),
        customers.select("customer_id", F.col("name").alias("customer_name"), "city", "state"),
        "customer_id", "left", row_id="order_id", hot=hot.customer_id,
    )
    joined = spread_join(sold, placed, "order_id", "inner", row_id="order_item_id", hot=hot.order_id)
    return joined.select(
        "order_item_id", "order_id", "customer_id", "product_id", "order_date", "order_status",
        "customer_name", "city", "state", "product_name", "category", "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).alias("sales_amount"),
        F.col("total_amount").alias("order_total_amount"),
        F.col("created_at").alias("order_created_at"),
        F.col("updated_at").alias("order_updated_at"),
    )


def affected_orders(
    orders: DataFrame,
    mark: Column | None,
    *,
    order_items: DataFrame | None = None,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Orders to enrich again: those changed since the mark.

    Every further table that is passed adds the orders its changed rows touch (products
    need ``order_items`` to reach an order). Each order is returned once.
    """
    changed = changed_since(orders, mark, CLOCKS)
    if mark is None or (order_items is None and customers is None and products is None):
        return changed
    ids = changed.select("order_id")
    if order_items is not None:
        ids = ids.unionByName(changed_since(order_items, mark, CLOCKS).select("order_id"))
    if customers is not None:
        ids = ids.unionByName(
            only_keys_of(orders, changed_since(customers, mark, CLOCKS), "customer_id").select("order_id")
        )
    if products is not None and order_items is not None:
        ids = ids.unionByName(
            only_keys_of(order_items, changed_since(products, mark, CLOCKS), "product_id").select("order_id")
        )
    # Counted down to one row per order before the shuffle: an order may have very many changed items.
    return only_keys_of(orders, ids.distinct(), "order_id")
