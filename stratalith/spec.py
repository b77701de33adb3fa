"""Table descriptions: columns, key, cleaning rules, ordering and high-water column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """One entity.

    ``columns`` maps every raw column to its cleaning rule (see ``functions.columns``).
    ``tie_breakers`` extend ``updated_at, created_at`` to a total order, so the latest row
    of a key does not depend on how the data is partitioned.
    """

    name: str
    key: str
    columns: Mapping[str, str]
    tie_breakers: tuple[str, ...]
    watermark_col: str = "updated_at"
    recency: tuple[str, ...] = ("updated_at", "created_at")
    # A folder to which files are delivered, or one file that is delivered anew.
    source_path: str | None = None

    @property
    def timestamp_cols(self) -> tuple[str, ...]:
        return tuple(c for c, rule in self.columns.items() if rule == "timestamp")

    @property
    def order_by(self) -> tuple[str, ...]:
        return self.recency + self.tie_breakers


CUSTOMERS = TableSpec(
    name="customers",
    key="customer_id",
    columns={
        "customer_id": "long",
        "name": "trim",
        "city": "title",
        "state": "upper",
        "signup_date": "timestamp",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    },
    tie_breakers=("name", "city", "state", "signup_date"),
)
PRODUCTS = TableSpec(
    name="products",
    key="product_id",
    columns={
        "product_id": "long",
        "product_name": "trim",
        "category": "title",
        "price": "double",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    },
    tie_breakers=("product_name", "category", "price"),
)
ORDERS = TableSpec(
    name="orders",
    key="order_id",
    columns={
        "order_id": "long",
        "customer_id": "long",
        "order_date": "timestamp",
        "order_status": "upper",
        "total_amount": "double",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    },
    tie_breakers=("customer_id", "order_date", "order_status", "total_amount"),
)
ORDER_ITEMS = TableSpec(
    name="order_items",
    key="order_item_id",
    columns={
        "order_item_id": "long",
        "order_id": "long",
        "product_id": "long",
        "quantity": "int",
        "price": "double",
        "created_at": "timestamp",
        "updated_at": "timestamp",
    },
    tie_breakers=("product_id", "order_id", "quantity", "price"),
)

ENTITIES: dict[str, TableSpec] = {s.name: s for s in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS)}

ENRICHED = "sales_enriched"


@dataclass(frozen=True)
class Layout:
    """Where the layers live and what they are called; the only place names are kept."""

    root: str
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    control: str = "control"
    specs: Mapping[str, TableSpec] = field(default_factory=lambda: dict(ENTITIES))
    retain_hours: int = 168
    # Buckets of a keyed table: as many as tasks should share a merge.
    buckets: int = 32
