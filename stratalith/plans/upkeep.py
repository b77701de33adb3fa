"""Layout and retention jobs over the stored tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from stratalith.operators.layout import cluster_by
from stratalith.plans.gold import FACT_PARTITIONS
from stratalith.plans.loads import Outcome, tracked
from stratalith.sources.files import stored
from stratalith.sources.keyed import MissingTable
from stratalith.sources.tables import BATCH, Store

# The tables that are clustered, and by which columns.
CLUSTERING: dict[tuple[str, str], tuple[str, ...]] = {
    ("bronze", "customers_raw"): ("customer_id",),
    ("bronze", "products_raw"): ("product_id",),
    ("bronze", "orders_raw"): ("order_id", "customer_id"),
    ("bronze", "order_items_raw"): ("order_id", "product_id"),
    ("silver", "customers"): ("customer_id", "state"),
    ("silver", "products"): ("product_id", "category"),
    ("silver", "orders"): ("order_id", "customer_id", "order_date"),
    ("silver", "order_items"): ("order_id", "product_id"),
    ("silver", "sales_enriched"): ("order_date", "customer_id", "product_id"),
    ("gold", "fact_sales"): ("order_date_only", "state", "product_id"),
    ("gold", "dim_customers"): ("customer_id", "state"),
    ("gold", "dim_products"): ("product_id", "category"),
}


def _partitions(store: Store, layer: str, table: str) -> tuple[str, ...]:
    if layer == store.layout.bronze:
        return (BATCH, "rejected")
    return FACT_PARTITIONS if table == "fact_sales" else ()


def _each(store: Store, job: str, targets: Sequence[tuple[str, str]], on_error: str, body: Callable[[str, str], Outcome]) -> dict[str, Outcome | Exception]:
    """Run ``body`` per table. ``on_error`` is "log", to go on with the next one, or "raise"."""
    if on_error not in ("log", "raise"):
        raise ValueError(f"on_error is 'log' or 'raise', not {on_error!r}")
    done: dict[str, Outcome | Exception] = {}
    for layer, table in targets:
        name = f"{layer}.{table}"
        try:
            done[name] = tracked(store, layer, table, lambda _, at=(layer, table): body(*at), job=job)
        except Exception as e:
            if on_error == "raise":
                raise
            done[name] = e
    return done


def optimize(store: Store, targets: Mapping[tuple[str, str], Sequence[str]] | None = None, on_error: str = "log") -> dict[str, Outcome | Exception]:
    """Cluster tables along several columns at once; their rows stay the same.

    The rows are copied aside and then written, clustered, in the place of the old ones, partition by partition. Keyed tables lie
    in sorted buckets by their key, which merges rely on, and files of a watched folder are kept as they came; both are left so.
    """
    targets = CLUSTERING if targets is None else targets

    def body(layer: str, table: str) -> Outcome:
        cols, parts = targets[(layer, table)], _partitions(store, layer, table)
        if not store.exists(layer, table):
            raise MissingTable(f"{layer}.{table} has no rows yet")
        if store.is_keyed(layer, table):
            return Outcome(0, f"kept in buckets by {store.keyed(table).key}")
        rows = store.rows(layer, table)
        if not set(parts) <= set(rows.columns):
            return Outcome(0, "kept as delivered")
        aside = stored(rows, "rows")
        writer = cluster_by(aside, cols, within=parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if parts else "static")
        writer.partitionBy(*parts).parquet(store.path(layer, table))
        return Outcome(aside.count(), f"clustered by {', '.join(cols)}")

    return _each(store, "OPTIMIZE", list(targets), on_error, body)


def vacuum(store: Store, targets: Sequence[tuple[str, str]] | None = None, *, now: Column | None = None, on_error: str = "log") -> dict[str, Outcome | Exception]:
    """Drop what was replaced longer ago than the retention time; only keyed tables keep such rows. No row is read or written."""
    targets = list(CLUSTERING) if targets is None else targets
    hours = store.layout.retain_hours
    cutoff = (F.current_timestamp() if now is None else now) - F.expr(f"INTERVAL {hours} HOURS")

    def body(layer: str, table: str) -> Outcome:
        if not store.exists(layer, table):
            raise MissingTable(f"{layer}.{table} has no rows yet")
        gone = store.keyed(table).expire(cutoff) if store.is_keyed(layer, table) else 0
        return Outcome(gone, f"retain {hours} hours: {gone} versions dropped" if gone else f"retain {hours} hours: nothing to drop")

    return _each(store, "VACUUM", targets, on_error, body)
