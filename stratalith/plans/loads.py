"""The load jobs of the three layers, each tracked in the control tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from stratalith.functions.columns import mark_literal, mark_micros
from stratalith.operators.clean import cast_failures, clean, parse_timestamps, reject_reason, rejects, unreadable
from stratalith.operators.dedup import latest_per_key
from stratalith.operators.incremental import newer_than
from stratalith.operators.joins import only_keys_of, spread_join
from stratalith.plans import gold, refresh
from stratalith.plans.enrich import CLOCKS, HotKeys, enrich_sales
from stratalith.sources import control
from stratalith.sources.csv_files import DAMAGED, SOURCE_FILE, read_by_header
from stratalith.sources.files import partition_numbers, stored
from stratalith.sources.landing import append_new_files, is_folder
from stratalith.sources.metadata import create_namespace, create_view
from stratalith.sources.tables import BATCH, MARK, REJECT_COLUMNS, REJECTS, Store
from stratalith.spec import ENRICHED

# Order in which the entities are loaded.
ENTITY_ORDER = ("customers", "products", "orders", "order_items")
BRONZE_COLUMNS = (*REJECT_COLUMNS, "unreadable", "ingestion_timestamp", "pipeline_run_id", BATCH, MARK)


@dataclass(frozen=True)
class Outcome:
    """What a load did. ``mark`` is in microseconds; None leaves the stored mark alone."""

    rows: int
    message: str
    mark: int | None = None


def _now() -> datetime:
    return datetime.now(timezone.utc)


def setup(store: Store) -> None:
    """Namespaces, control tables and seeded marks; may be repeated."""
    spark, layout = store.spark, store.layout
    create_namespace(spark, layout.bronze, "Delivered data, as loaded")
    create_namespace(spark, layout.silver, "Cleaned data, one row per key")
    create_namespace(spark, layout.gold, "Reporting tables")
    create_namespace(spark, layout.control, "Marks and run log")
    store.control.create()
    store.control.change_marks(lambda marks: control.seed_marks(marks, control.seeds(spark, layout.specs)))
    publish(store, [])


def plain_tables(store: Store) -> list[tuple[str, str]]:
    """The tables that are folders of files, as ``(layer, table)``; keyed tables have their names anyway."""
    entities = list(store.layout.specs)
    return [
        *[(store.layout.bronze, f"{t}_raw") for t in entities],
        *[(store.layout.silver, f"{t}{REJECTS}") for t in entities],
        *[(store.layout.gold, t) for t in ("dim_customers", "dim_products", "fact_sales", *gold.AGGREGATES)],
    ]


def publish(store: Store, targets: Iterable[tuple[str, str]] | None = None) -> list[str]:
    """Make the plain tables readable in SQL as ``<layer>.<table>``; to be repeated when a table gets new columns."""
    done = []
    for layer, table in plain_tables(store) if targets is None else targets:
        if store.exists(layer, table):
            create_view(store.spark, layer, table, store.view_text(layer, table))
            done.append(f"{layer}.{table}")
    for name, text in store.control.view_texts().items():
        create_view(store.spark, store.layout.control, name, text)
        done.append(f"{store.layout.control}.{name}")
    return done


def tracked(store: Store, layer: str, table: str, body: Callable[[str], Outcome], *, job: str | None = None, mark_name: str | None = None) -> Outcome:
    """Run a load between its RUNNING and SUCCESS or FAILED marks, and log it.

    ``job`` names layout work in the log, instead of the layer. The mark moves last: a crash before that
    repeats the increment, which writes the same rows to the same places. An error is logged and raised.
    """
    run_id, start, tables = control.new_run_id(), _now(), store.control

    def log(status: str, rows: int, message: str) -> None:
        name = (job, f"{layer}.{table}") if job else (layer.upper(), table)
        tables.append_log(control.log_entry(store.spark, run_id, *name, status, rows, message, start, _now()))

    try:
        if mark_name:
            one = control.names(store.spark, mark_name)
            tables.change_marks(lambda marks: control.mark_running(marks, one, F.current_timestamp()))
        done = body(run_id)
        log("SUCCESS", done.rows, done.message)
        if mark_name:
            moved = one.select(
                "table_name",
                (F.lit(None).cast("timestamp") if done.mark is None else mark_literal(done.mark)).alias("last_run_ts"),
                F.lit(run_id).alias("last_run_id"),
                F.lit("SUCCESS").alias("status"),
                F.current_timestamp().alias("updated_at"),
            )
            tables.change_marks(lambda marks: control.mark_success(marks, moved))
        return done
    except Exception as e:
        if mark_name:
            tables.change_marks(lambda marks: control.mark_failed(marks, mark_name, F.current_timestamp()))
        log("FAILED", 0, str(e))
        raise


def rows_written() -> dict[str, Column]:
    return {"rows": F.count(F.lit(1))}


def load_bronze(store: Store, table: str) -> Outcome:
    """Append what was delivered and not taken yet; rows that cannot be placed are kept apart, each once.

    A folder is watched: each file that comes to it is taken once (``sources.landing``). A single file is read anew every time; what it adds is a
    partition of its own, which a repeated attempt overwrites. Either way rows
    up to the greatest stored mark are left out, so deliveries may repeat what came before. Rows without a readable mark, and damaged lines, are
    rejected; one is new if no stored one is equal to it in all delivered columns. Timestamps that cannot be read become NULL; their
    text stays in ``unreadable``.
    """
    spec, bronze, spark = store.layout.specs[table], store.layout.bronze, store.spark
    observe = {"kept": F.count_if(F.col("rejected") == 0), "rejected": F.count_if(F.col("rejected") == 1), "mark": F.max(MARK)}

    def body(run_id: str) -> Outcome:
        watch, path = is_folder(spark, spec.source_path), store.path(bronze, f"{table}_raw")
        mark = _stored_mark(store, table)
        rows = _taken(store, table, read_by_header(spark, spec.source_path, spec, BRONZE_COLUMNS, watch), mark, run_id)
        if watch:
            got = append_new_files(rows, path, f"{store.layout.root}/{store.layout.control}/landing/{table}", ("rejected",), observe)
        else:
            number = max(partition_numbers(spark, path, BATCH), default=-1) + 1
            # Not a constant to the optimizer: the writer deals its rows by it.
            got = [store.overwrite(bronze, f"{table}_raw", rows.withColumn(BATCH, F.col("rejected") * 0 + number), observe, (BATCH, "rejected"))]
        kept, rejected = (sum(g[k] or 0 for g in got) for k in ("kept", "rejected"))
        # Rows of an attempt whose mark was never moved count as well.
        reached = max((m for m in (mark, *(g["mark"] for g in got)) if m is not None), default=None)
        return Outcome(kept, f"{f'rows_out={kept}' if kept else 'nothing new;'} rows_rejected={rejected}", reached)

    return tracked(store, bronze, f"{table}_raw", body, mark_name=table)


def _stored_mark(store: Store, table: str) -> int | None:
    """The greatest mark that is stored: one column of the rows that were not rejected."""
    found = store.files(store.layout.bronze, f"{table}_raw")
    return None if found is None else found.filter(F.col("rejected") == 0).agg(F.max(MARK)).first()[0]


def _taken(store: Store, table: str, delivered: DataFrame, mark: int | None, run_id: str) -> DataFrame:
    """The delivered rows that bronze takes, with what it adds to them."""
    spec = store.layout.specs[table]
    content, mark_col = [c for c in delivered.columns if c != SOURCE_FILE], F.col(spec.watermark_col)
    noted = delivered.withColumns({
        "rejected_value": F.coalesce(DAMAGED, mark_col),
        "unreadable": unreadable(delivered, spec.timestamp_cols),
        "rejected_hash": F.xxhash64(*[F.coalesce(f"`{c}`", F.lit("\0")) for c in content]),
    })
    parsed = parse_timestamps(noted, spec.timestamp_cols)
    bad = mark_col.isNull() | F.col(DAMAGED).isNotNull()
    rows = parsed.filter(F.lit(True) if mark is None else bad | (mark_col > mark_literal(mark))).withColumns({
        "rejected": F.when(bad, 1).otherwise(0),
        "rejected_value": F.when(bad, F.col("rejected_value")),
        "rejected_hash": F.when(bad, F.col("rejected_hash")),
        MARK: F.when(~bad, mark_micros(mark_col)),
        "ingestion_timestamp": F.current_timestamp(),
        "pipeline_run_id": F.lit(run_id),
    }).drop(DAMAGED)
    there = store.files(store.layout.bronze, f"{table}_raw")
    if there is None:
        return rows
    known = there.filter(F.col("rejected") == 1).select("rejected_hash").distinct()
    return spread_join(rows, known, "rejected_hash", "left_anti")


def load_silver(store: Store, table: str) -> Outcome:
    """Clean the bronze rows above the mark and upsert the latest of each key.

    Rows without a usable key go to ``<table>_rejects``, into the partition of the mark that the load began from, which a repeated load
    overwrites. Values that are none of their column's type are counted by column in the run log.
    """
    spec, bronze, silver = store.layout.specs[table], store.layout.bronze, store.layout.silver
    mark_name = f"silver_{table}"

    def body(run_id: str) -> Outcome:
        if not store.exists(bronze, f"{table}_raw"):
            return Outcome(0, "nothing delivered yet")
        batch = newer_than(store.current(bronze, f"{table}_raw"), spec.watermark_col, mark := store.control.mark(mark_name))
        # Two stored columns decide how much there is to do and where the mark goes.
        size = batch.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(reject_reason(spec)).alias("rejected"),
            F.max(mark_micros(spec.watermark_col)).alias("mark"),
        ).first()
        if size["rows"] == 0:
            return Outcome(0, "nothing new")
        if size["rejected"]:
            began = F.lit(0).cast("long") if mark is None else mark_micros(mark)
            bad = rejects(batch, spec).withColumns({"silver_run_id": F.lit(run_id), "began_from": began + F.length("reject_reason") * 0})
            store.overwrite(silver, f"{table}{REJECTS}", bad, rows_written(), ("began_from",))
        latest = latest_per_key(clean(batch, spec), spec.key, spec.order_by)
        latest = latest.withColumns({"silver_run_id": F.lit(run_id), "silver_load_ts": F.current_timestamp()})
        written = store.keyed(table).upsert(latest)
        told = f"rows_in={size['rows']} rows_rejected={size['rejected']} rows_out={written}"
        lost = {r["column_name"]: r["failed"] for r in cast_failures(batch, spec).collect() if r["failed"] and r["column_name"] != spec.key}
        told += f" unreadable={json.dumps(lost)}" if lost else ""
        return Outcome(written, told, size["mark"])

    return tracked(store, silver, table, body, mark_name=mark_name)


def _seen(store: Store, layer: str, table: str) -> dict[str, int]:
    """The last version of each input that a table has taken in, as its last run told."""
    told = store.control.last_message(layer, table) or ""
    return json.loads(told.partition("seen=")[2] or "{}")


def _touched_orders(store: Store, seen: dict[str, int], inputs: Sequence[str]) -> DataFrame:
    """Ids of the orders that versions above ``seen`` touch, each once.

    Changes are found by version, not by their own time, so a late one is not missed; a row that moved touches the order it left as well.
    """
    def changed(table: str) -> DataFrame:
        return store.keyed(table).changed_since(seen.get(table))

    ids = changed("orders").select("order_id")
    if "order_items" in inputs:
        ids = ids.union(changed("order_items").select("order_id"))
    if "customers" in inputs:
        ids = ids.union(only_keys_of(store.current(store.layout.silver, "orders"), changed("customers"), "customer_id").select("order_id"))
    if "products" in inputs:
        ids = ids.union(only_keys_of(store.current(store.layout.silver, "order_items"), changed("products"), "product_id").select("order_id"))
    return ids.dropna().distinct()


def load_enriched(store: Store, propagate: Sequence[str] = ()) -> Outcome:
    """Enrich the orders changed since the last time and upsert their items.

    ``propagate`` may name ``order_items``, ``customers`` and ``products``: then orders whose
    items, customer or products changed are enriched again too. What is new is told by version
    numbers, which the run log keeps for every input that was followed.
    """
    silver, mark_name = store.layout.silver, f"silver_{ENRICHED}"

    def body(run_id: str) -> Outcome:
        if not all(store.exists(silver, t) for t in ENTITY_ORDER):
            return Outcome(0, "not every entity is loaded yet")
        seen, inputs = _seen(store, silver, ENRICHED), ["orders", *propagate]
        upto = {t: store.keyed(t).version() for t in inputs}
        now = f"seen={json.dumps(seen | upto)}"
        state = {t: store.current(silver, t) for t in ENTITY_ORDER}
        if all(upto[t] == seen.get(t) for t in inputs):
            return Outcome(0, f"no changed orders {now}")
        first = "orders" not in seen
        picked = state["orders"] if first else only_keys_of(state["orders"], stored(_touched_orders(store, seen, inputs), "touched-orders"), "order_id")
        changed = stored(picked, "changed-orders")
        top = changed.agg(F.count(F.lit(1)).alias("rows"), F.greatest(*[F.max(mark_micros(c)) for c in CLOCKS]).alias("mark")).first()
        if top["rows"] == 0:
            return Outcome(0, f"no changed orders {now}")
        items, customers, products = state["order_items"], state["customers"], state["products"]
        if not first:
            items = stored(only_keys_of(items, changed, "order_id"), "changed-items")
            customers = only_keys_of(customers, changed.select("customer_id").distinct(), "customer_id")
            products = only_keys_of(products, items.select("product_id").distinct(), "product_id")
        made = enrich_sales(items, changed, customers, products, hot=HotKeys.of(changed, items))
        written = store.keyed(ENRICHED).upsert(made.withColumns({"silver_run_id": F.lit(run_id), "silver_load_ts": F.current_timestamp()}))
        # The mark follows the orders that were looked at, also when none of them has items.
        # It may lag the stored one when other tables brought older orders along.
        told = f"changed_orders={top['rows']} rows_out={written} {now}"
        return Outcome(written, told, _forward(store, mark_name, top["mark"]))

    return tracked(store, silver, ENRICHED, body, mark_name=mark_name)


def _forward(store: Store, mark_name: str, new: int | None) -> int | None:
    """A mark never moves back."""
    old = store.control.marks().filter(F.col("table_name") == mark_name).agg(F.max(mark_micros("last_run_ts"))).first()[0]
    return new if old is None or (new is not None and new > old) else None


def _audited(df: DataFrame, run_id: str) -> DataFrame:
    return df.withColumns({"gold_run_id": F.lit(run_id), "gold_load_ts": F.current_timestamp()})


def write_gold(store: Store, table: str, df: DataFrame) -> Outcome:
    """Replace one reporting table, with audit columns, and log it by itself."""

    def body(run_id: str) -> Outcome:
        return Outcome(store.overwrite(store.layout.gold, table, _audited(df, run_id), rows_written())["rows"], f"{table} built")

    return tracked(store, store.layout.gold, table, body)


def load_fact(store: Store) -> Outcome:
    """Bring the sales fact up to date: only months that the enriched sales changed in since the last time are written again."""
    layer, enriched = store.layout.gold, store.keyed(ENRICHED)

    def body(run_id: str) -> Outcome:
        fact, path = _audited(gold.fact_sales(enriched.current()), run_id), store.path(layer, "fact_sales")
        seen, now = _seen(store, layer, "fact_sales").get(ENRICHED), f"seen={json.dumps({ENRICHED: enriched.version()})}"
        if seen is None or not store.exists(layer, "fact_sales"):
            return Outcome(refresh.write_fact(fact, path, rows_written())["rows"], f"fact_sales built {now}")
        months = refresh.months_of(enriched.changed_since(seen))
        if not months:
            return Outcome(0, f"no changed months {now}")
        done, got = refresh.replace_months(refresh.in_months(fact, months), path, months, rows_written())
        return Outcome(got["rows"], f"months_written={len(done.written)} months_emptied={len(done.emptied)} {now}")

    return tracked(store, layer, "fact_sales", body)


def build_gold(store: Store) -> dict[str, Outcome]:
    """All reporting tables. The fact comes first; one pass over it feeds every aggregate."""
    silver = store.layout.silver
    done = {
        "dim_customers": write_gold(store, "dim_customers", gold.dim_customers(store.current(silver, "customers"))),
        "dim_products": write_gold(store, "dim_products", gold.dim_products(store.current(silver, "products"))),
        "fact_sales": load_fact(store),
    }
    cube = stored(gold.sales_cube(store.current(store.layout.gold, "fact_sales")), "sales-cube")
    return done | {name: write_gold(store, name, made) for name, made in gold.aggregates_of(cube).items()}


def run_layer(load: Callable[[Store, str], Outcome], store: Store, tables: Iterable[str] = ENTITY_ORDER) -> dict[str, Outcome]:
    return {t: load(store, t) for t in tables}


def run_all(store: Store, propagate: Sequence[str] = ()) -> dict[str, Outcome]:
    """Bronze, silver, enrichment and gold, in that order."""
    done = {f"bronze.{t}": o for t, o in run_layer(load_bronze, store).items()}
    done |= {f"silver.{t}": o for t, o in run_layer(load_silver, store).items()}
    done[f"silver.{ENRICHED}"] = load_enriched(store, propagate)
    done |= {f"gold.{t}": o for t, o in build_gold(store).items()}
    publish(store)
    return done
