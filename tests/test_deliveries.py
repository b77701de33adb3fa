"""Deliveries that are not as expected, and changes that arrive late."""

from __future__ import annotations

import csv
import uuid
from dataclasses import replace

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalith.plans import loads
from stratalith.plans.enrich import enrich_sales
from stratalith.sources import control
from stratalith.sources.csv_files import DAMAGED, read_by_header
from stratalith.sources.keyed import KeyedTable
from stratalith.sources.tables import Store
from stratalith.spec import ENTITIES, Layout


def open_store(spark, folder) -> Store:
    """A store whose names in the catalog are its own."""
    specs = {n: replace(s, source_path=str(folder / f"{n}.csv")) for n, s in ENTITIES.items()}
    names = {layer: f"{layer}_{uuid.uuid4().hex}" for layer in ("bronze", "silver", "gold", "control")}
    store = Store(spark, Layout(root=str(folder / "store"), specs=specs, buckets=3, **names))
    loads.setup(store)
    return store


def deliver(folder, name, header, *rows) -> None:
    with open(folder / f"{name}.csv", "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])


P = ("product_name", "product_id", "category", "price", "created_at", "updated_at")
DAY = "2023-01-0{} 00:00:00"


def test_columns_are_bound_by_name_and_kept(spark, tmp_path):
    wh = open_store(spark, tmp_path)
    deliver(tmp_path, "products", (*P, "brand", "rejected"), ("Lamp", "7", "light", "1.5", DAY.format(1), DAY.format(1), "Glow", "yes"))
    assert loads.load_bronze(wh, "products").rows == 1
    assert rows_of(wh.current(wh.layout.bronze, "products_raw").select("product_id", "product_name", "brand", "delivered_rejected")) == [("7", "Lamp", "Glow", "yes")]
    # A later one lacks a column, the next an essential one.
    deliver(tmp_path, "products", ("updated_at", "product_id", "product_name"), (DAY.format(2), "8", "Desk"))
    assert loads.load_bronze(wh, "products").rows == 1
    assert loads.load_silver(wh, "products").rows == 2
    assert rows_of(wh.current(wh.layout.silver, "products").select("product_id", "product_name", "price", "brand")) == [(7, "Lamp", 1.5, "Glow"), (8, "Desk", None, None)]
    deliver(tmp_path, "products", ("product_name", "updated_at"), ("x", DAY.format(3)))
    with pytest.raises(ValueError, match="no column product_id"):
        loads.load_bronze(wh, "products")


def test_files_of_one_delivery_must_agree(spark, tmp_path):
    wh = open_store(spark, tmp_path)
    (tmp_path / "products.csv").mkdir()
    row = ("Lamp", "7", "light", "1.5", DAY.format(1), DAY.format(1))
    deliver(tmp_path / "products.csv", "a", P, row)
    deliver(tmp_path / "products.csv", "b", (P[1], P[0], *P[2:]), ("8", "Desk", *row[2:]))
    with pytest.raises(Exception, match="b.csv"):
        loads.load_bronze(wh, "products")


def test_rejects_only_and_repeated_deliveries(spark, tmp_path):
    wh = open_store(spark, tmp_path)
    bad = ("Lamp", "9", "light", "n/a", "when", "soon")
    deliver(tmp_path, "products", P, bad)
    for _ in range(2):
        assert loads.load_bronze(wh, "products").rows == 0
    deliver(tmp_path, "products", P, bad, ("Desk", "10", "x", "oops", "never", DAY.format(1)), ("Bad", "x", "x", "1", DAY.format(1), DAY.format(1)))
    assert loads.load_bronze(wh, "products").rows == 2
    stored = wh.rows(wh.layout.bronze, "products_raw")
    assert rows_of(stored.select("product_id", "rejected", "rejected_value", "unreadable")) == [
        ("10", 0, None, "created_at=never"), ("9", 1, "soon", "created_at=when; updated_at=soon"), ("x", 0, None, None),
    ]
    done = loads.load_silver(wh, "products")
    assert done.message == 'rows_in=2 rows_rejected=1 rows_out=1 unreadable={"price": 1}'
    assert rows_of(wh.current(wh.layout.silver, "products_rejects").select("product_id")) == [("x",)]


def test_rejects_of_a_failed_silver_load_are_stored_once(spark, tmp_path, monkeypatch):
    wh = open_store(spark, tmp_path)
    deliver(tmp_path, "products", P, ("Bad", "x", "x", "1", DAY.format(1), DAY.format(1)), ("Lamp", "7", "x", "1", DAY.format(1), DAY.format(1)))
    loads.load_bronze(wh, "products")

    def dies(self, batch):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(KeyedTable, "upsert", dies)
        with pytest.raises(OSError):
            loads.load_silver(wh, "products")
    assert not wh.keyed("products").exists()
    assert loads.load_silver(wh, "products").rows == 1
    assert wh.current(wh.layout.silver, "products_rejects").count() == 1 and wh.current(wh.layout.silver, "products").count() == 1
    assert loads.load_silver(wh, "products").message == "nothing new"


def test_damaged_lines_are_kept_whole(spark, tmp_path):
    """Lines in are rows kept and rows rejected, whatever is wrong with them."""
    wh = open_store(spark, tmp_path)
    ok = f"Lamp,7,light,1.5,{DAY.format(1)},{DAY.format(1)}"
    quoted = f'"Lamp, big",8,light,1.5,{DAY.format(1)},{DAY.format(1)}'
    long = f"{'x' * 300_000},9,light,1.5,{DAY.format(1)},{DAY.format(2)}"
    short, more, half = "4,5", ok + ",9,10", '"never closed,10,light'
    (tmp_path / "products.csv").write_text("\n".join([",".join(P), ok, quoted, short, more, long, half]) + "\n")
    done = loads.load_bronze(wh, "products")
    assert done.rows == 3 and done.message == "rows_out=3 rows_rejected=3"
    kept = wh.current(wh.layout.bronze, "products_raw").collect()
    assert sorted((r["product_id"], len(r["product_name"])) for r in kept) == [("7", 4), ("8", 9), ("9", 300_000)]
    lost = wh.rows(wh.layout.bronze, "products_raw").filter("rejected = 1")
    assert {r["rejected_value"].strip() for r in lost.collect()} == {short, more, half}
    # Delivered again, none is stored twice; a new one is.
    assert loads.load_bronze(wh, "products").message == "nothing new; rows_rejected=0"
    with open(tmp_path / "products.csv", "a") as f:
        f.write("one,two,three\n")
    assert loads.load_bronze(wh, "products").message.endswith("rows_rejected=1")
    assert lost.sparkSession.read.parquet(wh.path(wh.layout.bronze, "products_raw")).filter("rejected = 1").count() == 4
    plain = read_by_header(spark, str(tmp_path / "products.csv"), ENTITIES["products"]).collect()
    assert len(plain) == 7 and sum(r[DAMAGED] is not None for r in plain) == 4


def test_a_watched_folder_gives_each_file_once(spark, tmp_path):
    wh = open_store(spark, tmp_path)
    folder = tmp_path / "products.csv"
    folder.mkdir()
    row = lambda k, day: (f"Lamp {k}", str(k), "light", "1.5", DAY.format(1), DAY.format(day))
    deliver(folder, "one", P, row(1, 1), row(2, 1))
    deliver(folder, "two", P, row(3, 2))
    assert loads.load_bronze(wh, "products").message == "rows_out=3 rows_rejected=0"
    assert loads.load_bronze(wh, "products").message == "nothing new; rows_rejected=0"
    # A later file repeats what came before, brings new rows, one without a mark and a broken line.
    deliver(folder, "three", P, row(3, 2), row(4, 3), ("Lamp 5", "5", "light", "1", DAY.format(1), "soon"), ("x",))
    done = loads.load_bronze(wh, "products")
    assert done.message == "rows_out=1 rows_rejected=2"
    assert rows_of(wh.current(wh.layout.bronze, "products_raw").select("product_id")) == [("1",), ("2",), ("3",), ("4",)]
    assert {r["rejected_value"] for r in wh.rows(wh.layout.bronze, "products_raw").filter("rejected = 1").collect()} == {"soon", "x"}
    names = {r[0].rsplit("/", 1)[1] for r in wh.rows(wh.layout.bronze, "products_raw").select("source_file_name").collect()}
    assert names == {"one.csv", "two.csv", "three.csv"}
    assert loads.load_silver(wh, "products").rows == 4


def test_a_delivery_that_failed_is_taken_once(spark, tmp_path, monkeypatch):
    wh = open_store(spark, tmp_path)
    folder = tmp_path / "products.csv"
    folder.mkdir()
    row = lambda k: (f"Lamp {k}", str(k), "light", "1.5", DAY.format(1), DAY.format(k))
    deliver(folder, "one", P, row(1), row(2))
    taken = loads._taken

    def breaks(*args):
        return taken(*args).withColumn("product_id", F.when(F.col("product_id") == "2", F.raise_error(F.lit("no luck"))).otherwise(F.col("product_id")))

    with monkeypatch.context() as broken:
        broken.setattr(loads, "_taken", breaks)
        with pytest.raises(Exception, match="no luck"):
            loads.load_bronze(wh, "products")
    assert not wh.exists(wh.layout.bronze, "products_raw")
    deliver(folder, "two", P, row(3))
    # The rows are written, but the mark is never moved.
    with monkeypatch.context() as broken:
        broken.setattr(control, "mark_success", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loads.load_bronze(wh, "products")
    loads.load_bronze(wh, "products")
    assert rows_of(wh.current(wh.layout.bronze, "products_raw").select("product_id")) == [("1",), ("2",), ("3",)]
    assert wh.control.marks().filter("table_name = 'products'").first()["status"] == "SUCCESS"


def test_changes_that_arrive_late_are_propagated(spark, tmp_path):
    wh = open_store(spark, tmp_path)
    every = ("order_items", "customers", "products")
    c = tuple(ENTITIES["customers"].columns)
    o, i = tuple(ENTITIES["orders"].columns), tuple(ENTITIES["order_items"].columns)
    base = {
        "customers": (c, [("1", "Ann", "x", "aa", "2020-01-01", "2020-01-01", "2020-01-01")]),
        "products": (P, [("Pen", "5", "x", "1", "2020-01-01", "2020-01-01")]),
        "orders": (o, [("10", "1", "2020-03-01", "new", "1", "2020-03-01", "2020-03-01"), ("11", "", "2020-03-01", "new", "1", "2020-03-01", "2020-03-01")]),
        "order_items": (i, [("100", "10", "5", "1", "2", "2020-03-01", "2020-03-01")]),
    }

    def run(**more):
        for name, (header, rows) in base.items():
            deliver(tmp_path, name, header, *more.get(name, rows))
            loads.load_bronze(wh, name)
            loads.load_silver(wh, name)
        return loads.load_enriched(wh, every)

    assert run().rows == 1
    # Both are newer than what their own tables hold, and older than the mark of the orders.
    again = run(customers=[("1", "Ann", "x", "bb", "2020-01-01", "2020-01-01", "2020-02-01")], order_items=[("101", "11", "5", "3", "2", "2020-03-01", "2020-03-02")])
    assert again.rows == 2 and again.message.startswith("changed_orders=2")
    now = {t: wh.current(wh.layout.silver, t) for t in ENTITIES}
    full = enrich_sales(now["order_items"], now["orders"], now["customers"], now["products"])
    kept = wh.current(wh.layout.silver, "sales_enriched").select(*full.columns)
    assert rows_of(kept) == rows_of(full) and rows_of(kept.select("order_item_id", "state")) == [(100, "BB"), (101, None)]
    assert run().message.startswith("no changed orders")


def test_loads_of_two_tables_keep_both_marks(spark, tmp_path):
    wh = open_store(spark, tmp_path)
    published = wh.control.view_texts()["pipeline_watermark"]

    def start(name, during=None):
        def change(marks):
            if during:
                during()
            return control.mark_running(marks, control.names(spark, name), F.current_timestamp())
        wh.control.change_marks(change)

    start("orders", during=lambda: start("customers"))
    status = {r["table_name"]: r["status"] for r in wh.control.marks().collect()}
    assert status == {"orders": "RUNNING", "customers": "RUNNING", "products": "INIT", "order_items": "INIT"}
    # A view made before sees what is true now.
    assert rows_of(spark.sql(published).select("table_name", "status")) == rows_of(wh.control.marks().select("table_name", "status"))
