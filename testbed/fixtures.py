"""Retail entities derived from the test tables, as FIXTURES.md defines them."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stratalith.operators.clean import clean
from stratalith.operators.dedup import latest_per_key
from stratalith.operators.versions import DELETED, WROTE
from stratalith.plans import enrich
from stratalith.spec import ENTITIES, ORDERS, TableSpec

T0 = "timestamp_ntz'1995-01-01 00:00:00'"
# First updated_at of batches 1 and 2, buckets of stored merge targets, and the commit time of batches 0, 1 and 2.
BATCH_STARTS = ("1999-01-01 00:00:00", "2000-07-01 00:00:00")
BUCKETS = 8
COMMITS = ("2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00")


# Given tables, and the keys of those whose files tell their bounds.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels")
KEYS = {
    "customer": ("c_custkey", "c_nationkey"), "part": ("p_partkey",), "supplier": ("s_suppkey", "s_nationkey"),
    "orders": ("o_orderkey", "o_custkey"), "lineitem": ("l_orderkey", "l_partkey", "l_linenumber"), "documents": ("doc_id", "n_chars"),
}


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> T.StructType:
    return spark.read.parquet(path).schema


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table; its footers are read for the schema once per session."""
    path = f"{sf_dir}/{table}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def ntz(text: str) -> Column:
    return F.expr(f"timestamp_ntz'{text}'")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = read(spark, sf_dir, "customer").join(
        read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    # Each customer once, and the copies it has, from a single scan.
    copies = base.withColumn("copy", F.explode(F.expr("""
        array_compact(array('base',
            CASE WHEN c_custkey % 7 = 0 THEN 'newer' END,
            CASE WHEN c_custkey % 100 = 1 THEN 'keyless' END,
            CASE WHEN c_custkey % 100 = 2 THEN 'unreadable' END))""")))
    return copies.selectExpr(
        """CASE copy WHEN 'keyless' THEN NULL
                     WHEN 'unreadable' THEN 'bad-' || cast(c_custkey as string)
                     ELSE cast(c_custkey as string) END AS customer_id""",
        "'  ' || c_name || ' ' AS name",
        "CASE copy WHEN 'newer' THEN ' relocated  city ' ELSE ' ' || lower(c_mktsegment) END AS city",
        "lower(n_name) || ' ' AS state",
        f"{T0} + make_dt_interval(cast(c_custkey % 365 as int)) AS signup_date",
        f"{T0} + make_dt_interval(cast(c_custkey % 365 as int)) AS created_at",
        f"""{T0} + make_dt_interval(cast(c_custkey % 365 + c_custkey % 30
                + CASE copy WHEN 'newer' THEN 10 ELSE 0 END as int)) AS updated_at""",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) AS product_id",
        "' ' || p_name || ' ' AS product_name",
        "lower(p_type) AS category",
        "cast(p_retailprice as string) AS price",
        f"{T0} + make_dt_interval(cast(p_partkey % 365 as int)) AS created_at",
        f"{T0} + make_dt_interval(cast(p_partkey % 365 + p_partkey % 30 as int)) AS updated_at",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = read(spark, sf_dir, "orders").withColumn("newer", F.explode(F.expr(
        "CASE WHEN o_orderkey % 10 = 0 THEN array(false, true) ELSE array(false) END"
    )))
    return copies.selectExpr(
        "o_orderkey AS order_id",
        # Some orders name no customer, or one that does not exist; all rows stay.
        "CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN -o_custkey ELSE o_custkey END AS customer_id",
        "o_orderdate AS order_date",
        "CASE WHEN newer THEN ' x ' ELSE ' ' || lower(o_orderstatus) END AS order_status",
        "o_totalprice AS total_amount",
        "o_orderdate AS created_at",
        """o_orderdate + make_dt_interval(cast(o_orderkey % 30
            + CASE WHEN newer THEN 40 ELSE 0 END as int)) AS updated_at""",
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS order_item_id",
        "l_orderkey AS order_id",
        "CASE WHEN l_orderkey % 59 = 0 THEN NULL WHEN l_orderkey % 43 = 0 THEN -l_partkey ELSE l_partkey END AS product_id",
        "l_quantity AS quantity",
        "l_extendedprice AS price",
        "l_shipdate AS created_at",
        "l_shipdate AS updated_at",
    )


RAW = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RAW[name](spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return clean(raw(spark, sf_dir, name), ENTITIES[name])


def latest(df: DataFrame, spec: TableSpec) -> DataFrame:
    return latest_per_key(df, spec.key, spec.order_by)


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return latest(cleaned(spark, sf_dir, name), ENTITIES[name])


def batch_number() -> Column:
    first, second = (ntz(t) for t in BATCH_STARTS)
    at = F.col("updated_at")
    return F.when(at < first, 0).when(at < second, 1).otherwise(2).cast("int")


def order_batch(spark: SparkSession, sf_dir: str, *numbers: int) -> DataFrame:
    """The given batches of cleaned orders together, latest row per order."""
    chosen = cleaned(spark, sf_dir, "orders").filter(batch_number().isin(*numbers))
    return latest(chosen, ORDERS)


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three batches as versions of one table, each reduced to its latest rows first."""
    tagged = cleaned(spark, sf_dir, "orders").withColumn("_version", batch_number())
    reduced = latest_per_key(tagged, ["order_id", "_version"], ORDERS.order_by)
    commit = F.element_at(F.array(*[ntz(t) for t in COMMITS]), F.col("_version") + 1)
    # The last batch takes some orders away again.
    op = F.when((F.col("_version") == 2) & (F.col("order_id") % 17 == 0), DELETED).otherwise(WROTE)
    return reduced.withColumns({"_commit_ts": commit, "_op": op})


def merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Target and source of the merges: ``(batches 0 and 2, batches 0 and 1)``.

    Half of the common orders are newer in the source and half older, both sides have rows that the
    other lacks, and both have rows without a key.
    """
    keyless = F.when(F.col("order_id") % 101 != 0, F.col("order_id"))
    moved = F.expr("updated_at + make_dt_interval(CASE WHEN order_id % 2 = 0 THEN 2000 ELSE -2000 END)")
    target = order_batch(spark, sf_dir, 0, 2).withColumn("order_id", keyless)
    source = order_batch(spark, sf_dir, 0, 1).withColumns({"updated_at": moved, "order_status": F.lit("S"), "order_id": keyless})
    return target, source


# Columns of each entity that arrive as text, with some values that are none of their type.
AS_TEXT = {
    "customers": {"signup_date": "CASE WHEN customer_id LIKE '%7' THEN 'never' ELSE cast(signup_date as string) END"},
    "products": {"price": "CASE WHEN cast(product_id as bigint) % 13 = 5 THEN 'n/a' ELSE price END"},
    "orders": {"total_amount": "CASE WHEN order_id % 97 = 5 THEN 'unknown' WHEN order_id % 97 = 6 THEN NULL ELSE cast(total_amount as string) END"},
    "order_items": {"quantity": "CASE WHEN order_item_id % 31 = 2 THEN 'two' ELSE cast(cast(quantity as int) as string) END"},
}


def as_text(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return raw(spark, sf_dir, name).withColumns({c: F.expr(e) for c, e in AS_TEXT[name].items()})


def hot(spark: SparkSession, sf_dir: str) -> enrich.HotKeys:
    """Join-key statistics of the tables in ``sf_dir``, taken anew for every query."""
    return enrich.HotKeys.of(raw_orders(spark, sf_dir), raw_order_items(spark, sf_dir))


def enriched(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None, few_orders: bool = False, sold: DataFrame | None = None
) -> DataFrame:
    return enrich.enrich_sales(
        silver(spark, sf_dir, "order_items") if sold is None else None,
        silver(spark, sf_dir, "orders") if orders is None else orders,
        silver(spark, sf_dir, "customers"),
        silver(spark, sf_dir, "products") if sold is None else None,
        hot=hot(spark, sf_dir),
        few_orders=few_orders,
        sold=sold,
    )
