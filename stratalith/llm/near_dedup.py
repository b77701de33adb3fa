"""Near-duplicate documents by MinHash with tensored banding.

Ordinary banding needs as many bands as there are tables. Here two collections of ``m`` short bands
are computed, each band being ``half`` minhashes; a table is a *pair* of bands, one from each
collection, so ``2 m half`` minhashes serve ``m * m`` tables. Two sets of similarity ``s`` share a
table with probability ``(1 - (1 - s ** half) ** m) ** 2``; ``m`` is chosen so that a pair exactly at
the threshold is missed with at most probability ``miss``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalith.llm.common import MIX, U64, block_minima, few_files, hot_among, hot_in, mixed, parts_of, release, separators, settled, shingles_of, ship_package
from stratalith.llm.components import components
from stratalith.llm.encoding import forget
from stratalith.operators.joins import spread_join

HALF = 4
MISS = 1e-4
# Documents of one block; a task compares two blocks at a time.
BLOCK = 512
# Columns of the incidence matrix that are multiplied at a time.
COLUMNS = 4096
# Shingles whose least hashes are taken side by side.
LANE = 16
_CUTS = separators()


def bands_needed(threshold: float, half: int = HALF, miss: float = MISS) -> int:
    return math.ceil(math.log(miss / 2) / math.log(1 - threshold**half))


def shingles(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The distinct window hashes of each text, ascending. Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased."""
    return [np.unique(x) for x in shingles_of([x.encode().lower() if x else b"" for x in texts], _CUTS, size, short=True)]


def half_bands(sets: list[np.ndarray], m: int, half: int) -> np.ndarray:
    """``2 m`` band hashes of each set that is not empty, a column each; the first ``m`` are the left collection."""
    seeds = mixed(np.arange(1, 2 * m * half + 1, dtype=U64) * U64(MIX[0]))
    seeds = (seeds >> U64(32)).astype(np.uint32)[:, None], (seeds.astype(np.uint32) | np.uint32(1))[:, None]
    least, starts = block_minima(sets, seeds, LANE)
    rows = np.minimum.reduceat(least, starts[:-1], axis=1).astype(U64).reshape(2 * m, half, len(sets))
    bands = np.repeat((np.arange(1, 2 * m + 1, dtype=U64) * U64(MIX[1]))[:, None], len(sets), axis=1)
    for k in range(half):
        bands = mixed(bands * U64(MIX[0]) + rows[:, k])
    return bands


def sketches(docs: DataFrame, size: int, m: int, half: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, digest, bands``; bands are null for documents without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for first, texts in parts_of(batch.column(1)):
                sets = shingles(texts, size)
                some = [s for s in sets if len(s)]
                bands = iter(half_bands(some, m, half).T.view(np.int64) if some else [])
                digests = (mixed(s).sum(dtype=U64).tobytes() + np.bitwise_xor.reduce(mixed(s + U64(1))).tobytes() for s in some)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)), pa.array(list(map(len, sets)), pa.int64()),
                        pa.array([next(digests) if len(s) else None for s in sets], pa.binary()), pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "digest", "bands"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        sketch, "doc_id long, n_shingles long, digest binary, bands array<long>"
    )


def set_rows(docs: DataFrame, size: int) -> DataFrame:
    """``node, shingles``: the whole set of each document as packed 64-bit hashes."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few at a time, as packed sets take several times the room of the texts.
            for first, texts in parts_of(batch.column(1)):
                sets = [s.tobytes() for s in shingles(texts, size)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), pa.array(sets, pa.binary())], ["node", "shingles"])

    return docs.mapInArrow(pack, "node long, shingles binary")


def linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The settled pairs ``(a, b)`` whose full sets reach the similarity. The set of an ``a`` with very many pairs goes to several tasks."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for one, two in zip(batch.column(2), batch.column(3)):
                one, two = np.frombuffer(one.as_py(), U64), np.frombuffer(two.as_py(), U64)
                if len(one) > len(two):
                    one, two = two, one
                at = np.searchsorted(two, one)
                at[at == len(two)] = 0
                shared = int((two[at] == one).sum())
                hit.append(100 * shared >= percent * (len(one) + len(two) - shared))
            yield batch.select([0, 1]).filter(pa.array(hit, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    met = spread_join(pairs, left, "a", "inner", row_id="b", hot=hot_in(pairs, "a"))
    return met.join(right, "b").select("a", "b", "left", "right").mapInArrow(confirm, "a long, b long")


def block_links(percent: int):
    """For rows of two blocks: links between different components, as many as connect them at most."""

    def compare(table: pa.Table) -> pa.Table:
        nodes, parts, blocks = (table.column(c).to_numpy() for c in ("node", "component", "block"))
        sets = [np.frombuffer(x.as_py(), U64) for x in table.column("shingles")]
        sizes = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # A hash that only one of the sets has adds to no intersection.
        keep = often[column] > 1
        number = np.cumsum(often > 1) - 1
        owner, column = owner[keep], number[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            lo, hi = np.searchsorted(column, (start, start + COLUMNS))
            part = np.zeros((len(sets), COLUMNS), np.float32)
            part[owner[lo:hi], column[lo:hi] - start] = 1
            shared += part @ part.T
        union = sizes[:, None] + sizes[None, :] - shared
        near = (100 * shared >= percent * union) & (parts[:, None] < parts[None, :])
        if blocks.min() != blocks.max():
            near &= blocks[:, None] != blocks[None, :]
        one, two = np.nonzero(near)
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        links = []
        _, first = np.unique(np.stack([parts[one], parts[two]]), axis=1, return_index=True) if len(one) else (None, [])
        for k in first:
            x, y = top(parts[one[k]]), top(parts[two[k]])
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((int(nodes[one[k]]), int(nodes[two[k]])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return compare


def near_duplicates(
    docs: DataFrame, size: int = 3, percent: int = 85, half: int = HALF, miss: float = MISS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents whose sets of ``size``-word shingles have ``100 * intersection >= percent * union`` are
    linked; a component is named by its smallest id, and that document is kept.

    1. Equal sets become one node, named by its smallest id, with partial aggregation.
    2. A band that only one node has cannot lead to a partner and is dropped, before bands are paired
       to table keys; most documents end here.
    3. In each table every node is compared with the table's smallest node only, which costs one row
       per node and table however large the table is. Full sets confirm, components are formed.
    4. Tables that still hold several components are compared in full. No pairs are emitted for it:
       the nodes are dealt to blocks by left band, two blocks meet in one task, which counts all
       intersections by a matrix product and returns at most the links that join components.

    Null and empty texts, and texts of white space, have no shingles and stay alone. Rows of one
    ``doc_id`` count as one document. Rows without an id join a component but never name one; where
    all ids of a group of equal sets are null, the component is null and the rows are kept. Other
    columns are ignored. Empty tables give no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    m = bands_needed(percent / 100, half, miss)
    sketch = settled(sketches(docs, size, m, half, id_col, text_col), "sketches")
    nodes = sketch.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("n"))
    nodes = settled(few_files(nodes), "nodes")
    bands = nodes.where("node is not null").select("node", F.posexplode("bands").alias("slot", "band"))
    common = settled(few_files(bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")), "common-bands")
    bands = settled(few_files(spread_join(bands, common.select("band"), "band", "inner", row_id="node", hot=hot_among(common, "band"))), "bands")
    tables = (
        bands.groupBy("node")
        .agg(F.collect_list(F.when(F.col("slot") < m, F.col("band"))).alias("left"), F.collect_list(F.when(F.col("slot") >= m, F.col("band"))).alias("right"))
        .select("node", F.explode("left").alias("left"), "right")
        .select("node", "left", F.explode("right").alias("right"))
        .select("node", F.xxhash64("left", "right").alias("table"))
    )
    heads = tables.groupBy("table").agg(F.min("node").alias("head"), F.max("node").alias("tail"), F.count(F.lit(1)).alias("n"))
    heads = settled(few_files(heads.where("head < tail").select("table", "head", "n")), "heads")
    hot_tables = hot_among(heads, "table")
    tables = settled(few_files(spread_join(tables, heads.select("table", "head"), "table", "inner", row_id="node", hot=hot_tables)), "tables")
    release(spark, common, heads)
    hot_heads = hot_in(tables, "head")
    # Full sets of the nodes that meet another one in some table.
    wanted = tables.select("node").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    # Rows that repeat an id and its text are dropped before the sets are made, which are larger.
    sets = settled(few_files(set_rows(texts.join(wanted, "node", "left_semi").select("node", "text").distinct(), size), 4, 4), "sets")

    def of_components(links: DataFrame) -> DataFrame:
        return components(links.select("a", "b"))

    first = settled(few_files(tables.where("node <> head").groupBy(F.col("node").alias("b")).agg(F.min("head").alias("a")).select("a", "b")), "pairs")
    named = of_components(linked_pairs(first, sets, percent))
    for step in ("heads", "blocks"):
        placed = tables.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
        if step == "heads":
            at_head = named.select(F.col("node").alias("head"), F.col("component").alias("at_head"))
            apart = spread_join(placed, at_head, "head", "left", row_id="node", hot=hot_heads).where(F.col("component") != F.coalesce("at_head", "head"))
            more = linked_pairs(settled(few_files(apart.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()), "pairs"), sets, percent)
        else:
            open_tables = placed.groupBy("table").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("table")
            open_nodes = spread_join(placed, open_tables, "table", "left_semi", row_id="node", hot=hot_tables)
            open_nodes = settled(few_files(open_nodes.select("node", "component").distinct()), "open")
            more = _open_links(open_nodes, bands.where(F.col("slot") < m), sets, percent)
        joined = named.select("node", "component")
        more = settled(few_files(more, 4, 4), "links")
        edges = more.join(joined.withColumnsRenamed({"node": "b", "component": "cb"}), "b", "left")
        edges = spread_join(edges, joined.withColumnsRenamed({"node": "a", "component": "ca"}), "a", "left", row_id="b", hot=hot_in(more, "a"))
        merged = of_components(edges.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
        above = merged.select(F.col("node").alias("component"), F.col("component").alias("above"))
        kept_names = spread_join(named, above, "component", "left", row_id="node", hot=hot_in(named, "component")).select("node", F.coalesce("above", "component").alias("component"))
        fresh = merged.join(named, "node", "left_anti").select("node", "component")
        now = settled(few_files(kept_names.union(fresh)), "named")
        release(spark, named, merged, more)
        named = now
    release(spark, tables, bands, sets)
    labelled = nodes.select("digest", "node").join(named, "node", "left").select("digest", F.coalesce("component", "node").alias("named"))
    rows = sketch.select("doc_id", "n_shingles", "digest")
    result = spread_join(rows, labelled, "digest", "left", row_id="doc_id", hot=hot_among(nodes, "digest"))
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("named"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _open_links(open_nodes: DataFrame, left_bands: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    members = left_bands.join(open_nodes, "node").select("band", "node", "component")
    sized = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    sized = settled(few_files(sized), "open-bands")
    dealt = spread_join(members, sized.select("band", blocks.alias("blocks")), "band", "inner", row_id="node", hot=hot_among(sized, "band")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("band", "node", "component", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    return met.join(sets, "node").groupBy("band", "x", "y").applyInArrow(block_links(percent), "a long, b long")
