"""Benchmark decontamination: short test items are found inside long documents.

Containment is looked for with MinHash, which measures resemblance: a short item resembles a long
document little, however fully it is contained. So items are partitioned by size, and for each size
class with ``u / 2`` to ``u`` shingles a document is read as windows of ``2 u`` shingles that overlap by
``u``. An item with containment ``t`` resembles the window that holds it by ``(t / 2) / (2 + (1 - t) / 2)``
at least, whatever the document's length, and so many minhashes are taken that it shares none with
probability MISS at most. Windows of all classes come from the same block minima, halving their number
from class to class. An item so short that all its shingles are needed is looked for by the one that
is its minimum. Every item that shares a minhash is verified by exact containment of its shingles
in the whole document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalith.llm.common import MIX, U64, block_minima, few_files, hot_in, mixed, parts_of, separators, settled, shingles_of, ship_package
from stratalith.operators.joins import spread_join

WORDS = 5
PERCENT = 80
MISS = 1e-6
# Bytes of item sketches and shingles that are sent to the tasks at a time.
BLOCK_BYTES = 32 << 20
# Every ASCII character but letters and digits separates words.
_CUTS = separators("".join(chr(x) for x in range(128) if chr(x).isalnum()))


def minhashes_needed(percent: int, miss: float = MISS) -> int:
    t = percent / 100
    return math.ceil(math.log(miss) / math.log(1 - (t / 2) / (2 + (1 - t) / 2)))


def _seeds(k: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, k + 1, dtype=U64) * U64(MIX[2]))
    return (seeds >> U64(32)).astype(np.uint32)[:, None], (seeds.astype(np.uint32) | np.uint32(1))[:, None]


def size_class(n: int) -> int:
    """The least power of two that is at least ``n``."""
    return 1 << (n - 1).bit_length()


class Keys:
    """Sorted keys with their owners; a bit table answers for most keys that are not there."""

    def __init__(self, keys: np.ndarray, owners: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]
        self.shift = U64(64 - max(8, (16 * len(keys)).bit_length()))
        self.bits = np.zeros(1 << (64 - int(self.shift)), bool)
        self.bits[self._slot(self.keys)] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * U64(MIX[0])) >> self.shift

    def owners_of(self, wanted: np.ndarray) -> set[int]:
        some = np.unique(wanted[self.bits[self._slot(wanted)]])
        low, high = np.searchsorted(self.keys, some, side="left"), np.searchsorted(self.keys, some, side="right")
        return {o for a, b in zip(low, high) for o in self.owners[a:b].tolist()}

    def among(self, wanted: np.ndarray) -> np.ndarray:
        """The indices of the wanted keys that are there."""
        some = np.flatnonzero(self.bits[self._slot(wanted)])
        at = np.minimum(np.searchsorted(self.keys, wanted[some]), len(self.keys) - 1)
        return some[self.keys[at] == wanted[some]]


class Items:
    """A block of distinct item sets, ready to be looked up."""

    def __init__(self, sets: list[np.ndarray], k: int, percent: int):
        self.k, self.percent, self.sets = k, percent, sets
        self.seeds = _seeds(k)
        sizes = np.array([len(s) for s in sets], np.int64)
        # All shingles of these are needed, so their least one must be in the document.
        tiny = sizes * (100 - percent) < 100
        few = np.flatnonzero(tiny)
        self.tiny = Keys(np.array([sets[m][0] for m in few], U64), few) if len(few) else None
        classes = np.array([0 if t else size_class(int(n)) for t, n in zip(tiny, sizes)], np.int64)
        self.tables = {}
        for u in sorted(set(classes.tolist()) - {0}):
            members = np.flatnonzero(classes == u)
            marks = np.concatenate([block_minima([sets[m]], self.seeds, len(sets[m]))[0] for m in members], axis=1).astype(U64)
            self.tables[u] = Keys(((np.arange(k, dtype=U64) << U64(32))[:, None] | marks).reshape(-1), np.tile(members, k))
        if self.tables:
            every = np.unique(np.concatenate([t.keys for t in self.tables.values()]))
            # Of each minhash the values that any class knows, so that a document's minima are looked up once for all classes.
            numbers, marks = (every >> U64(32)).astype(np.int64), (every & U64(0xFFFFFFFF)).astype(np.uint32)
            edges = np.searchsorted(numbers, np.arange(k + 1))
            self.known = [marks[a:b] for a, b in zip(edges[:-1], edges[1:])]
            bits = max(10, (16 * max(map(len, self.known))).bit_length())
            self.shift = np.uint32(32 - min(bits, 24))
            self.seen = np.zeros((k, 1 << (32 - int(self.shift))), bool)
            for row, own in zip(self.seen, self.known):
                row[own >> self.shift] = True

    def hits(self, texts: list[np.ndarray]) -> list[list[tuple[int, int]]]:
        """``(item, shared shingles)`` of the items contained in each document, given by its shingles in order."""
        found: list[set[int]] = [set() for _ in texts]
        if self.tiny and texts:
            sizes = np.array([len(x) for x in texts])
            ends = np.cumsum(sizes)
            places = self.tiny.among(np.concatenate(texts))
            for d in np.unique(np.searchsorted(ends, places, side="right")).tolist():
                found[d] |= self.tiny.owners_of(texts[d])
        if self.tables:
            length = min(self.tables)
            least, starts = block_minima(texts, self.seeds, length)
            for d in self._met(least, starts):
                found[d] |= self._candidates(least[:, starts[d] : starts[d + 1]], length)
        out = []
        for shingles, candidates in zip(texts, found):
            whole = np.unique(shingles) if candidates else shingles
            out.append([(c, shared) for c in sorted(candidates) if 100 * (shared := self._shared(whole, c)) >= self.percent * len(self.sets[c])])
        return out

    def _met(self, least: np.ndarray, starts: np.ndarray) -> list[int]:
        """Texts one of whose block minima is one of an item: the minimum of a window is that of one of its blocks."""
        met: set[int] = set()
        for own, known, seen in zip(least, self.known, self.seen):
            some = np.flatnonzero(seen[own >> self.shift])
            if len(some) and len(known):
                at = np.minimum(np.searchsorted(known, own[some]), len(known) - 1)
                some = some[known[at] == own[some]]
                met.update((np.searchsorted(starts, some, side="right") - 1).tolist())
        return sorted(met)

    def _candidates(self, least: np.ndarray, length: int) -> set[int]:
        """Items that share a minhash with a window of a text, given by the minima of its blocks."""
        out: set[int] = set()
        numbers = (np.arange(self.k, dtype=U64) << U64(32))[:, None]
        for u, table in self.tables.items():
            while length < u:
                least = np.minimum.reduceat(least, np.arange(0, least.shape[1], 2), axis=1)
                length *= 2
            pairs = np.minimum(least[:, :-1], least[:, 1:]) if least.shape[1] > 1 else least
            out |= table.owners_of((numbers | pairs.astype(U64)).reshape(-1))
        return out

    def _shared(self, whole: np.ndarray, item: int) -> int:
        own = self.sets[item]
        at = np.searchsorted(whole, own)
        at[at == len(whole)] = 0
        return int((whole[at] == own).sum())


def shingles_in_order(texts: list[str | None], size: int) -> list[np.ndarray]:
    """The shingles of each text: of lower-cased runs of ASCII letters, digits and all characters beyond ASCII."""
    return shingles_of([x.lower().encode() if x else b"" for x in texts], _CUTS, size, short=False)


def item_sets(items: DataFrame, size: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(item_id, item)`` of every item with shingles, and ``(item, shingles)`` of the distinct sets of shingles."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(x) for x in shingles_in_order(batch.column(1).to_pylist(), size)]
            some = [i for i, s in enumerate(sets) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(some, pa.int64())), pa.array([sets[i].tobytes() for i in some], pa.binary())], ["item_id", "shingles"]
            )

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).mapInArrow(sketch, "item_id long, shingles binary")
    rows = settled(rows.withColumn("item", F.sha2("shingles", 256)), "items")
    # Copies of one item are one set; only its digest is shuffled for that, with partial aggregation.
    sets = rows.groupBy("item").agg(F.first("shingles").alias("shingles"))
    return rows.select("item_id", "item"), settled(few_files(sets), "item-sets")


def item_blocks(sets: DataFrame, percent: int) -> Iterator[tuple[list[str], Items]]:
    """The distinct sets in blocks of about BLOCK_BYTES, one after the other, each small enough to be sent to every task."""
    k = minhashes_needed(percent)
    size_of = sets.agg(F.sum(F.octet_length("shingles") + F.lit(16 * k)).alias("bytes")).first()["bytes"] or 0
    blocks = -(-size_of // BLOCK_BYTES)
    for b in range(blocks):
        block = sets.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect() if blocks > 1 else sets.collect()
        if block:
            block.sort(key=lambda r: r["item"])
            yield [r["item"] for r in block], Items([np.frombuffer(r["shingles"], U64) for r in block], k, percent)


def leaks(docs: DataFrame, items: DataFrame, size: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, item_shingles, shared_shingles, containment`` of every contained item.

    An item is contained in a document if at least ``percent`` of its distinct shingles of ``size`` words
    occur in it. Items with equal shingles are looked up once, and all of them are reported. They are sent to the tasks in blocks of bounded
    size, one at a time: the documents are read once for each block and never shuffled, and what a block finds is
    written before the next one is collected. Null and empty texts, and texts with fewer than
    ``size`` words, have no shingles and neither contain nor are contained. Repeated rows of either side
    give repeated rows. Other columns are ignored. Empty tables give no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    named, sets = item_sets(items, size, item_id_col, item_text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = none = spark.createDataFrame([], _HITS)
    for names, block in item_blocks(sets, percent):
        sent = spark.sparkContext.broadcast((names, block))
        found = found.union(settled(rows.mapInArrow(_finder(sent, size), _HITS), "hits"))
        sent.destroy()
    # Hits of an item that very many documents hold are spread over the tasks.
    hot = hot_in(found, "item") if found is not none else []
    return spread_join(found, named, "item", "inner", row_id="doc_id", hot=hot).select(
        "doc_id", "item_id", "item_shingles", "shared_shingles", (F.col("shared_shingles") / F.col("item_shingles")).alias("containment")
    )


_HITS = "doc_id long, item string, item_shingles long, shared_shingles long"


def _finder(sent, size: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, block = sent.value
        for batch in batches:
            out = []
            for k, part in parts_of(batch.column(1)):
                for d, hits in enumerate(block.hits(shingles_in_order(part, size)), k):
                    out += [(batch.column(0)[d].as_py(), names[item], len(block.sets[item]), shared) for item, shared in hits]
            columns = list(zip(*out)) or [[]] * 4
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], ["doc_id", "item", "item_shingles", "shared_shingles"])

    return find


def without_leaks(docs: DataFrame, items: DataFrame, size: int = WORDS, percent: int = PERCENT, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns; see :func:`leaks`. Nothing is shuffled.

    With several blocks of items each but the last writes the rows that it leaves, so that one block is held at a time.
    """
    spark = docs.sparkSession
    ship_package(spark)
    _, sets = item_sets(items, size, item_id_col, item_text_col)
    last = None
    for _, block in item_blocks(sets, percent):
        if last is not None:
            docs = settled(docs, "without-leaks")
            last.destroy()
        last = spark.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index(text_col))
                kept = [not hits for _, part in parts_of(texts) for hits in sent.value.hits(shingles_in_order(part, size))]
                yield batch.filter(pa.array(kept, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
