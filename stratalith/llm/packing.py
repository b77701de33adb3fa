"""Packing documents into sequences of a fixed length, online and in bounded space.

Every partition keeps a fixed number of open windows. A document's pieces go to the window that they
fill best; if none has room, the fullest one is filled up with a cut piece and emitted. What is open at
the end of a partition is merged there, and the one window that stays partial is merged with those of
other partitions in groups, level by level.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from stratalith.llm.common import settled, ship_package
from stratalith.llm.encoding import encoder_for

LENGTH = 2048
OPEN = 32
# A gap below this is padded rather than filled with a scrap of a document.
SCRAP = 8
# Partial windows that are merged by one task.
MERGE = 256
WRITE_DOCS = 256
COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long, ids binary"
_TYPES = [pa.int64()] * 8 + [pa.binary()]
_NAMES = [x.split()[0] for x in COLUMNS.split(", ")]


class Packer:
    """``ids`` are little-endian 32-bit numbers; a piece is ``(doc_id, start, doc_tokens, ids)``."""

    def __init__(self, part: int, level: int = 0, length: int = LENGTH, n_open: int = OPEN, scrap: int = SCRAP):
        self.part, self.length, self.n_open, self.scrap = part, length, n_open, scrap
        self.next_id = (level << 56) | (part << 32)
        self.windows: list[list] = []  # [used, pieces]
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, total, ids in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self.next_id, offset, None, None))
            offset += n
        self.next_id += 1

    def add(self, doc_id: int | None, start: int, total: int, ids: bytes) -> None:
        n, at = len(ids) // 4, 0
        while n - at >= self.length:
            self.emit([(doc_id, start + at, total, ids[4 * at : 4 * (at + self.length)])])
            at += self.length
        while at < n:
            need = n - at
            fit = [w for w in self.windows if self.length - w[0] >= need]
            if not fit and len(self.windows) < self.n_open:
                fit = [[0, []]]
                self.windows += fit
            if fit:
                window, take = max(fit, key=lambda w: w[0]), need
            else:
                window = max(self.windows, key=lambda w: w[0])
                take = self.length - window[0]
            if fit or take >= self.scrap:
                window[0] += take
                window[1].append((doc_id, start + at, total, ids[4 * at : 4 * (at + take)]))
                at += take
            if not fit or window[0] == self.length:
                self.windows.remove(window)
                self.emit(window[1])

    def merge(self) -> None:
        """Fill the fullest open window from the emptiest one, until at most one is partial."""
        self.windows.sort(key=lambda w: -w[0])
        while len(self.windows) > 1:
            full, empty = self.windows[0], self.windows[-1]
            while full[0] < self.length and empty[1]:
                doc_id, start, total, ids = empty[1].pop()
                n = len(ids) // 4
                take = min(n, self.length - full[0])
                full[1].append((doc_id, start, total, ids[: 4 * take]))
                if take < n:
                    empty[1].append((doc_id, start + take, total, ids[4 * take :]))
                full[0] += take
                empty[0] -= take
            if not empty[1]:
                self.windows.pop()
            if full[0] == self.length:
                self.emit(full[1])
                self.windows.pop(0)

    def rest(self, last: bool) -> None:
        """What is left: a sequence if nothing follows, else rows for the next level."""
        self.merge()
        for _, pieces in self.windows:
            if last:
                self.emit(pieces)
            else:
                self.rows += [(d, s, len(i) // 4, None, t, None, None, self.part, i) for d, s, t, i in pieces]
        self.windows = []

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * len(_NAMES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, _TYPES)], _NAMES)


def packed(docs: DataFrame, tokenizer: str, end_id: int, length: int = LENGTH, n_open: int = OPEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``: one row per piece.

    A document is its ids and ``end_id``; null texts count as empty and are packed as their end id
    alone. Only pieces that are cut at a sequence's end part a document; each id lies in exactly one
    piece. Rows of equal ids are packed as documents of their own. Other columns are ignored; an empty
    table gives no rows. Texts are not shuffled. Each level of merging takes one partial window of at
    most ``length`` ids from each task before it, MERGE of them per task.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer, encoding="utf-8") as source:
        sent = spark.sparkContext.broadcast(source.read())
    end = np.array([end_id], "<u4").tobytes()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = None, Packer(TaskContext.get().partitionId(), 0, length, n_open)
        for batch in batches:
            if encoder is None:
                encoder = encoder_for(sent.value)
            for k in range(0, batch.num_rows, WRITE_DOCS):
                part = batch.slice(k, WRITE_DOCS)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode([x or "" for x in part.column(1).to_pylist()])):
                    packer.add(doc_id, 0, len(ids) // 4 + 1, ids + end)
                if len(packer.rows) > 5000:
                    yield packer.taken()
        packer.rest(last=False)
        yield packer.taken()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    level, stages = 1, [settled(rows.mapInArrow(place, COLUMNS), "placed")]
    parts = stages[0].agg(F.max("part")).first()[0]
    while parts is not None:
        last = parts < MERGE
        left = stages[-1].where("part is not null").withColumn("part", F.floor(F.col("part") / MERGE))
        stages.append(settled(left.groupBy("part").applyInArrow(_merging(level, last, length, n_open), COLUMNS), "merged"))
        parts, level = None if last else parts // MERGE, level + 1
    pieces = stages[0]
    for stage in stages[1:]:
        pieces = pieces.union(stage)
    return pieces.where("part is null").select(*_NAMES[:7])


def _merging(level: int, last: bool, length: int, n_open: int):
    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["doc_id", "start", "doc_tokens", "ids", "part"]).to_pylist(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["ids"]))
        packer = Packer(rows[0]["part"], level, length, n_open)
        for r in rows:
            packer.add(r["doc_id"], r["start"], r["doc_tokens"], r["ids"])
        packer.rest(last)
        return pa.Table.from_batches([packer.taken()])

    return merge
