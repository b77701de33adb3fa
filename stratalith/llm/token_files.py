"""Token files: the ids of many documents in one array, with Elias-Fano coded document boundaries.

A shard holds a range of documents in ascending id order::

    ids          n_tokens little-endian numbers of ``width`` bytes
    boundaries   Elias-Fano: where each document begins in the array, and the end
    doc ids      Elias-Fano: each id less the smallest one; rows without an id come first and have no entry
    footer       FOOTER below

A document is found by two selects and one range read; no table of 64-bit offsets is kept.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalith.llm.common import new_folder, ship_package, spread
from stratalith.llm.elias_fano import EliasFano, encode
from stratalith.llm.encoding import encoder_for

MAGIC = b"EFTOKENS"
FOOTER = struct.Struct("<8sQQQqQQQ")  # magic, documents, documents without id, tokens, smallest id, width, bytes of boundaries, bytes of ids
# Ids that are held at a time when a shard is read.
READ_TOKENS = 1 << 20
# Documents of which the ids are held at a time when a shard is written.
WRITE_DOCS = 256


class ShardWriter:
    """Writes under a name of its own and renames at the end, so a repeated task leaves one whole file."""

    def __init__(self, folder: str, name: str, width: int):
        self.files, base = pa.fs.FileSystem.from_uri(folder)
        self.part, self.path = f"{base}/.{name}-{uuid.uuid4().hex}", f"{base}/{name}"
        self.out = self.files.open_output_stream(self.part)
        self.width, self.starts, self.doc_ids, self.total = width, [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.starts.append(self.total)
        self.doc_ids.append(doc_id)
        self.total += len(ids) // self.width
        self.out.write(ids)

    def close(self) -> tuple[int, int]:
        known = np.array([x for x in self.doc_ids if x is not None], np.int64)
        smallest = int(known[0]) if len(known) else 0
        boundaries = encode(np.array([*self.starts, self.total], np.uint64))
        numbers = encode(known.astype(np.uint64) - np.uint64(smallest % (1 << 64)))
        self.out.write(boundaries + numbers)
        self.out.write(FOOTER.pack(MAGIC, len(self.doc_ids), len(self.doc_ids) - len(known), self.total, smallest, self.width, len(boundaries), len(numbers)))
        self.out.close()
        self.files.move(self.part, self.path)
        return len(self.doc_ids), self.total


class ShardReader:
    """Range reads only; a document's ids cost two selects and one read."""

    def __init__(self, uri: str):
        files, path = pa.fs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        magic, self.n, self.n_null, self.total, self.smallest, self.width, n_bounds, n_ids = FOOTER.unpack(self.file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        code = self.file.read_at(n_bounds + n_ids, size - FOOTER.size - n_bounds - n_ids)
        self.boundaries, self.numbers = EliasFano(code[:n_bounds]), EliasFano(code[n_bounds:])

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.smallest + self.numbers.select(i - self.n_null)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of places ``first`` to ``last`` of the array."""
        return np.frombuffer(self.file.read_at((last - first) * self.width, first * self.width), f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.boundaries.select(i), self.boundaries.select(i + 1))

    def __iter__(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc_id, start, ids)`` of every document, reading about READ_TOKENS ids at a time; selects find the end of each run."""
        first = 0
        while first < self.n:
            last = max(first + 1, self.boundaries.locate(self.boundaries.select(first) + READ_TOKENS))
            bounds = self.boundaries.run(first, last + 1).tolist()
            numbers = self.numbers.run(max(0, first - self.n_null), max(0, last - self.n_null)).tolist()
            ids = self.ids(bounds[0], bounds[-1])
            known = [None] * (last - first - len(numbers)) + [self.smallest + x for x in numbers]
            for doc_id, begin, end in zip(known, bounds, bounds[1:]):
                yield doc_id, begin, ids[begin - bounds[0] : end - bounds[0]]
            first = last


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> tuple[str, list[dict]]:
    """Encode ``docs`` in ascending id order into shards of ``folder``; gives the folder and its manifest.

    ``tokenizer`` is the path of a tokenizers description, read on the driver and sent to the tasks.
    Null texts count as empty, every document ends with ``end_id``; rows without an id come first;
    repeated ids follow each other in an order that their texts fix. The manifest has one entry for
    each shard that has documents; it is also written to ``manifest.json``. An empty table gives none.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or new_folder(spark, "token-files")
    with open(tokenizer, encoding="utf-8") as source:
        description = source.read()
    from tokenizers import Tokenizer

    width = 2 if max(Tokenizer.from_str(description).get_vocab_size(with_added_tokens=True), end_id + 1) <= 1 << 16 else 4
    sent = spark.sparkContext.broadcast(description)
    end = np.array([end_id], f"<u{width}").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = None
        shard = TaskContext.get().partitionId()
        for batch in batches:
            for k in range(0, batch.num_rows, WRITE_DOCS):
                if writer is None:
                    encoder, writer = encoder_for(sent.value, f"<u{width}"), ShardWriter(folder, f"shard-{shard:06d}", width)
                part = batch.slice(k, WRITE_DOCS)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode([x or "" for x in part.column(1).to_pylist()])):
                    writer.add(doc_id, ids + end)
        if writer is not None:
            n_docs, n_tokens = writer.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([n_tokens], pa.int64())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    rows = rows.repartitionByRange(spread(docs), F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie, "text")
    shards = sorted(rows.mapInArrow(write, "shard long, n_docs long, n_tokens long").collect())
    manifest, start = [], 0
    for shard, n_docs, n_tokens in shards:
        manifest.append({"file": f"shard-{shard:06d}", "start": start, "n_docs": n_docs, "n_tokens": n_tokens})
        start += n_tokens
    files, base = pa.fs.FileSystem.from_uri(folder)
    with files.open_output_stream(f"{base}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return folder, manifest


def read_token_files(spark: SparkSession, folder: str, manifest: list[dict] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files; one task per shard."""
    ship_package(spark)
    if manifest is None:
        files, base = pa.fs.FileSystem.from_uri(folder)
        with files.open_input_stream(f"{base}/manifest.json") as source:
            manifest = json.loads(source.read())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows: list[tuple] = []
                for doc_id, start, ids in ShardReader(f"{folder}/{file}"):
                    rows.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    shards = spark.createDataFrame([(x["file"], x["start"]) for x in manifest], "file string, start long")
    return shards.repartition(max(1, len(manifest)), "file").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])
