"""What the operators share: the shared folder, partition counts, words and their hashes."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

U64 = np.uint64
# Shingles that are hashed together for block minima.
MINIMA_STEP = 1 << 15
# Odd multipliers that mix 64-bit hashes; any fixed odd numbers would do.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_local_folders: dict[str, str] = {}
_shipped: set[str] = set()
# Where each settled result lies, as long as someone holds it.
_settled: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session that names none gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = "file://" + tempfile.mkdtemp(prefix="stratalith-")
    return _local_folders[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
    return path


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write a result that later steps read more than once, and read it back: lost executors cost no recomputation."""
    path = new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    _settled[read] = path
    return read


def release(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete settled results that nothing reads any more."""
    for df in frames:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_settled.pop(df))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def few_files(df: DataFrame, a_core: int = 2, joined: int = 16) -> DataFrame:
    """The same rows in ``a_core`` partitions a core at most, or in one for ``joined`` shuffle partitions where that is more.

    Each file that a task writes costs more than the few rows in it, and on a local disk a process that is started beside the
    executor. A task takes its partitions one after another, so it holds no more at once. The default is for results that are small beside the documents.
    """
    spark = df.sparkSession
    return df.coalesce(max(a_core * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // joined))


def hot_among(counts: DataFrame, key: str, n: str = "n") -> list:
    """The keys of ``counts(key, n)`` that hold more than half of what a shuffle partition should hold of all rows.

    They are twice as many as there are partitions at most. They steer placement only: see ``spread_join``.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    floor = total / (2 * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return [r[0] for r in counts.where((F.col(n) > floor) & F.col(key).isNotNull()).select(key).collect()]


def hot_in(rows: DataFrame, key: str) -> list:
    """The same of ``rows``, which are counted by key with partial aggregation."""
    return hot_among(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key)


def spread(df: DataFrame) -> int:
    """How many partitions a shuffle of all of ``df`` should have: it grows with the files that are scanned."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers, so that every bit depends on every other."""
    values = values ^ (values >> U64(31))
    values = values * U64(MIX[1])
    values = values ^ (values >> U64(29))
    values = values * U64(MIX[2])
    return values ^ (values >> U64(32))


# Characters of texts that are looked at together.
PART_CHARS = 1 << 18
# Bytes of texts whose words are hashed together.
HASH_BYTES = 1 << 18
_BYTE = mixed(np.arange(1, 257, dtype=U64) * U64(MIX[0])) | U64(1)
_UP = np.cumprod(np.concatenate([np.ones(1, U64), np.full(HASH_BYTES, MIX[1], U64)]))
_DOWN = np.cumprod(np.concatenate([np.ones(1, U64), np.full(HASH_BYTES, pow(MIX[1], -1, 1 << 64), U64)]))


def word_hashes(texts: list[bytes], cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, one text after another, and where each text begins among them; and the end.

    ``cuts`` tells of each byte whether it separates words; the line end must. A word's hash is a mix of the sum of its bytes'
    random numbers, each times a power for its place, so all words come from one running sum, with no step per word.
    """
    hashes, counts = [], np.zeros(len(texts), np.int64)
    held: list[int] = []
    size = 0
    for k, text in enumerate(texts):
        if held and size + len(text) >= HASH_BYTES:
            _add_words([texts[j] for j in held], held, cuts, hashes, counts)
            held, size = [], 0
        held.append(k)
        size += len(text) + 1
    if held:
        _add_words([texts[j] for j in held], held, cuts, hashes, counts)
    starts = np.concatenate([[0], np.cumsum(counts)])
    return np.concatenate(hashes) if hashes else np.empty(0, U64), starts


def _add_words(texts: list[bytes], held: list[int], cuts: np.ndarray, hashes: list[np.ndarray], counts: np.ndarray) -> None:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = np.concatenate([[False], ~cuts[data]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    bounds = np.cumsum([0, *(len(x) + 1 for x in texts)])
    at = np.searchsorted(starts, bounds)
    counts[held] = np.diff(at)
    if len(data) <= HASH_BYTES:
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(_BYTE[data] * _UP[: len(data)])])
        hashes.append(mixed((sums[ends] - sums[starts]) * _DOWN[starts]))
        return
    # A long text, in pieces; what a word has in each piece is added up, times the power of the place where it goes on.
    total = np.zeros(len(starts), U64)
    for begin in range(0, len(data), HASH_BYTES):
        part = data[begin : begin + HASH_BYTES]
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(_BYTE[part] * _UP[: len(part)])])
        lo, hi = np.searchsorted(ends, begin, side="right"), np.searchsorted(starts, begin + len(part))
        first, last = starts[lo:hi], ends[lo:hi]
        here = np.maximum(first - begin, 0)
        found = (sums[np.minimum(last - begin, len(part))] - sums[here]) * _DOWN[here]
        # Only the word that is cut by the border goes on; its bytes before it are the power.
        if len(first) and first[0] < begin:
            found[:1] *= U64(pow(MIX[1], int(begin - first[0]), 1 << 64))
        total[lo:hi] += found
    hashes.append(mixed(total))


def separators(words: str | None = None) -> np.ndarray:
    """A table of :func:`word_hashes`: white space of ASCII separates; with ``words``, all of ASCII but these."""
    table = np.zeros(256, bool)
    if words is None:
        table[list(b" \t\n\x0b\x0c\r")] = True
    else:
        table[:128] = True
        table[list(words.encode())] = False
    return table


def shingles_of(texts: list[bytes], cuts: np.ndarray, size: int, short: bool) -> list[np.ndarray]:
    """The window hashes of each text, in order. With ``short`` a text of fewer than ``size`` words has one of them all, else none."""
    hashes, starts = word_hashes(texts, cuts)
    windows = window_hashes(hashes, size) if len(hashes) >= size else np.empty(0, U64)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= size:
            out.append(windows[a : b - size + 1])
        else:
            out.append(window_hashes(hashes[a:b], size) if short else np.empty(0, U64))
    return out


def block_minima(shingles: list[np.ndarray], seeds: tuple[np.ndarray, np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Minhashes of every block of ``length`` shingles of each text: ``seeds x blocks``, and where each text's blocks begin; and the end.

    The last block of a text may be shorter. Blocks lie side by side, their k-th shingles together, so that a
    minimum over blocks is taken row by row over long rows.
    """
    flip, odd = seeds
    sizes = np.array([len(x) for x in shingles], np.int64)
    blocks = -(-sizes // length)
    starts = np.concatenate([[0], np.cumsum(blocks)])
    out = np.empty((len(flip), int(starts[-1])), np.uint32)
    if not starts[-1]:
        return out, starts
    flat = (np.concatenate(shingles) >> U64(32)).astype(np.uint32)
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    whose = np.repeat(np.arange(len(sizes)), blocks)
    base = firsts[whose] + (np.arange(int(starts[-1])) - starts[whose]) * length
    last = firsts[whose + 1] - 1
    # A short block repeats its text's last shingle, which changes no minimum.
    step = max(1, MINIMA_STEP // length)
    for at in range(0, len(base), step):
        to = min(at + step, len(base))
        laid = flat[np.minimum(base[None, at:to] + np.arange(length)[:, None], last[None, at:to])]
        for k in range(len(flip)):
            out[k, at:to] = ((laid ^ flip[k]) * odd[k]).min(axis=0)
    return out, starts


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each window of ``size`` words, in order; for fewer words, one of the whole sequence."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    total = np.full(n - width + 1, U64(width), dtype=U64)
    for k in range(width):
        total = (total + hashes[k : n - width + 1 + k]) * U64(MIX[0])
        total ^= total >> U64(33)
    return mixed(total)


def parts_of(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts of a column a few at a time, about PART_CHARS together, with the place of the first."""
    first, held, size = 0, [], 0
    for k, text in enumerate(column):
        held.append(text.as_py())
        size += len(held[-1] or "")
        if size >= PART_CHARS:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held
