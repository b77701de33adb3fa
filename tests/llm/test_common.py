"""Hashes of words, windows and blocks, and keys that hold much of a table."""

from __future__ import annotations

import os
import random
import re

import numpy as np
from pyspark.sql import functions as F

from stratalith.llm import common
from stratalith.llm.components import components

U64 = np.uint64


def made(seed, n=60):
    rng = random.Random(seed)
    return [b"", b" ", b"a", b" a", b"a\tb\rc\x0bd\x0ce"] + ["".join(rng.choice("abcé \n\t.0") for _ in range(rng.randrange(200))).encode() for _ in range(n)]


def test_equal_words_and_no_others_have_equal_hashes(monkeypatch):
    texts = made(1)
    whole, starts = common.word_hashes(texts, common.separators())
    words = [w for t in texts for w in re.findall(rb"[^\x20\x09-\x0D]+", t)]
    assert np.diff(starts).tolist() == [len(re.findall(rb"[^\x20\x09-\x0D]+", t)) for t in texts]
    assert len(set(zip(words, whole.tolist()))) == len(set(words)) == len(set(whole.tolist()))
    # Texts that are hashed in pieces, and words that are cut by their borders.
    for size in (3, 7, 64, 1000):
        monkeypatch.setattr(common, "HASH_BYTES", size)
        again, at = common.word_hashes(texts, common.separators())
        assert (again == whole).all() and (at == starts).all()


def test_other_separators():
    table = common.separators("abc")
    assert common.word_hashes([b"ab-c ab!", "éa".encode()], table)[1].tolist() == [0, 3, 4]
    hashes = common.word_hashes([b"ab-c ab!", b""], table)[0]
    assert hashes[0] == hashes[2] != hashes[1]


def test_shingles_and_block_minima():
    texts = [b"", b"one two", b"a b c d e f g h", b"c d e"] + made(2)
    found = common.shingles_of(texts, common.separators(), 3, short=True)
    without = common.shingles_of(texts, common.separators(), 3, short=False)
    for text, own, long in zip(texts, found, without):
        words = text.split()
        windows = [tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        assert len(own) == len(windows) and len(set(own.tolist())) == len(set(windows))
        assert len(long) == (len(own) if len(words) >= 3 else 0)
    assert found[3].tolist() == found[2].tolist()[2:3]
    seeds = np.array([[5], [9]], np.uint32), np.array([[3], [77]], np.uint32)
    for step in (1 << 15, 16):
        common.MINIMA_STEP, before = step, common.MINIMA_STEP
        least, starts = common.block_minima(found, seeds, 4)
        common.MINIMA_STEP = before
        for own, a, b in zip(found, starts[:-1], starts[1:]):
            short = (own >> U64(32)).astype(np.uint32)
            plain = [((short[None, k : k + 4] ^ seeds[0]) * seeds[1]).min(axis=1).tolist() for k in range(0, len(own), 4)]
            assert least[:, a:b].T.tolist() == plain


def test_hot_keys(spark):
    rows = spark.createDataFrame([("hot" if k % 3 == 0 else None if k % 3 == 1 else f"k{k}",) for k in range(900)], "k string")
    assert common.hot_in(rows, "k") == ["hot"]
    assert common.hot_in(rows.limit(0), "k") == []


def test_settled_results_are_released(spark):
    df = common.settled(spark.range(5), "test")
    path = common._settled[df].removeprefix("file://")
    assert df.count() == 5 and os.path.isdir(path)
    common.release(spark, df)
    assert not os.path.exists(path)


def test_components_of_a_star_and_a_chain(spark):
    """One node with very many links, and a long way from end to end."""
    star = spark.range(1, 5000).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    chain = spark.range(10_000, 10_300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(star.union(chain).union(star.limit(3)).repartition(6)).groupBy("component").count().collect()
    assert sorted((r["component"], r["count"]) for r in found) == [(0, 5000), (10_000, 301)]
    assert components(star.limit(0)).count() == 0


def test_small_results_lie_in_few_files(spark):
    """Components of 400 pairs over 64 shuffle partitions, of which Spark joins none by itself; they were in 64 files."""
    names = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        found = components(spark.range(400).selectExpr("2 * id a", "2 * id + 1 b"))
        files = 2 * spark.sparkContext.defaultParallelism
        assert 1 < len(found.inputFiles()) <= files < 64
        assert common.few_files(spark.range(0, 400, 1, 64), 1, 4).rdd.getNumPartitions() == 16
        assert sorted(map(tuple, found.collect())) == [(k, k // 2 * 2) for k in range(800)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
