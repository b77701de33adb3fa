"""Leaks against shingle sets of all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from stratalith.llm import decontaminate


def shingles(text):
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def brute_force(docs, items):
    out = []
    for d, text in docs:
        own = shingles(text)
        for i, item in items:
            s = shingles(item)
            if s and 100 * len(s & own) >= 80 * len(s):
                out.append((d, i, len(s), len(s & own), len(s & own) / len(s)))
    return sorted(out, key=repr)


def tables(seed=1):
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    items = [(k, " ".join(words(rng.choice((5, 6, 12, 30, 33, 70, 300))))) for k in range(40)]
    docs = [(0, None), (1, ""), (2, "a b c d"), (3, "one two, three")]
    for k in range(120):
        body = words(rng.choice((10, 80, 400, 5000)))
        for _ in range(rng.randrange(0, 3)):
            passage = rng.choice(items)[1].split()
            for _ in range(rng.choice((0, 0, 1, 3))):
                passage[rng.randrange(len(passage))] = "changed"
            half = len(passage) // 2
            pieces = [passage] if rng.random() < 0.7 else [passage[: half + 4], passage[half:]]
            for p in pieces:
                at = rng.randrange(len(body))
                body[at:at] = [x.upper() + "," if rng.random() < 0.3 else x for x in p]
        docs.append((k + 4, " ".join(body)))
    items += [(None, items[3][1]), (50, None), (51, ""), (52, "four words are few"), (3, items[3][1])]
    docs += [(None, docs[50][1]), docs[60], docs[60]]
    return docs, items


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_leaks(spark):
    docs, items = tables()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).withColumn("item_id", F.lit("clash"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    expected = brute_force(docs, items)
    assert len(expected) > 60
    assert result(decontaminate.leaks(d, i)) == expected
    bad = {r[0] for r in expected if r[0] is not None}
    left = decontaminate.without_leaks(d, i)
    assert left.columns == d.columns
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted((x for x, _ in docs if x not in bad and x is not None), key=repr)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 8000)
    docs, items = tables(2)
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert result(decontaminate.leaks(d, i)) == brute_force(docs, items)


def test_empty_tables(spark):
    some, none = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    items = some.withColumnRenamed("doc_id", "item_id")
    assert decontaminate.leaks(none, items).count() == 0
    assert decontaminate.leaks(some, none.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert decontaminate.without_leaks(some, none.withColumnRenamed("doc_id", "item_id")).count() == 1
    assert decontaminate.without_leaks(some, items).count() == 0


def test_items_in_blocks_leave_the_same_documents(spark, monkeypatch):
    docs, items = tables(3)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string")
    whole = result(decontaminate.without_leaks(d, i))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 8000)
    assert result(decontaminate.without_leaks(d, i)) == whole and 0 < len(whole) < len(docs)


def test_many_items_alike_and_a_very_long_document(spark):
    """Copies of an item are one set, each of which is reported; the passage lies in the second million bytes."""
    rng = random.Random(5)
    passage = " ".join(f"p{rng.randrange(900)}" for _ in range(40))
    long = " ".join(f"w{rng.randrange(50_000)}" for _ in range(200_000))
    docs = [(1, long + " " + passage.upper() + ". " + long), (2, long), (3, "x" * 1_500_000 + " " + passage)]
    items = [(k, passage) for k in range(300)] + [(900, "never " * 3 + "seen at all anywhere")]
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.leaks(d, i).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted((x, k) for x in (1, 3) for k in range(300))
    assert [r.doc_id for r in decontaminate.without_leaks(d, i).collect()] == [2]
