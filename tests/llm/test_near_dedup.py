"""Near-duplicates against a comparison of all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stratalith.llm import near_dedup


def brute_force(rows, size=3, percent=85):
    sets = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        sets[doc_id] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {(d, len(sets[d]), top(d), top(d) == d) for d in ids}


def result(df, **options):
    return {tuple(r) for r in near_dedup.near_duplicates(df, **options).collect()}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.random()}"
    return " ".join(words)


def test_groups_of_near_copies(spark):
    rng = random.Random(1)
    rows = [(None, "x y z")]
    for group in range(6):
        base = [f"w{rng.randrange(4000)}" for _ in range(120)]
        rows += [(len(rows), edited(rng, base, rng.randrange(0, 5))) for _ in range(60)]
    rows += [(len(rows) + k, t) for k, t in enumerate(["", None, " \t\n", "one", "One", "one two", "A\x0bb c D", "a b C d", "é b c", "É b c"])]
    rng.shuffle(rows)
    found = result(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert found - {(None, 1, None, True)} == brute_force([r for r in rows if r[0] is not None])


def test_blocks_of_an_open_table(spark, monkeypatch):
    """Small blocks, so that open tables are split."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(2)
    base = [f"w{k}" for k in range(100)]
    rows = [(k, edited(rng, base, rng.randrange(0, 9))) for k in range(200)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute_force(rows)


def test_other_sizes_extra_columns_and_repeated_rows(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(200)]
    rows = [(k, edited(rng, base, k % 5)) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"node": F.lit(1), "component": F.lit("x"), "band": F.lit(0)})
    assert result(df.union(df), size=5, percent=80) == brute_force(rows, 5, 80)


def test_empty_table(spark):
    assert result(spark.createDataFrame([], "doc_id long, text string")) == set()


def test_number_of_bands():
    m = near_dedup.bands_needed(0.85)
    assert 1 - (1 - (1 - 0.85**near_dedup.HALF) ** m) ** 2 <= near_dedup.MISS
