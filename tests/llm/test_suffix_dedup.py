"""Repeated bytes against a table of all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalith.llm import suffix_dedup


def brute_force(rows):
    seen: set[bytes] = set()
    out = []
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            window = data[k : k + 100]
            if window in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out += [(doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())] * rows.count((doc_id, text))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r)[:5] for r in suffix_dedup.repeated_bytes(df).collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 8)))
    passages = [" ".join(word() for _ in range(k)) for k in (20, 25, 30, 60, 200)]
    rows = [(3, None), (4, ""), (5, "short"), (6, "x" * 99), (7, "x" * 100), (8, "x" * 350), (9, "ab" * 300), (11, "For " * 200), (12, "For " * 90), (13, "\0" * 250)]
    for k in range(n):
        text = " ".join(rng.choice(passages) if rng.random() < 0.03 else word() for _ in range(rng.randrange(0, 120)))
        rows.append((100 + 2 * k, text))
        if rng.random() < 0.2:
            rows.append((rng.randrange(10**6, 10**7), text))
        if rng.random() < 0.2:
            cut = rng.randrange(len(text) + 1)
            rows.append((-k - 1, text[:cut] + "!" + text[cut:]))
    rows += [(None, passages[4]), rows[-1], rows[20], rows[20]]
    rng.shuffle(rows)
    return rows


def test_against_all_windows(spark):
    rows = corpus(1, 150)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns({"ord": F.lit("clash"), "sha": F.lit(1), "start": F.lit(2)})
    assert result(df) == brute_force(rows)


def test_small_shards_spans_and_hot_grams(spark, monkeypatch):
    """Long texts are cut, stretches are dealt to many shards, frequent grams to several."""
    monkeypatch.setattr(suffix_dedup, "SPAN", 777)
    monkeypatch.setattr(suffix_dedup, "HOT", 3)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 5000)
    rows = corpus(2, 120)
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute_force(rows)


def test_repeat_between_buffers_of_one_text(spark):
    """The only repeat of a text lies in two of the buffers that it is cut into."""
    rng = np.random.default_rng(5)
    letters = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    span, passage = suffix_dedup.SPAN, letters(150)
    text = "".join([letters(1000), "<", passage, ">", letters(2 * span), "[", passage, "]", letters(500)])
    at = text.rindex(passage)
    rows = [(1, letters(3000)), (2, text), (3, letters(400)), (4, text)]
    found = {r.doc_id: r for r in suffix_dedup.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()}
    assert (found[2].n_removed, found[2].spans) == (150, [at, at + 150])
    assert found[2].kept_sha256 == hashlib.sha256((text[:at] + text[at + 150 :]).encode()).hexdigest()
    assert [found[k].n_removed for k in (1, 3, 4)] == [0, 0, len(text)]


def test_long_texts_in_small_spans(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SPAN", 300)
    rng = random.Random(6)
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows = []
    for k in range(12):
        passage = letters(rng.choice((100, 130, 420)))
        text = letters(200) + passage + letters(rng.randrange(150, 900)) + passage + letters(rng.randrange(200))
        rows += [(k, text), (k + 100, text)][: 1 + k % 2]
    assert sum(r[2] > 0 for r in brute_force(rows)) == len(rows)
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute_force(rows)


def test_nothing_repeats_and_empty_table(spark):
    assert result(spark.createDataFrame([(1, "a" * 99), (2, None)], "doc_id long, text string")) == brute_force([(1, "a" * 99), (2, None)])
    assert result(spark.createDataFrame([], "doc_id long, text string")) == []


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_sorted_windows_and_common_prefixes(letters):
    rng = np.random.default_rng(letters)
    parts = [bytes(rng.integers(97, 97 + letters, rng.integers(100, 170)).astype(np.uint8)) for _ in range(30)]
    parts += [parts[0], parts[3][5:110], parts[4][:-20] + parts[5]]
    parts = [p for p in parts if len(p) >= 100]
    data = np.frombuffer(b"".join(parts), np.uint8)
    text = data.tobytes()
    starts, order, repeats = suffix_dedup.repeated_windows(parts)
    assert order.tolist() == sorted(starts.tolist(), key=lambda k: (text[k : k + 100], k))
    sizes = np.array([len(p) for p in parts])
    shared = suffix_dedup.common_prefixes(suffix_dedup.words_at(data), order, np.cumsum(sizes) - sizes, sizes - 99)
    for a, b, n in zip(order[:-1], order[1:], shared[1:]):
        x, y = text[a : a + 100], text[b : b + 100]
        assert n == next((k for k in range(100) if x[k] != y[k]), 100)
