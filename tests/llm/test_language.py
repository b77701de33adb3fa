"""Bundles against sums of vectors one by one, and held-out accuracy."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalith.llm import language
from stratalith.llm.language import Vectors, languages, prototypes

TABLES = "/root/testdata/sf0.01"


def plain_bundle(v, text):
    letters = [ord(c) if c.isalpha() else 0 for c in f" {text.lower()} "]
    letters = [x for k, x in enumerate(letters) if k == 0 or x or letters[k - 1]]
    total = np.zeros(v.dimensions, np.int64)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        total += np.roll(v.letter(a), 2).astype(np.int64) * np.roll(v.letter(b), 1) * v.letter(c)
    return total if any(letters) else total * 0


def test_bundles(monkeypatch):
    v = Vectors(256)
    texts = ["a", "Hello, World!", "éè ß 日本", "x  y\n\nz 12 q", "ab" * 50, "İi"]
    texts += ["abcd,,,efgh ijkl", "Hello, World! and more", ",,,,,,,,,,,,a,,,,,,,,,,,,", "a,,,,,,,,,,,,,,,,,b"]
    for span in (1 << 20, 7, 3, 2, 1):
        monkeypatch.setattr(language, "SPAN", span)
        counted = [v.counts(t) for t in texts]
        for text, (codes, counts), row in zip(texts, counted, v.bundles(counted)):
            assert (v.bundle(codes, counts) == plain_bundle(v, text)).all() and (row == plain_bundle(v, text)).all(), text
    for nothing in (None, "", " 12 \n!?"):
        assert len(v.counts(nothing)[0]) == 0


def test_letters_are_random_and_fixed():
    one, two = Vectors(2048), Vectors(2048)
    assert (one.letter(97) == two.letter(97)).all() and set(np.unique(one.letter(97))) == {-1, 1}
    assert max(abs(int(one.letter(a).astype(int) @ one.letter(b))) for a in range(97, 110) for b in range(97, a)) < 250


def test_rows(spark, monkeypatch):
    monkeypatch.setattr(language, "REMEMBERED", 40)
    train = [("en", "the cat and the dog with the other"), ("de", "der Hund und die Katze mit dem anderen"), (None, "xyz"), ("zz", None), ("yy", "123")]
    rows = [(1, "the dog and the cat"), (2, "die Katze und der Hund"), (3, None), (4, " 12 "), (None, "und der andere Hund"), (1, "the dog and the cat")]
    known = prototypes(spark.createDataFrame(train, "lang string, text string").repartition(3))
    assert [n for n, _ in known] == ["de", "en"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang_pred": F.lit("clash"), "score": F.lit("clash")})
    found = languages(docs, known).collect()
    assert sorted(((r.doc_id, r.lang_pred) for r in found), key=repr) == sorted([(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (None, "de")], key=repr)
    assert all(0 <= r.score <= 1 and (r.score > 0.3) == (r.lang_pred != "und") for r in found)
    assert {r.lang_pred for r in languages(docs, []).collect()} == {"und"}
    assert prototypes(spark.createDataFrame([], "lang string, text string")) == [] and languages(docs.limit(0), known).count() == 0


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables are not here")
def test_held_out_accuracy(spark):
    from stratalith.llm.queries import op2_language_id

    truth = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "lang")
    found = op2_language_id(spark, TABLES).where("held_out").join(truth, "doc_id").collect()
    right = sum(r.lang == r.lang_pred for r in found)
    print("held out", len(found), right)
    assert len(found) > 150 and right / len(found) > 0.97
