"""Base counts by plain counting, decoding against all label sequences, and held-out accuracy."""

from __future__ import annotations

import itertools
import os
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalith.llm import line_quality
from stratalith.llm.line_quality import Field

TABLES = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    inside = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:k] for k, x in enumerate(lines)), len(inside)


TEXTS = [
    "", " \n\t", "one", "a b a b a b a", "a b c a b c", "x\x85y z w", "#*$ %&|<>", "l\nl\n\nl\n  \n  \nl ", "é é é é é", "a b c d\n" * 80, "\x1cweird\x1f one", "Ein Satz. " * 5,
    " ".join(f"word{k}" for k in range(60)), "a " * 5000,
]


def test_base_counts():
    for text in TEXTS:
        assert tuple(line_quality.base_counts(text)) == plain_counts(text), repr(text)


def test_viterbi_is_the_best_sequence():
    rng = np.random.default_rng(3)
    for _ in range(20):
        field = Field(rng.normal(size=(line_quality.N_FEATURES, 2)), rng.normal(size=(2, 2)))
        bits = [int(x) for x in rng.integers(0, 1 << line_quality.N_FEATURES, 7)]
        scores = line_quality.matrix(np.array(bits)) @ field.weights
        worth = lambda y: sum(scores[k, a] for k, a in enumerate(y)) + sum(field.moves[a, b] for a, b in zip(y, y[1:]))
        assert tuple(field.viterbi(bits)) == max(itertools.product((0, 1), repeat=7), key=worth)


def test_training_learns_single_lines_and_runs():
    good, bad = line_quality.line_features("A sentence of plain words here.\n" * 3)[0], line_quality.line_features("x | y\n" * 3)[0]
    field = Field.trained([(good, [0] * len(good)), (bad, [1] * len(bad))] * 5)
    assert set(field.viterbi(good)) == {0} and set(field.viterbi(bad)) == {1}
    assert field.moves[0, 0] > field.moves[0, 1] and field.moves[1, 1] > field.moves[1, 0]
    # Where every line is followed by one of the other label, changes are learnt.
    turns = [x for pair in zip(good, bad) for x in pair]
    field = Field.trained([(turns, [0, 1] * len(good)), (turns[::-1], [1, 0] * len(good))] * 5)
    assert field.moves[0, 1] > field.moves[0, 0] and field.moves[1, 0] > field.moves[1, 1]
    assert Field.trained([]).viterbi(bad) == [0] * len(bad)


def test_training_follows_its_gradient():
    """No small change of the fitted weights makes the lines likelier."""
    rng = np.random.default_rng(5)
    documents = [([int(x) for x in rng.integers(0, 64, n) << 20], [int(x) for x in rng.integers(0, 2, n)]) for n in (3, 4, 5, 2, 4)]

    def likelihood(field):
        mostly = [sum(y) > len(y) / 2 for _, y in documents]
        total = -1e-3 / 2 * ((field.weights**2).sum() + (field.moves**2).sum())
        for (bits, labels), m in zip(documents, mostly):
            scores = line_quality.matrix(np.array(bits)) @ field.weights
            worth = lambda y: sum(scores[k, a] for k, a in enumerate(y)) + sum(field.moves[a, b] for a, b in zip(y, y[1:]))  # noqa: E731, B023
            every = np.logaddexp.reduce([worth(y) for y in itertools.product((0, 1), repeat=len(bits))])
            total += (worth(labels) - every) * 0.5 / mostly.count(m) / len(bits)
        return total

    best = Field.trained(documents, rounds=600, rate=0.05)
    top = likelihood(best)
    for _ in range(30):
        other = Field(best.weights + rng.normal(size=best.weights.shape) * 0.1, best.moves + rng.normal(size=(2, 2)) * 0.1)
        assert likelihood(other) < top + 1e-4


SENTENCES = ["The river carried the old boats slowly towards the harbour.", "Nobody in the village remembered when the mill was built.", "Rain fell on the hills through the whole of the morning.", "She wrote a long letter about the journey and its many stops."]
NAVIGATION = ["Home | About | Contact", "### $$$ ###", "Login | Register | Help | Terms", "* * * % % %", "<<< Next >>> | <<< Back >>>", "BUY NOW BUY NOW BUY NOW"]


def mixed_document(rng, content_share, n=14):
    """Lines in runs, with the label of each."""
    labels = []
    while len(labels) < n:
        labels += [int(rng.random() >= content_share)] * int(rng.integers(1, 4))
    lines = [rng.choice(NAVIGATION) if y else " ".join(rng.choice(SENTENCES).split()[: int(rng.integers(6, 12))]) + "." for y in labels[:n]]
    return "\n".join(lines), labels[:n]


def test_lines_of_documents_that_mix_both(spark):
    """Trained on the quality of documents alone, the field tells single lines apart."""
    rng = np.random.default_rng(11)
    train = [(k, *mixed_document(rng, 0.85 if k % 3 else 0.25)) for k in range(240)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in train], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k, _, _ in train], "doc_id long, quality int, toxic int")
    field = line_quality.train(docs, labels)
    hits = found = there = 0
    shares = []
    for _ in range(120):
        text, truth = mixed_document(rng, rng.random())
        labelled = field.viterbi(line_quality.line_features(text)[0])
        hits += sum(a == b == 1 for a, b in zip(labelled, truth))
        found, there = found + sum(labelled), there + sum(truth)
        shares.append(line_quality.judged(text, field)[1])
    assert hits / found >= 0.9 and hits / there >= 0.9
    assert sum(0.1 < x < 0.9 for x in shares) > 40 and min(shares) < 0.2 and max(shares) > 0.8


def test_line_labels_keep_to_the_documents_where_nothing_else_is_known():
    lines = line_quality.line_features("A sentence of plain words here.\nx | y")[0]
    assert line_quality.line_labels([(lines, True), ([], True)]) == [[0, 0], []]
    assert line_quality.line_labels([(lines, False)]) == [[1, 1]]
    assert line_quality.line_labels([]) == []
    mixed = line_quality.line_labels([(lines[:1] * 9 + lines[1:], True), (lines[:1] + lines[1:] * 9, False)])
    assert mixed == [[0] * 9 + [1], [0] + [1] * 9]


def test_rows(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, None), (0, "again"), (0, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"quality": F.lit("clash"), "kept": F.lit(1)})
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 0), (3, None, 0), (12, 1, 0), (12, 1, 0), (9, 0, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        found = line_quality.line_quality(docs, labels).collect()
        assert Counter((r.doc_id, *tuple(r)[1:6]) for r in found) == Counter((d, *plain_counts(t or "")) for d, t in rows)
        for r in found:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.kept and r.base_failed)
        assert {r.doc_id for r in found if r.kept} == {12}
        assert [r.doc_id for r in line_quality.good_documents(docs, labels).collect()] == [12]
    assert line_quality.line_quality(docs.limit(0), none).count() == 0


def test_training_reads_whole_documents(spark):
    """Two kinds of documents that differ behind their 150th line only; one that is too long is left out whole."""
    same = "A sentence of plain words here.\n" * 200
    good, bad = same + "Another sentence of plain words.\n" * 40, same + "x | y\n" * 40
    rows = [(k, bad if k % 2 else good) for k in range(20)]
    docs = spark.createDataFrame([*rows, (100, "x | y\n" * 5000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k, _ in rows], "doc_id long, quality int, toxic int")
    field = line_quality.train(docs, labels)
    assert set(field.viterbi(line_quality.line_features("x | y\n" * 40)[0])) == {1}
    known = labels.union(spark.createDataFrame([(100, 1, 0)], labels.schema))
    assert np.allclose(line_quality.train(docs, known, most_lines=6000).weights, field.weights)
    assert not np.allclose(line_quality.train(docs, known).weights, field.weights)
    assert not line_quality.train(docs, known, most_lines=2).weights.any()


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables are not here")
def test_held_out_accuracy(spark, monkeypatch):
    """Trained on few of the labelled documents, judged on the others."""
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    seen = labels.where("doc_id % 2 = 0")
    found = line_quality.line_quality(docs, seen).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    right = [bool(r.quality) == r.kept for r in found]
    assert len(right) > 100 and sum(right) / len(right) > 0.95
