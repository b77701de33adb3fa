"""Texts of more than a million characters, which every operator takes whole."""

from __future__ import annotations

import random
import re

import numpy as np
import public_tokenizers
import pytest
from test_line_quality import plain_counts
from test_pii import plain_base
from tokenizers import Tokenizer

from stratalith.llm import language, line_quality, near_dedup, packing, pii, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("the", "and", "wör", "mit", "lo") for b in ("", "er", "ing", "est", ",", ".")]
    lines = [" ".join(rng.choice(words) + str(rng.randrange(90)) * (rng.random() < 0.2) for _ in range(12)) for _ in range(18_000)]
    long = "\n".join(lines)
    # The only personal data lies behind the first million characters.
    long += "\nwrite by mail to jane@site.com"
    near = long.split(" ")
    for _ in range(300):
        near[rng.randrange(len(near))] = "changed"
    assert len(long) > 1 << 20
    return {1: long, 2: " ".join(near), 3: long.upper(), 4: "short text", 5: "x" * 1_200_000}


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)


def test_language(texts, monkeypatch):
    v = language.Vectors(64)
    codes, counts = v.counts(texts[1])
    assert counts.sum() > 1 << 20
    monkeypatch.setattr(language, "SPAN", 1 << 26)
    whole = v.counts(texts[1])
    assert (whole[0] == codes).all() and (whole[1] == counts).all()


def test_near_duplicates(spark, docs, texts):
    found = {r.doc_id: r for r in near_dedup.near_duplicates(docs).collect()}
    shingles = {d: re.findall(r"[^\x20\x09-\x0D]+", t.encode().lower().decode()) for d, t in texts.items()}
    for d, words in shingles.items():
        assert found[d].n_shingles == len({tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))})
    # Capitals beyond ASCII are other letters, so the third text resembles the first little.
    assert [found[d].component_id for d in texts] == [1, 1, 3, 4, 5]


def test_counts_and_packing(spark, docs, texts):
    library = Tokenizer.from_file(WORDS)
    sizes = {d: len(library.encode(t, add_special_tokens=False).ids) for d, t in texts.items()}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, WORDS).collect()} == sizes
    reached: dict[int, int] = {}
    for r in sorted(packing.packed(docs, WORDS, 1).collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == reached.get(r.doc_id, 0) and r.doc_tokens == sizes[r.doc_id] + 1
        reached[r.doc_id] = r.start + r.length
    assert reached == {d: n + 1 for d, n in sizes.items()}


def test_line_quality_and_personal_data(spark, docs, texts):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    base = {r.doc_id: r for r in line_quality.line_quality(docs, none).collect()}
    found = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for d in (1, 4, 5):
        counts = plain_counts(texts[d]) if d != 1 else None
        assert counts is None or tuple(base[d])[1:6] == counts
        assert found[d].base_spans == ",".join(f"{k}:{a}:{b}" for k, a, b in plain_base(texts[d]))
    words = re.findall(r"[^\x20\x09-\x0D]+", texts[1])
    assert base[1].n_words == len(words) and base[1].word_chars == sum(map(len, words)) and found[1].n_email == 1
    assert np.isclose(base[1].content_share, 1.0)
