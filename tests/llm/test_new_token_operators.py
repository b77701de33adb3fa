"""Pair-index encoding, fill-in-middle and alignment against the libraries and plain Python."""

from __future__ import annotations

import hashlib
import json
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
from conftest import rows_of
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from stratalith.llm.encoding import byte_symbols
from stratalith.llm.fill_in_middle import SkipList, fill_in_middle, restored, unit_widths
from stratalith.llm.pair_index import PairIndexEncoder, decoded, encoded
from stratalith.llm.queries import op11_bpe_round_trip, op12_fill_in_middle, op13_token_alignment
from stratalith.llm.token_alignment import aligned, shared_ends, token_groups

WORDS, BYTES, PIECES = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "\n", "a", "a a", "Hello  wörld <s> \n\t日本🎉 \0 x", "a" * 1000, "aaaa aaa aa", "▁x", "<|endoftext|> x <|startoftext|>y", "é" * 300, "İ Σας ΣΑΣ",
    "à ̀", "\r\n\x85 x　y", "🎉" * 50 + " " * 77 + "!!!???...", "don't we'll I'M", "<0x41>", "</w> x</w>", "<P>", "a<M>b", "<<S", "x" * 50 + "<", "the cat sat.\n" * 40,
]
LONG = "the long text wörld 日本 12,345 thing " * 33_000


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, text, "clash", "clash", 1, None) for k, text in enumerate(ODD)]
    rows += [(None, "no id", "x", "x", 1, None), (3, "a second row of an id", "x", "x", 1, None), (8, "aaaa aaa aa", "x", "x", 1, None), (100, LONG, "x", "x", 1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded string, block int, n_a string").repartition(3)


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


# Pair index


def test_ids_and_texts_are_those_of_the_library(docs, texts):
    library = Tokenizer.from_file(WORDS)
    expected = []
    for doc_id, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        expected.append((doc_id, len(ids), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)))
    for found in (decoded(encoded(docs, WORDS), WORDS), encoded(docs, WORDS, decode=True)):
        assert sorted(((r[0], r[1], bytes(r[2]), r[3]) for r in found.collect()), key=repr) == sorted(expected, key=repr)


@pytest.fixture(scope="module")
def both():
    with open(WORDS, encoding="utf-8") as source:
        return Tokenizer.from_file(WORDS), PairIndexEncoder(source.read())


@settings(max_examples=150, deadline=None)
@given(made=st.lists(st.text(st.sampled_from("aabcdeh'.<|>w/ \n\té本́İ0")), max_size=6))
def test_any_text_is_encoded_as_by_the_library(both, made):
    library, own = both
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(made)] == [library.encode(x, add_special_tokens=False).ids for x in made]


def test_a_full_memory_changes_no_ids():
    description = open(WORDS, encoding="utf-8").read()
    small, large = PairIndexEncoder(description, limit=3), PairIndexEncoder(description)
    made = [f"word{k} other {k % 3}" for k in range(50)]
    assert [small.encode([x])[0] for x in made] == large.encode(made)


def test_models_of_other_kinds_are_refused():
    model = json.load(open(WORDS, encoding="utf-8"))
    model["model"]["merges"][0], model["model"]["merges"][-1] = model["model"]["merges"][-1], model["model"]["merges"][0]
    with pytest.raises(ValueError, match="earlier merge"):
        PairIndexEncoder(json.dumps(model))
    with pytest.raises(ValueError, match="cuts texts"):
        PairIndexEncoder(open(BYTES, encoding="utf-8").read())


def test_decoding_keeps_columns_and_nulls(spark):
    rows = spark.createDataFrame([(1, None, "x"), (2, bytearray(), "y")], "k int, ids binary, decoded string")
    assert rows_of(decoded(rows, WORDS)) == [(1, None, None), (2, bytearray(), "")]


# Fill in middle


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=400))
def test_skip_list_reaches_every_rank(widths):
    units = SkipList(np.array(widths, np.int64))
    assert [units.reach(k) for k in range(len(widths) + 1)] == [0, *np.cumsum(widths).tolist()]
    with pytest.raises(IndexError):
        units.reach(len(widths) + 1)


def test_skip_list_of_many_units_goes_along_few_links():
    widths = np.arange(1_000_000) % 7 + 1
    units, sums = SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
    assert len(units.lanes) > 5
    for rank in (0, 1, 4095, 4096, 500_000, 999_999, 1_000_000):
        assert units.reach(rank) == sums[rank]


def test_units_tile_the_text():
    assert unit_widths("ab  cd", regex.compile(r"\w+")).tolist() == [2, 1, 1, 2]
    assert unit_widths("", regex.compile(r"\w+")).tolist() == [] and unit_widths("ab", regex.compile("")).tolist() == [1, 1]


def plainly(doc_id, text):
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}", text
    return doc_id, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", text


def test_fill_in_middle_on_odd_rows(docs, texts):
    found = rows_of(restored(fill_in_middle(docs)))
    assert found == sorted((plainly(*x) for x in texts), key=repr)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_cuts_after_words(spark):
    rows = spark.createDataFrame([(k, "ab, cde fg " * k) for k in range(40)], "doc_id long, text string")
    out = restored(fill_in_middle(rows, seed=3, plain_percent=0, unit=r"\S+\s*")).collect()
    for r in out:
        text = "ab, cde fg " * r["doc_id"]
        assert r["restored"] == text and r["n"] == 3 * r["doc_id"]
        for cut in (r["prefix_chars"], (r["prefix_chars"] or 0) + (r["middle_chars"] or 0)):
            assert not cut or cut == len(text) or text[cut - 1] == " "


def test_restored_without_markers_is_null(spark):
    rows = spark.createDataFrame([("psm", "no markers"), ("other", "<P>a<S>b<M>c"), ("plain", "x"), (None, "y")], "form string, output string")
    assert [r["restored"] for r in restored(rows).collect()] == [None, None, "x", None]


# Alignment


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60))), min_size=1, max_size=5))
def test_shared_ends_of_any_ends(made):
    a, b, starts_a, starts_b, base = [], [], [0], [0], 0
    for x, y in made:
        a += sorted(base + e for e in x | {61})
        b += sorted(base + e for e in y | {61})
        starts_a.append(len(a))
        starts_b.append(len(b))
        base += 61
    found = shared_ends(*(np.array(v, np.int64) for v in (a, b, starts_a, starts_b)))
    common = sorted(set(a) & set(b))
    assert [[side[k] for k in at.tolist()] for side, at in zip((a, b), found)] == [common, common]


def test_a_long_stretch_without_a_shared_end():
    a, b = np.append(np.arange(1, 200_000, 2), 200_000), np.arange(2, 200_001, 2)
    a[60_001] += 1
    a = np.unique(a)
    found = shared_ends(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    assert a[found[0]].tolist() == sorted(set(a.tolist()) & set(b.tolist())) and len(found[0]) == 2


def plain_alignment(texts):
    a_side, b_side = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_side.encode_special_tokens = True
    byte_of = {s: k for k, s in enumerate(byte_symbols())}
    rows = []
    for doc_id, text in texts:
        a, b = a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)
        of_a = [bytes(byte_of[x] for x in a_side.id_to_token(n)) for n in a]
        of_b = [bytes([int(p[3:5], 16)]) if regex.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b_side.id_to_piece, b)]
        if not text or not b"".join(of_a) == b"".join(of_b) == b" " + text.encode():
            rows.append((doc_id, [], [], []))
            continue
        groups, i, j, x, y = [], 0, 0, b"", b""
        first = (0, 0)
        while i < len(a) or j < len(b):
            if len(x) <= len(y) and i < len(a):
                x, i = x + of_a[i], i + 1
            else:
                y, j = y + of_b[j], j + 1
            if len(x) == len(y):
                groups.append((a[first[0] : i], b[first[1] : j]))
                first, x, y = (i, j), b"", b""
        rows.append((doc_id, a, b, groups))
    counts = Counter((g[0][-1], g[1][-1]) for *_, groups in rows for g in groups)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out, spelled = [], []
    for doc_id, a, b, groups in rows:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        spelled.append((doc_id, text))
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha(text.encode()) if text else ""))
    return out, spelled


def test_alignment_of_odd_rows(docs, texts):
    out, spelled = plain_alignment(texts)
    assert rows_of(token_groups(docs, BYTES, PIECES)) == sorted(spelled, key=repr)
    assert rows_of(aligned(docs, BYTES, PIECES)) == sorted(out, key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    found = [decoded(encoded(none, WORDS), WORDS), restored(fill_in_middle(none)), aligned(none, BYTES, PIECES), token_groups(none, BYTES, PIECES)]
    assert [x.count() for x in found] == [0] * 4


# Registered queries, over a whole table


def test_queries_over_a_whole_table(spark, table_dir):
    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{table_dir}/documents.parquet").collect()]
    library, expected = Tokenizer.from_file(WORDS), []
    for doc_id, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        expected.append((doc_id, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert rows_of(op11_bpe_round_trip(spark, table_dir)) == sorted(expected, key=repr)
    assert rows_of(op13_token_alignment(spark, table_dir)) == sorted(plain_alignment(rows)[0], key=repr)
    cut = [(*x[:5], sha(x[5].encode()), sha(x[6].encode())) for x in (plainly(*r) for r in rows)]
    assert rows_of(op12_fill_in_middle(spark, table_dir)) == sorted(cut, key=repr)


@pytest.fixture(scope="module")
def table_dir():
    from __spark_entry__ import SMOKE_DIR

    return SMOKE_DIR
