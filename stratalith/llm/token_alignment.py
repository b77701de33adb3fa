"""Alignment of the tokens of two tokenizers by divide and conquer at shared cuts.

Both tokenizers spell the same bytes, so the ends of their tokens are two rising sequences of byte offsets.
For a stretch that both cut at its borders an end near its middle is taken from one side and looked for on
the other by bisecting; where none is common its neighbours are tried, further and further out. A common end
divides the stretch in two, which are treated alike; a stretch without one is a group. All stretches of the
same depth are treated side by side.

Links are pairs of tokens that end together, one for each group: the last token of either side. How often a
pair of ids is linked is counted over all documents in Spark: each block of documents gives its distinct pairs
once, and gets their counts back, so that no pair is shuffled once for every document that holds it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from stratalith.llm.common import settled, ship_package
from stratalith.llm.encoding import byte_symbols, encoder_for

# Neighbours of the middle that are tried one by one before all that are left are looked up together.
PROBES = 4
# Bytes of texts that are aligned together, and that share one list of pairs.
GROUP_BYTES = 1 << 19
BLOCK_BYTES = 1 << 22


def shared_ends(a: np.ndarray, b: np.ndarray, starts_a: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indices of the ends that ``a`` and ``b`` have in common, ascending.

    Both are rising offsets; ``starts_*`` are the indices at which each text begins, and the length. Each text is a
    stretch of its own, whose last ends are equal. Texts must have tokens.
    """
    al, ar, bl, br = starts_a[:-1], starts_a[1:], starts_b[:-1], starts_b[1:]
    cuts_a, cuts_b = [ar - 1], [br - 1]
    while True:
        # A stretch of one token on either side has no inner end.
        inner = np.flatnonzero((ar - al > 1) & (br - bl > 1))
        if not len(inner):
            return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))
        al, ar, bl, br = al[inner], ar[inner], bl[inner], br[inner]
        middle = (al + ar - 1) // 2
        at, to = np.full(len(al), -1, np.int64), np.full(len(al), -1, np.int64)
        left = np.arange(len(al))
        for step in range(2 * PROBES + 1):
            # The middle, then one beyond, one before, two beyond ...
            tried = middle[left] + ((step + 1) // 2 if step % 2 else -(step // 2))
            within = (tried >= al[left]) & (tried < ar[left] - 1)
            some, ends = left[within], a[tried[within]]
            found = np.searchsorted(b, ends)
            hit = b[found] == ends
            at[some[hit]], to[some[hit]] = tried[within][hit], found[hit]
            left = left[at[left] < 0]
            if not len(left):
                break
        # Longer ones: all inner ends together, of which the one nearest the middle is taken.
        left = left[ar[left] - al[left] - 1 > PROBES]
        if len(left):
            sizes = ar[left] - al[left] - 1
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            tried = np.arange(int(sizes.sum())) + np.repeat(al[left] - first, sizes)
            found = np.searchsorted(b, a[tried])
            away = np.where(b[found] == a[tried], np.abs(tried - np.repeat(middle[left], sizes)), np.iinfo(np.int64).max)
            nearest = np.minimum.reduceat(away, first)
            match = np.flatnonzero((away == np.repeat(nearest, sizes)) & (away < np.iinfo(np.int64).max))
            owner = np.repeat(left, sizes)[match]
            at[owner], to[owner] = tried[match], found[match]
        cut = at >= 0
        at, to = at[cut], to[cut]
        cuts_a.append(at)
        cuts_b.append(to)
        al, ar = np.concatenate([al[cut], at + 1]), np.concatenate([at + 1, ar[cut]])
        bl, br = np.concatenate([bl[cut], to + 1]), np.concatenate([to + 1, br[cut]])


class TokenBytes:
    """Both tokenizers of a process, with the bytes, their number and the spelling of every id."""

    def __init__(self, description: str, model: bytes):
        import sentencepiece

        described = json.loads(description)
        if described["model"]["type"] != "BPE" or (described.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("the first tokenizer must be a byte-level one")
        # Without them, their strings are plain text.
        described["added_tokens"] = []
        self.a = encoder_for(json.dumps(described))
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte_of = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        spelled = {n: bytes(byte_of[x] for x in token) if all(x in byte_of for x in token) else token.encode() for token, n in described["model"]["vocab"].items()}
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        self.bytes_a = np.array([spelled.get(n, b"") for n in range(max(spelled) + 1)], object)
        self.bytes_b = np.array([bytes([int(x[3:5], 16)]) if self.b.is_byte(n) else x.replace("▁", " ").encode() for n, x in enumerate(pieces)], object)
        self.lengths_a, self.lengths_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # Every id with what may follow it in the text of groups: the next token of its side, the other side, the next group.
        self.names_a, self.names_b = (np.array([f"{n}{sign}" for n in range(len(x)) for sign in signs], object) for x, signs in ((self.bytes_a, ",|"), (self.bytes_b, ",;")))

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of each text by both tokenizers; none if either does not spell the text with a blank before it."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        out = []
        for text, first, second in zip(texts, self.a.encode([" " + x for x in texts]), self.b.encode(texts, num_threads=1)):
            a, b = np.frombuffer(first, "<u4").astype(np.int64), np.array(second, np.int64)
            whole = b" " + text.encode()
            same = text and b"".join(self.bytes_a[a].tolist()) == whole and b"".join(self.bytes_b[b].tolist()) == whole
            out.append((a, b) if same else none)
        return out


class Aligned:
    """The groups of some texts: ids of both sides one text after another, and where groups end among them."""

    def __init__(self, tokens: TokenBytes, texts: list[str]):
        self.tokens = tokens
        ids = tokens.ids(texts)
        self.has = np.array([len(a) > 0 for a, _ in ids], bool)
        self.a, self.b = (np.concatenate([x[k] for x in ids]) if ids else np.empty(0, np.int64) for k in (0, 1))
        self.starts_a, self.starts_b = (np.concatenate([[0], np.cumsum([len(x[k]) for x in ids])]).astype(np.int64) for k in (0, 1))
        if len(self.a):
            some = np.concatenate([self.has, [True]])
            ends_a, ends_b = np.cumsum(tokens.lengths_a[self.a]), np.cumsum(tokens.lengths_b[self.b])
            self.cuts_a, self.cuts_b = shared_ends(ends_a, ends_b, self.starts_a[some], self.starts_b[some])
        else:
            self.cuts_a = self.cuts_b = np.empty(0, np.int64)
        # The first group of each text, and the number of groups.
        self.groups = np.searchsorted(self.cuts_a, self.starts_a)

    def pairs(self) -> np.ndarray:
        """The ids linked at the end of each group, in one number."""
        return (self.a[self.cuts_a] << 32) | self.b[self.cuts_b]

    def spelled(self) -> list[str]:
        """The groups of each text: ``a1,a2|b1;a3|b2,b3``; an empty text where there are no tokens."""
        # The tokens of one group follow each other, those of the first side before those of the second.
        group_a, group_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        group_a[self.cuts_a[:-1] + 1], group_b[self.cuts_b[:-1] + 1] = 1, 1
        ends_a, ends_b = np.append(self.cuts_a + 1, 0), np.append(self.cuts_b + 1, 0)
        place_a = np.arange(len(self.a)) + ends_b[np.cumsum(group_a) - 1]
        place_b = np.arange(len(self.b)) + ends_a[np.cumsum(group_b)]
        names = np.empty(len(self.a) + len(self.b), object)
        sign_a, sign_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        sign_a[self.cuts_a], sign_b[self.cuts_b] = 1, 1
        names[place_a], names[place_b] = self.tokens.names_a[2 * self.a + sign_a], self.tokens.names_b[2 * self.b + sign_b]
        bounds = (self.starts_a + self.starts_b).tolist()
        return ["".join(names[x:y].tolist())[:-1] for x, y in zip(bounds, bounds[1:])]


_tokens: dict[str, TokenBytes] = {}


def tokens_for(description: str, model: bytes) -> TokenBytes:
    """Both tokenizers of this process: a worker that runs several tasks loads them once."""
    key = hashlib.sha256(description.encode() + model).hexdigest()
    if key not in _tokens:
        _tokens.clear()
        _tokens[key] = TokenBytes(description, model)
    return _tokens[key]


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[str], int]]:
    """``(ids, texts, bytes)`` of consecutive rows, about ``size`` characters together."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            ids.append(doc_id)
            texts.append(text)
            held += len(text)
            if held >= size:
                yield ids, texts, held
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts, held


def _sent(docs: DataFrame, byte_level: str, piece_model: str, id_col: str, text_col: str):
    ship_package(docs.sparkSession)
    with open(byte_level, encoding="utf-8") as first, open(piece_model, "rb") as second:
        sent = docs.sparkSession.sparkContext.broadcast((first.read(), second.read()))
    return sent, docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def token_groups(docs: DataFrame, byte_level: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, groups`` for every row: the groups of each text as ``a1,a2|b1;a3|b2,b3``, ids of both sides.

    The texts are encoded and treated as in :func:`aligned`; a text without tokens has the empty text. Nothing is shuffled.
    """
    sent, rows = _sent(docs, byte_level, piece_model, id_col, text_col)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, _ in _groups(batches, GROUP_BYTES):
            spelled = Aligned(tokens_for(*sent.value), texts).spelled()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(spelled, pa.string())], ["doc_id", "groups"])

    return rows.mapInArrow(group, "doc_id long, groups string")


_DOCS = [("doc_id", "long"), ("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("groups_sha256", "string")]
_BLOCK = "block long, " + ", ".join(f"{name} array<{kind}>" for name, kind in _DOCS) + ", links binary, pairs array<long>, counts array<long>"


def _block(number: int, parts: list[tuple]) -> pa.RecordBatch:
    """One row for some documents: their columns, their links as indices into the distinct pairs, and these with their counts."""
    pairs, links, counts = np.unique(np.concatenate([x[-1] for x in parts]), return_inverse=True, return_counts=True)
    kind = "<u2" if len(pairs) <= 1 << 16 else "<u4"
    kinds = [pa.string() if k == "string" else pa.int64() for _, k in _DOCS]
    columns = [pa.array([sum((x[i] for x in parts), [])], pa.list_(k)) for i, k in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), *columns, pa.array([links.astype(kind).tobytes()], pa.binary()), pa.array([pairs], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))],
        ["block", *[x for x, _ in _DOCS], "links", "pairs", "counts"],
    )


def aligned(docs: DataFrame, byte_level: str, piece_model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    ``byte_level`` is the path of a tokenizers description (A), ``piece_model`` that of a sentencepiece model (B);
    both are read on the driver and sent to the tasks. A encodes a blank and the text, B the text, to which it
    adds the blank itself; strings of special tokens are plain text. Byte offsets at which tokens of both end cut them into groups;
    the last tokens of a group are linked. The count of a pair of ids is the number of links of that pair in all rows.
    ``n_best`` counts the links whose pair has the highest count of its B id, ties included, and ``count_sum`` adds the counts of
    all links. ``groups_sha256`` is the hex digest of the text that :func:`token_groups` gives.

    Null and empty texts, and those whose tokens do not spell a blank and the text (as with a literal U+2581),
    have no tokens: zeros and an empty text for the digest. Repeated rows count as often as they occur and
    give a row each. Texts are encoded whole, however long. Other columns are ignored; an empty table gives no rows.

    The texts are read once. Distinct pairs per block of about BLOCK_BYTES are summed in Spark, and each block gets the counts of its
    own pairs back; only the highest count of every B id, at most one number for each of its ids, is small by nature.
    """
    sent, rows = _sent(docs, byte_level, piece_model, id_col, text_col)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, parts = TaskContext.get().partitionId() << 32, 0, []
        for ids, texts, size in _groups(batches, GROUP_BYTES):
            some = Aligned(tokens_for(*sent.value), texts)
            n_a, n_b, n_groups = (np.diff(x).tolist() for x in (some.starts_a, some.starts_b, some.groups))
            digests = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in some.spelled()]
            parts.append((ids, n_a, n_b, n_groups, digests, some.pairs()))
            held += size
            if held >= BLOCK_BYTES:
                yield _block(number, parts)
                number, held, parts = number + 1, 0, []
        if parts:
            yield _block(number, parts)

    blocks = settled(rows.mapInArrow(align, _BLOCK), "aligned")
    each = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "found"))
    each = each.select("block", "place", F.col("found.pairs").alias("pair"), F.col("found.counts").alias("n"))
    counts = settled(each.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    second = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    best = counts.groupBy(second.alias("second")).agg(F.max("n").alias("most"))
    judged = counts.join(best, second == F.col("second")).select("pair", F.col("n").alias("total"), (F.col("n") == F.col("most")).alias("best"))
    back = each.select("block", "place", "pair").join(judged, "pair")
    back = back.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "total", "best"))).alias("judged"))
    back = back.select("block", F.col("judged.total").alias("totals"), F.col("judged.best").alias("bests"))
    joined = blocks.drop("pairs", "counts").join(back, "block", "left")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield _judged({name: column[k] for name, column in zip(batch.schema.names, batch.columns)})

    return joined.mapInArrow(judge, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _judged(row: dict) -> pa.RecordBatch:
    """The rows of a block's documents."""
    totals, bests = (row[x].values.to_numpy(zero_copy_only=False).astype(np.int64) if row[x].is_valid else np.empty(0, np.int64) for x in ("totals", "bests"))
    n_groups = row["n_groups"].values
    links = np.frombuffer(row["links"].as_py(), "<u2" if len(totals) <= 1 << 16 else "<u4")
    bounds = np.concatenate([[0], np.cumsum(n_groups.to_numpy())])
    sums = [pa.array(np.diff(np.concatenate([[0], np.cumsum(x[links])])[bounds]), pa.int64()) for x in (bests, totals)]
    return pa.RecordBatch.from_arrays(
        [row[x].values for x in ("doc_id", "n_a", "n_b", "n_groups")] + [n_groups, *sums, row["groups_sha256"].values],
        ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    )
