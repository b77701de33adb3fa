"""Byte-pair encoding by an index from every pair to all its places, and decoding.

The distinct words of a block of texts lie one after another in one array of symbols. An index maps each
pair that has a merge to all places where it stands. The active ranks are taken in ascending order;
a rank is applied at all its places at once, and the lists of the pairs that the merges make are extended. Lists
are not searched for places that are gone: a place whose pair has changed is passed over.

No merge of the model makes a symbol that an earlier merge needs (this is checked), so the pairs that a rank
makes have higher ranks, each rank is met once, and words that do not touch each other may be merged together.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratalith.llm.common import ship_package
from stratalith.llm.encoding import byte_symbols
from stratalith.llm.token_counts import PATTERN

# Characters of the texts that are encoded together.
BLOCK_CHARS = 1 << 20
_BITS = 20


class PairIndexEncoder:
    """Ids of texts; remembers chunks between blanks and words, in memories that start anew when they are full."""

    def __init__(self, description: str, limit: int = 400_000):
        model = json.loads(description)
        bpe = model["model"]
        if bpe["type"] != "BPE" or bpe.get("dropout") or bpe.get("ignore_merges") or bpe.get("continuing_subword_prefix"):
            raise ValueError("a plain byte-pair model is needed")
        steps = (model.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if [x["type"] for x in (model.get("normalizer") or {}).get("normalizers", [])] != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
            raise ValueError("this tokenizer cuts texts in another way")
        if model.get("decoder"):
            raise ValueError("this tokenizer joins its tokens in another way")
        vocabulary, suffix = bpe["vocab"], bpe.get("end_of_word_suffix") or ""
        spelled = byte_symbols()
        if missing := [x for x in spelled if x not in vocabulary or x + suffix not in vocabulary]:
            raise ValueError(f"symbols without an entry: {missing[:5]}")
        self.inner, self.last = (np.array([vocabulary[x + end] for x in spelled], np.int64) for end in ("", suffix))
        # Pairs of symbols in one number, ascending, with their ranks; and by rank the pair and the symbol that it becomes.
        pairs, self.merges, needed = {}, [], {}
        for rank, pair in enumerate(bpe["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, made = vocabulary[a], vocabulary[b], vocabulary[a + b]
            needed.setdefault(left, rank)
            needed.setdefault(right, rank)
            pairs[(left << _BITS) | right] = rank
            self.merges.append((left, right, made))
        if any(needed.get(made, rank) < rank for rank, (_, _, made) in enumerate(self.merges)):
            raise ValueError("a merge makes a symbol that an earlier merge needs")
        self.keys = np.array(sorted(pairs), np.int64)
        self.rank_of = np.array([pairs[x] for x in sorted(pairs)], np.int64)
        added = {x["content"]: x["id"] for x in model.get("added_tokens", [])}
        if any(regex.search(r"\s", x["content"]) or x.get("lstrip") or x.get("rstrip") or x.get("single_word") or x.get("normalized") for x in model.get("added_tokens", [])):
            raise ValueError("only literal added tokens without white space are known")
        self.added = {x: self.packed([n]) for x, n in added.items()}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.starts = {x[0] for x in added}
        tokens = {**{n: x for x, n in vocabulary.items()}, **{n: x for x, n in added.items()}}
        self.tokens = np.array([(tokens.get(n, "") + " ").encode() for n in range(max(tokens) + 1)], object)
        self.split = regex.compile(PATTERN).findall
        self.limit = limit
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {"": b""}

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder != "little":
            out.byteswap()
        return out.tobytes()

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols; -1 where it has no merge, or where one of them is none."""
        wanted = (left << _BITS) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank_of[at], -1)

    def merged(self, words: list[str]) -> list[bytes]:
        """The ids of each word, by one pair index over all of them."""
        if not words:
            return []
        data = [x.encode() for x in words]
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        places = np.frombuffer(b"".join(data), np.uint8)
        n = len(places)
        # Place n stands for the end of every word; its symbol is in no pair.
        symbols = np.append(self.inner[places], -1)
        symbols[ends - 1] = self.last[places[ends - 1]]
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[ends - 1] = after[n] = n
        before[0], before[ends[:-1]] = n, n
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Add places to the lists of the pairs that stand there now."""
            ranks = self._ranks(symbols[at], symbols[after[at]])
            some = np.flatnonzero(ranks >= 0)
            if not len(some):
                return
            some = some[np.argsort(ranks[some], kind="stable")]
            at, ranks = at[some], ranks[some]
            first = np.flatnonzero(np.diff(ranks, prepend=-1))
            for rank, start, end in zip(ranks[first].tolist(), first.tolist(), [*first[1:].tolist(), len(at)]):
                if rank in index:
                    index[rank].append(at[start:end])
                else:
                    index[rank] = [at[start:end]]
                    heappush(active, rank)

        note(np.arange(n))
        while active:
            rank = heappop(active)
            left, right, made = self.merges[rank]
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            gone = after[at]
            there = (symbols[at] == left) & (symbols[gone] == right)
            at = at[there]
            if left == right:
                at = self._apart(np.unique(at), after)
                gone = after[at]
            else:
                gone = gone[there]
            if not len(at):
                continue
            symbols[at], symbols[gone] = made, -2
            follow = after[gone]
            after[at], before[follow] = follow, at
            note(np.concatenate([at, before[at]]))
        kept = symbols[:n] >= 0
        ids = symbols[:n][kept].astype("<u4").tobytes()
        bounds = [0, *(4 * np.cumsum(kept)[ends - 1]).tolist()]
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    @staticmethod
    def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Of places of a pair of equal symbols those that do not overlap, the first of a run first."""
        out, gone = [], -1
        for k, follow in zip(at.tolist(), after[at].tolist()):
            if k != gone:
                out.append(k)
                gone = follow
        return np.array(out, np.int64)

    def words_of(self, text: str) -> list[str]:
        """The words of a text without special tokens and blanks."""
        if text.isascii():
            text = text.lower()
        else:
            text = unicodedata.normalize("NFC", text)
            # Letter by letter where it matters: the tokenizer knows no final sigma.
            text = text.lower() if "Σ" not in text else "".join([x.lower() for x in text])
        return [text] if text.isalpha() else self.split(text)

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks that are not remembered; their new words share one pair index."""
        starts = tuple(self.starts)
        single: dict[str, str] = {}
        several: dict[str, list[str]] = {}
        special: dict[str, list[list[str] | bytes]] = {}
        for chunk in chunks:
            if any([x in chunk for x in starts]):
                special[chunk] = [self.added[x] if x in self.added else self.words_of(x) for x in self.special.split(chunk)]
            elif chunk.isalpha() and chunk.isascii():
                single[chunk] = chunk.lower()
            else:
                several[chunk] = self.words_of(chunk)
        new = set(single.values()).union(*several.values(), *[x for parts in special.values() for x in parts if isinstance(x, list)])
        new.difference_update(self.words)
        listed = list(new)
        words, held = self.words, self.chunks
        words.update(zip(listed, self.merged(listed)))
        for chunk, word in single.items():
            held[chunk] = words[word]
        for chunk, parts in several.items():
            held[chunk] = words[parts[0]] if len(parts) == 1 else b"".join([words[x] for x in parts])
        for chunk, mixed in special.items():
            held[chunk] = b"".join([x if isinstance(x, bytes) else b"".join([words[w] for w in x]) for x in mixed])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers. White space belongs to no token and separates words."""
        if len(self.chunks) >= self.limit or len(self.words) >= self.limit:
            self.words, self.chunks = {}, {"": b""}
        cut = [text.replace("\n", " ").split(" ") for text in texts]
        new: set[str] = set()
        for chunks in cut:
            new.update(chunks)
        self.learn(new - self.chunks.keys())
        return [b"".join(map(self.chunks.__getitem__, chunks)) for chunks in cut]

    def decode(self, ids: bytes) -> str:
        """The tokens of packed ids, special ones included, with a blank between two; an unknown id is an error."""
        return b"".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())[:-1].decode()


_encoders: dict[str, PairIndexEncoder] = {}


def encoder_for(description: str) -> PairIndexEncoder:
    """The encoder of this process: a worker that runs several tasks goes on with what it knows."""
    key = hashlib.sha256(description.encode()).hexdigest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = PairIndexEncoder(description)
    return _encoders[key]


def _blocks(column: pa.Array, limit: int) -> Iterator[tuple[int, list]]:
    """The values of a column a few at a time, about ``limit`` long together, with the place of the first."""
    first, held, size = 0, [], 0
    for k, value in enumerate(column):
        held.append(value.as_py())
        size += len(held[-1] or "")
        if size >= limit:
            yield first, held
            first, held, size = k + 1, [], 0
    if held:
        yield first, held


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row of ``docs``; ids are packed as little-endian unsigned 32-bit numbers.

    ``tokenizer`` is the path of a description with white-space-free words (lower case, end-of-word
    suffix), read on the driver and sent to the tasks. Ids are those of the library without
    padding, truncation or added special tokens; strings of special tokens inside a text become their ids.
    With ``decode`` the text of the ids follows as ``decoded``, see :func:`decoded`.
    Null texts count as empty: no ids. Texts are encoded whole, however long. Rows are not combined or
    dropped, other columns are ignored; an empty table gives no rows. Nothing is shuffled.
    """
    ship_package(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as source:
        sent = docs.sparkSession.sparkContext.broadcast(source.read())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or encoder_for(sent.value)
            for first, texts in _blocks(batch.column(1), BLOCK_CHARS):
                ids = encoder.encode([x or "" for x in texts])
                columns = [batch.column(0).slice(first, len(ids)), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decode:
                    columns.append(pa.array([encoder.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"][: len(columns)])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids binary" + ", decoded string" * decode)


def decoded(rows: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of their packed ids: all tokens, special ones too, with blanks between.

    Null ids give null and no ids the empty text; an id that the tokenizer does not know fails the job. A
    column named ``decoded`` is replaced, all others stay as they are. Nothing is shuffled.
    """
    ship_package(rows.sparkSession)
    with open(tokenizer, encoding="utf-8") as source:
        sent = rows.sparkSession.sparkContext.broadcast(source.read())
    rows = rows.drop("decoded")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or encoder_for(sent.value)
            for first, ids in _blocks(batch.column(batch.schema.get_field_index(ids_col)), 4 * BLOCK_CHARS):
                texts = pa.array([None if x is None else encoder.decode(x) for x in ids], pa.string())
                block = batch.slice(first, len(ids))
                yield pa.RecordBatch.from_arrays([*block.columns, texts], [*block.schema.names, "decoded"])

    return rows.mapInArrow(decode, StructType([*rows.schema.fields, StructField("decoded", StringType())]))
