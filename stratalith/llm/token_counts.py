"""Token counts by byte-pair merging with a heap and a linked list; no ids are formed.

The symbols of a word form a linked list, its adjacent pairs a heap by rank. The lowest pair is
popped again and again; a popped pair that has changed meanwhile is passed over. Each merge takes one
symbol away, so the count of a word is its initial symbols less its merges. Words repeat, so counts of
words and of stretches between blanks are remembered in bounded memories.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from stratalith.llm.common import ship_package
from stratalith.llm.encoding import byte_symbols

# White space in the sense of the tokenizer's pattern.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed value: the pattern of the tokenizer description, with its white space spelled out.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACE + r"\p{L}\p{N}]+"


class _Memory(dict):
    """A bounded memory of a function; when it is full it starts anew."""

    def __init__(self, made, limit: int):
        super().__init__()
        self.made, self.limit = made, limit

    def __missing__(self, key):
        value = self.made(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


# Bits of a symbol's number, and of a place in a word; rank, symbol and place share one number in the heap.
_SYMBOL_BITS, _PLACE_BITS = 20, 40
_SYMBOL, _PLACE = (1 << _SYMBOL_BITS) - 1, (1 << _PLACE_BITS) - 1


class TokenCounter:
    def __init__(self, description: str, limit: int = 400_000):
        model = json.loads(description)
        bpe = model["model"]
        if bpe["type"] != "BPE" or bpe.get("dropout") or bpe.get("ignore_merges") or bpe.get("continuing_subword_prefix"):
            raise ValueError("a plain byte-pair model is needed")
        steps = (model.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if [x["type"] for x in (model.get("normalizer") or {}).get("normalizers", [])] != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in steps] != ["Split", "ByteLevel"]:
            raise ValueError("this tokenizer cuts texts in another way")
        vocabulary, suffix = bpe["vocab"], bpe.get("end_of_word_suffix") or ""
        spelled = byte_symbols()
        if missing := [x for x in spelled if x not in vocabulary or x + suffix not in vocabulary]:
            raise ValueError(f"symbols without an entry: {missing[:5]}")
        self.inner, self.last = [vocabulary[x] for x in spelled], [vocabulary[x + suffix] for x in spelled]
        # A pair of symbols to its rank and the symbol that it becomes, in one number.
        self.pairs = {}
        for rank, pair in enumerate(bpe["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[(vocabulary[a] << _SYMBOL_BITS) | vocabulary[b]] = (rank << _SYMBOL_BITS) | vocabulary[a + b]
        special = [x["content"] for x in model.get("added_tokens", [])]
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.starts = {x[0] for x in special}
        self.words = regex.compile(PATTERN)
        self.of_word = _Memory(self.count_word, limit)
        self.of_chunk = _Memory(self.count_chunk, limit)

    def count_word(self, word: str) -> int:
        data = word.encode()
        n = len(data)
        if n == 1:
            return 1
        inner, known = self.inner, self.pairs.get
        parts = [inner[x] for x in data]
        parts[-1] = self.last[data[-1]]
        # What the pair that begins at each place would become; -1 where it has no merge or is gone.
        pair = [known((a << _SYMBOL_BITS) | b, -1) for a, b in zip(parts, parts[1:])]
        heap = [(p << _PLACE_BITS) | k for k, p in enumerate(pair) if p >= 0]
        heapify(heap)
        pair.append(-1)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        count = n
        while heap:
            lowest = heappop(heap)
            k = lowest & _PLACE
            if pair[k] != lowest >> _PLACE_BITS:
                continue
            parts[k] = merged = pair[k] & _SYMBOL
            count -= 1
            gone = after[k]
            pair[gone] = pair[k] = -1
            after[k] = follow = after[gone]
            if follow < n:
                before[follow] = k
                pair[k] = p = known((merged << _SYMBOL_BITS) | parts[follow], -1)
                if p >= 0:
                    heappush(heap, (p << _PLACE_BITS) | k)
            previous = before[k]
            if previous >= 0:
                pair[previous] = p = known((parts[previous] << _SYMBOL_BITS) | merged, -1)
                if p >= 0:
                    heappush(heap, (p << _PLACE_BITS) | previous)
        return count

    def count_plain(self, text: str) -> int:
        if text.isascii():
            text = text.lower()
            if text.isalpha():
                return self.of_word[text]
            if text[:-1].isalpha() and not text[-1].isalnum():
                return self.of_word[text[:-1]] + self.count_rest(text[-1])
        else:
            # Letter by letter: the tokenizer knows no final sigma.
            text = "".join([x.lower() for x in unicodedata.normalize("NFC", text)])
            if text.isalpha():
                return self.of_word[text]
        return self.count_rest(text)

    def count_rest(self, text: str) -> int:
        return sum(map(self.of_word.__getitem__, self.words.findall(text)))

    def count_chunk(self, chunk: str) -> int:
        if self.special and not self.starts.isdisjoint(chunk):
            return sum(1 if k % 2 else self.count_plain(part) for k, part in enumerate(self.special.split(chunk)))
        return self.count_plain(chunk)

    def count(self, text: str) -> int:
        """White space separates words and belongs to none, so a text is cut at blanks and line ends."""
        total, start = 0, 0
        while len(text) - start > 1 << 20:
            cut = text.find(" ", start + (1 << 20))
            if cut < 0:
                break
            total += sum(map(self.of_chunk.__getitem__, text[start:cut].replace("\n", " ").split(" ")))
            start = cut
        return total + sum(map(self.of_chunk.__getitem__, text[start:].replace("\n", " ").split(" ")))


_counters: dict[str, TokenCounter] = {}


def counter_for(description: str) -> TokenCounter:
    """The counter of this process: a worker that runs several tasks goes on with what it knows."""
    key = hashlib.sha256(description.encode()).hexdigest()
    if key not in _counters:
        _counters.clear()
        _counters[key] = TokenCounter(description)
    return _counters[key]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    ``tokenizer`` is the path of a description with white-space-free words (lower case, end-of-word
    suffix), read on the driver and sent to the tasks. Counts are those of the library without
    padding, truncation or added special tokens; strings of special tokens inside a text count as one
    token each. Null texts count as empty: no bytes, no tokens. Rows are not combined or dropped, other
    columns are ignored; an empty table gives no rows. Nothing is shuffled.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer, encoding="utf-8") as source:
        sent = spark.sparkContext.broadcast(source.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or counter_for(sent.value)
            sizes, counts = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                sizes.append(len(text) if text.isascii() else len(text.encode()))
                counts.append(counter.count(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([x > limit for x in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
