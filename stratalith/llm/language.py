"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that its code point fixes. A trigram binds three of them:
the first permuted twice, the second once, the third not at all, multiplied place by place. A text
bundles its trigram vectors by adding them; a language's prototype is the bundle of all its training
texts. A text gets the language whose prototype has the largest cosine with its bundle. Bundling is
linear, so trigrams are counted first and each distinct one is bound once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratalith.llm.common import MIX, U64, mixed, ship_package

DIMENSIONS = 1024
UNKNOWN = "und"
# Characters of a text that are looked at together; the result does not depend on it.
SPAN = 1 << 20
# Bound trigram vectors that are remembered, four KB each; when they are full the memory starts anew.
REMEMBERED = 12_000
# Documents that are compared with the prototypes together.
TOGETHER = 64
_CODE = 21  # bits of a code point


def _letters() -> np.ndarray:
    """For each code point itself where it is a letter, else 0."""
    table = np.zeros(0x110000, np.int64)
    letters = [x for x in range(0x110000) if chr(x).isalpha()]
    table[letters] = letters
    return table


class Vectors:
    """Letter and trigram vectors, and the bundles of texts."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 1):
        self.dimensions, self.seed = dimensions, seed
        self.table = _letters()
        self.letters: dict[int, np.ndarray] = {}
        self.place: dict[int, int] = {}
        self.bound = np.zeros((0, dimensions), np.float32)

    def letter(self, code: int) -> np.ndarray:
        """Signs from the bits of a hash of code point and dimension; 0, which stands for all but letters, has one too."""
        if code not in self.letters:
            words = mixed(mixed(np.arange(self.dimensions // 64 + 1, dtype=U64) + U64(code * MIX[0] % (1 << 64))) + U64(self.seed))
            bits = np.unpackbits(words.view(np.uint8))[: self.dimensions]
            self.letters[code] = (2 * bits.astype(np.int8) - 1)
        return self.letters[code]

    def trigram(self, code: int) -> np.ndarray:
        mask = (1 << _CODE) - 1
        first, second, third = code >> 2 * _CODE, (code >> _CODE) & mask, code & mask
        return np.roll(self.letter(first), 2) * np.roll(self.letter(second), 1) * self.letter(third)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigrams of the lower-cased text and how often they occur; runs of other characters count as one blank."""
        codes, counts = [], []
        text = f" {(text or '').lower()} "
        # The last two letters or blanks that count, of what comes before.
        before = np.empty(0, np.int64)
        for at in range(0, len(text), SPAN):
            points = np.frombuffer(text[at : at + SPAN].encode("utf-32-le", "replace"), np.uint32)
            letters = np.concatenate([before[-1:], self.table[points]])
            keep = np.ones(len(letters), bool)
            keep[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
            letters = np.concatenate([before[:-1], letters[keep]])
            before = letters[-2:]
            if len(letters) > 2:
                code = (letters[:-2] << 2 * _CODE) | (letters[1:-1] << _CODE) | letters[2:]
                found = np.unique(code, return_counts=True)
                codes.append(found[0])
                counts.append(found[1])
        if not codes:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if len(codes) == 1:
            return codes[0], counts[0]
        distinct, index = np.unique(np.concatenate(codes), return_inverse=True)
        return distinct, np.bincount(index, np.concatenate(counts)).astype(np.int64)

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """The places of bound trigrams in ``self.bound``, which are made where they are missing."""
        new = [c for c in codes.tolist() if c not in self.place]
        if len(self.place) + len(new) > REMEMBERED:
            self.place, self.bound = {}, np.zeros((0, self.dimensions), np.float32)
            new = codes.tolist()
        if new:
            room = len(self.place) + len(new)
            if room > len(self.bound):
                grown = np.zeros((max(room, min(REMEMBERED, 2 * len(self.bound))), self.dimensions), np.float32)
                grown[: len(self.place)] = self.bound[: len(self.place)]
                self.bound = grown
            for c in new:
                self.bound[len(self.place)] = self.trigram(c)
                self.place[c] = len(self.place)
        return np.fromiter(map(self.place.__getitem__, codes.tolist()), np.int64, len(codes))

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the trigrams' vectors, exact, in stretches."""
        total = np.zeros(self.dimensions, np.int64)
        for at in range(0, len(codes), 4096):
            vectors = np.stack([self.trigram(c) for c in codes[at : at + 4096].tolist()]).astype(np.int64)
            total += counts[at : at + 4096] @ vectors
        return total

    def bundles(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One bundle for each counted text, by one matrix product for all of them."""
        distinct = np.unique(np.concatenate([c for c, _ in texts]))
        if len(distinct) > REMEMBERED // 2:
            return np.stack([self.bundle(c, n).astype(np.float64) for c, n in texts])
        table = np.zeros((len(texts), len(distinct)), np.float32)
        for k, (codes, counts) in enumerate(texts):
            table[k, np.searchsorted(distinct, codes)] = counts
        rows = self.rows(distinct)
        return (table @ self.bound[rows]).astype(np.float64)


def prototypes(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", dimensions: int = DIMENSIONS) -> list[tuple[str, np.ndarray]]:
    """The bundle of each language, from every row with a text and a language.

    Tasks count the trigrams of each language, bind and bundle them, and send one vector per language;
    the sums are whole numbers, so their order does not matter. The driver gets one vector per language.
    Rows without a text or a language teach nothing, repeated rows count as often as they occur, and a language whose texts have no letters has
    no prototype. Other columns are ignored; an empty table gives none. Texts are read whole.
    """
    ship_package(labelled.sparkSession)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, totals = Vectors(dimensions), {}
        for batch in batches:
            counted: dict[str, list] = {}
            for lang, text in zip(batch.column(0), batch.column(1)):
                counted.setdefault(lang.as_py(), []).append(vectors.counts(text.as_py()))
            for lang, found in counted.items():
                codes, index = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                counts = np.zeros(len(codes), np.int64)
                np.add.at(counts, index, np.concatenate([n for _, n in found]))
                totals[lang] = totals.get(lang, 0) + vectors.bundle(codes, counts)
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals)), pa.array(list(totals.values()), pa.list_(pa.int64()))], ["lang", "vector"])

    parts = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null").mapInArrow(learn, "lang string, vector array<long>")
    sums = parts.select("lang", F.posexplode("vector").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    rows = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("vector")).collect()
    found = [(r.lang, np.array([x.value for x in r.vector], np.float64)) for r in sorted(rows, key=lambda r: r.lang)]
    return [(lang, v / np.linalg.norm(v)) for lang, v in found if v.any()]


def languages(docs: DataFrame, known: list[tuple[str, np.ndarray]], id_col: str = "doc_id", text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``, and the columns named in ``extra`` as they are.

    The score is the cosine, not below 0. Texts without a letter, null texts, and all texts where no
    language is known get ``und`` and 0; of languages with equal cosines the first in order is taken.
    Rows are not combined or shuffled; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    names = [n for n, _ in known]
    sent = docs.sparkSession.sparkContext.broadcast(np.stack([v for _, v in known], axis=1) if known else None)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = None
        for batch in batches:
            if vectors is None and names:
                vectors = Vectors(len(sent.value))
            langs, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            for at in range(0, batch.num_rows if names else 0, TOGETHER):
                counted = [(k, vectors.counts(batch.column(1)[k].as_py())) for k in range(at, min(at + TOGETHER, batch.num_rows))]
                counted = [(k, c) for k, c in counted if len(c[0])]
                if not counted:
                    continue
                bundles = vectors.bundles([c for _, c in counted])
                norms = np.linalg.norm(bundles, axis=1)
                cosines = np.round(bundles @ sent.value / np.where(norms > 0, norms, 1)[:, None], 6)
                for (k, _), row in zip(counted, cosines):
                    best = int(row.argmax())
                    langs[k], scores[k] = names[best], float(min(1.0, max(0.0, row[best])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), *batch.columns[2:]], ["doc_id", "lang_pred", "score", *extra]
            )

    kinds = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in extra)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *extra).mapInArrow(predict, "doc_id long, lang_pred string, score double" + kinds)
