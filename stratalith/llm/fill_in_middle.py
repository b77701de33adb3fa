"""Fill-in-middle transformation: texts are cut at two places and their parts put in another order.

The units of a text (code points, or the matches of a pattern) form a skip list. Every link carries how
many units and how many code points it passes, so a cut given as a rank of units is reached from the head
by going along the widest lane while the units passed do not exceed the rank, then down; the code points
passed on the way are the place where the text is cut. A node is on lane ``k`` if the hash of its rank
ends in ``k * LANE_BITS`` zero bits, so the ranks of a lane are the same in every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from stratalith.llm.common import U64, mixed, ship_package

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# One node in 2 ** LANE_BITS of a lane is on the next one too.
LANE_BITS = 3
# Characters of the texts that are returned at a time.
BATCH_CHARS = 1 << 22


class _Lanes:
    """The ranks on each express lane, for texts of up to ``size`` units; grows when a longer text comes."""

    def __init__(self):
        self.size = 0
        self.lanes: list[np.ndarray] = []

    def upto(self, n: int) -> list[np.ndarray]:
        if n > self.size:
            self.size = max(n, 2 * self.size, 1 << 12)
            ranks, self.lanes = np.arange(1, self.size + 1, dtype=np.int64), []
            drawn, bits = mixed(ranks.astype(U64)), 0
            while len(ranks):
                bits += LANE_BITS
                stay = drawn & U64((1 << bits) - 1) == 0
                ranks, drawn = ranks[stay], drawn[stay]
                self.lanes.append(np.concatenate([np.zeros(1, np.int64), ranks]))
        out = []
        for ranks in self.lanes:
            last = int(np.searchsorted(ranks, n, side="right"))
            if last < 2:
                break
            out.append(ranks[:last])
        return out


_LANES = _Lanes()


class SkipList:
    """Units in order, each given by its number of code points; ``lanes[0]`` is the list of all units."""

    def __init__(self, widths: np.ndarray):
        self.n = len(widths)
        # For each lane: the node below each node, units of each link, code points of each link.
        self.lanes: list[tuple[np.ndarray | None, np.ndarray | None, np.ndarray]] = [(None, None, widths)]
        below, chars = None, widths
        for ranks in _LANES.upto(self.n):
            down = ranks if below is None else np.searchsorted(below, ranks)
            # Links of the lane below that each link passes; those after its last node belong to none.
            chars = np.add.reduceat(chars, down[:-1], dtype=np.int64) if down[-1] == len(chars) else np.add.reduceat(chars, down, dtype=np.int64)[:-1]
            self.lanes.append((down, np.diff(ranks), chars))
            below = ranks

    def reach(self, rank: int) -> int:
        """The code points of the first ``rank`` units."""
        if not 0 <= rank <= self.n:
            raise IndexError(rank)
        node = units = passed = 0
        for down, unit_width, char_width in reversed(self.lanes):
            if unit_width is None:
                # The list of all units: every link passes one.
                return passed + int(char_width[node : node + rank - units].sum(dtype=np.int64))
            while node < len(unit_width) and units + unit_width[node] <= rank:
                units += int(unit_width[node])
                passed += int(char_width[node])
                node += 1
            node = int(down[node])
        raise AssertionError("a skip list has a lane of all units")


def unit_widths(text: str, unit: regex.Pattern | None) -> np.ndarray:
    """Code points of each unit, left to right: matches of the pattern, and each code point between them."""
    if unit is None:
        return np.ones(len(text), np.uint8)
    out, at = [], 0
    for match in unit.finditer(text):
        if match.end() > match.start():
            out += [1] * (match.start() - at)
            out.append(match.end() - match.start())
            at = match.end()
    return np.array(out + [1] * (len(text) - at), np.int64)


def draws(seed: int, doc_id: Column) -> list[Column]:
    """Four numbers below 2 ** 32 that a seed and an id fix; a missing id counts as an empty string."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, unit: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    A text of ``n`` units is cut after two ranks drawn from 0 to ``n``; the prefix ends at the smaller, the
    middle at the larger one, the suffix is the rest. Units are code points, or the matches of the pattern
    ``unit`` and the code points between them. ``form`` is ``psm`` (prefix, suffix, middle), ``spm``
    (suffix, prefix, middle) for ``spm_percent`` of the others, or ``plain``: unchanged, with null widths, for ``plain_percent``
    of the texts, for empty ones and those that hold a marker already, since they could not be restored.
    Null texts count as empty. Draws depend on seed and id only, so repeated rows get the same form and,
    with equal texts, the same output. Other columns are ignored, whatever their names; an empty table
    gives no rows. Nothing is shuffled, texts are never shortened.
    """
    ship_package(docs.sparkSession)
    doc_id = F.col(id_col).cast("long")
    h = draws(seed, doc_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(unit) if unit else None
        for batch in batches:
            rows, held = [], 0
            for doc_id, text, h1, h2, h3, h4 in zip(*batch.columns):
                text = text.as_py() or ""
                rows.append((doc_id.as_py(), *_cut(text, pattern, h1.as_py(), h2.as_py(), h3.as_py() % 100 >= 100 - plain_percent, h4.as_py() % 100 < spm_percent)))
                held += len(text)
                if held >= BATCH_CHARS:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    rows = docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text"), *[x.alias(f"h{k}") for k, x in enumerate(h, 1)])
    return rows.mapInArrow(cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def _cut(text: str, unit: regex.Pattern | None, h1: int, h2: int, plain: bool, spm: bool) -> tuple:
    widths = unit_widths(text, unit)
    n = len(widths)
    if plain or not text or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    units = SkipList(widths)
    first, last = (units.reach(rank) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:last], text[last:]
    output = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}" if spm else f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, "spm" if spm else "psm", first, last - first, output


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, field.type) for x, field in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def restored(transformed: DataFrame) -> DataFrame:
    """The rows of :func:`fill_in_middle` with ``restored``, the text rebuilt from ``output`` and ``form`` alone.

    No part holds a marker, and no marker begins with the end of another, so the markers found are those
    put in. An output without its markers gives null, an unknown form too. Other columns stay as they are.
    """
    parts = F.split("output", f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    taken = transformed.select("*", F.when(F.col("form") != "plain", parts).alias("__parts"))
    part = [F.get("__parts", F.lit(k)) for k in range(4)]
    text = F.when(F.col("form") == "plain", F.col("output")).when(F.col("form") == "psm", F.concat(part[1], part[3], part[2])).when(F.col("form") == "spm", F.concat(part[2], part[3], part[1]))
    return taken.withColumn("restored", text).drop("__parts")
