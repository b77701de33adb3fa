"""Removal of repeated byte strings with suffix arrays.

Every window of WINDOW bytes picks the gram with the smallest hash inside it, which depends on the
window's bytes alone: equal windows pick equal grams. Consecutive windows that pick the same place form
a *stretch*. Stretches whose gram occurs once in the corpus cannot repeat and are never moved. The
others are dealt to shards by gram, so equal windows meet. A shard sorts its suffixes by
Larsson-Sadakane refinement, takes common prefixes by Kasai's rule, and marks every window that has an
earlier equal one. Grams that are too frequent for one shard are dealt to several; the windows that are
first in their shard are then sorted and merged across shards by binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratalith.llm.common import MIX, U64, hot_among, mixed, release, settled, ship_package
from stratalith.operators.joins import spread_join

WINDOW = 100
GRAM = 32
# Windows that are looked at together; a longer text is cut, with WINDOW - 1 bytes of overlap.
SPAN = 1 << 20
PLACE_BITS = np.uint64(21)
# Texts that share a gram beyond which it is dealt to several shards.
HOT = 2048
# Bytes of stretches in one shard, on average.
SHARD_BYTES = 1 << 20
LAST = (1 << 63) - 1


def stretches(data: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first window, windows, gram hash`` of each stretch of ``data``, at most SPAN windows long.

    ``ends`` gives the end of the text that each byte belongs to; windows do not pass it.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U64)
    grams, length = data.astype(U64) + U64(1), 1
    while length < GRAM:
        m = len(grams) - length
        # The mix in between keeps repeated halves from cancelling out.
        grams = mixed(grams[:m] * U64(MIX[0]) + grams[length:])
        length *= 2
    place = np.arange(len(grams), dtype=U64)
    low = (grams >> PLACE_BITS << PLACE_BITS) | place
    width, span = WINDOW - GRAM + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: n], low[width - span : width - span + n])
    at = (low[:n] & U64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
    whole = np.ones(n, bool) if ends is None else ends[:n] >= np.arange(n) + WINDOW
    change = np.ones(n, bool)
    change[1:] = (at[1:] != at[:-1]) | (whole[1:] != whole[:-1]) | (False if ends is None else ends[1:n] != ends[: n - 1])
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, n))
    keep = whole[first]
    first, count = first[keep], count[keep]
    return first, count, grams[at[first]]


def batches_of_texts(texts: list[bytes], span: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int]], np.ndarray | None]]:
    """Buffers of about ``span`` bytes: the bytes, ``(index of text, place in it)`` by start in the buffer, and text ends."""
    held: list[int] = []
    size = 0

    def joined():
        data = np.frombuffer(b"".join(texts[k] for k in held), np.uint8)
        lengths = np.array([len(texts[k]) for k in held])
        return data, held, np.concatenate([[0], np.cumsum(lengths)])

    for k, text in enumerate(texts):
        if len(text) < WINDOW:
            continue
        if len(text) > span:
            for start in range(0, len(text) - WINDOW + 1, span):
                data = np.frombuffer(text, np.uint8)[start : start + span + WINDOW - 1]
                yield data, [k], np.array([0, len(data)]), start
            continue
        if held and size + len(text) > span:
            yield (*joined(), 0)
            held, size = [], 0
        held.append(k)
        size += len(text)
    if held:
        yield (*joined(), 0)


def found_stretches(texts: list[bytes], span: int) -> Iterator[tuple[np.ndarray, list[int], np.ndarray, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each buffer: bytes, texts, their bounds, place of the first, and the stretches with the number of their text."""
    for data, held, bounds, start in batches_of_texts(texts, span):
        ends = np.repeat(bounds[1:], np.diff(bounds))
        first, count, gram = stretches(data, ends)
        yield data, held, bounds, start, first, count, gram, np.searchsorted(bounds, first, side="right") - 1


def refine(data: np.ndarray, starts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """``starts`` sorted by the WINDOW bytes that follow, equal ones in ascending order.

    All suffixes are first sorted by 8 bytes; each round then orders what is still in one group by the
    group numbers ``h`` bytes further on, which doubles the sorted depth. Suffixes alone in their group
    are left as they are. The last round takes the step that ends at WINDOW exactly.
    """
    n = len(data)
    order = np.argsort(words[:n], kind="stable")
    key = words[order]
    fresh = np.ones(n, bool)
    fresh[1:] = key[1:] != key[:-1]
    heads = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.zeros(n + WINDOW, np.int64)
    rank[order] = heads
    h = 8
    while 2 * h < WINDOW:
        alone = fresh.copy()
        alone[:-1] &= fresh[1:]
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            # No two suffixes share more: the group number alone is the order.
            return starts[np.argsort(rank[starts])]
        some = order[open_]
        pair = (rank[some] << 32) | rank[some + h]
        by = np.argsort(pair, kind="stable")
        some, pair = some[by], pair[by]
        order[open_] = some
        new = np.ones(len(some), bool)
        new[1:] = pair[1:] != pair[:-1]
        fresh[open_] = new
        rank[some] = np.maximum.accumulate(np.where(new, open_, 0))
        h *= 2
    pair = (rank[starts] << 32) | rank[starts + WINDOW - h]
    return starts[np.argsort(pair, kind="stable")]


def common_prefixes(words: np.ndarray, order: np.ndarray, lanes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each window in sorted ``order``: bytes shared with its predecessor, WINDOW at most.

    Kasai's rule: from one place of a text to the next, the length falls by one at most. The windows of
    each lane are walked in text order, all lanes side by side. The rule needs the place after the
    predecessor to be sorted before the next window too; where that is not certain (the predecessor
    ends its lane, or was equal in all WINDOW bytes and another one follows) counting starts anew.
    """
    before = np.full(len(words) + 1, -1, np.int64)
    before[order[1:]] = order[:-1]
    window = np.zeros(len(words) + 1, bool)
    window[order] = True
    shared = np.zeros(len(words) + 1, np.int64)
    by = np.argsort(-counts, kind="stable")
    lanes, counts = lanes[by], counts[by]
    length, last = np.zeros(len(lanes), np.int64), np.full(len(lanes), -2, np.int64)
    for t in range(int(counts[0]) if len(counts) else 0):
        m = int(np.searchsorted(-counts, -t, side="left"))
        here = lanes[:m] + t
        there, after = before[here], last[:m] + 1
        holds = (there == after) | ((length[:m] < WINDOW) & window[after])
        now = np.where(holds & (there >= 0), np.maximum(length[:m] - 1, 0), 0)
        go = np.flatnonzero(there >= 0)
        while len(go):
            differ = words[here[go] + now[go]] ^ words[there[go] + now[go]]
            same = np.full(len(go), 8)
            unlike = np.flatnonzero(differ)
            # The highest bit that differs tells the first byte that does; without the bit below it, no rounding passes it.
            bits = differ[unlike]
            same[unlike] = 7 - (np.frexp((bits & ~(bits >> U64(1))).astype(np.float64))[1] - 1) // 8
            now[go] += same
            go = go[(same == 8) & (now[go] < WINDOW)]
        length[:m] = now = np.minimum(now, WINDOW)
        last[:m] = there
        shared[here] = now
    return shared[order]


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number that sorts as they do; beyond the end are zeros."""
    padded = np.concatenate([data, np.zeros(WINDOW + 8, np.uint8)]).astype(U64)
    words = np.zeros(len(data) + WINDOW, U64)
    for k in range(8):
        words |= padded[k : k + len(words)] << U64(56 - 8 * k)
    return words


def repeated_windows(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``starts, sorted order, repeats``: for windows of ``parts`` laid end to end, whether an earlier one is equal."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(x) for x in parts], np.int64)
    lanes = np.cumsum(sizes) - sizes
    counts = sizes - WINDOW + 1
    starts = np.repeat(lanes - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    words = words_at(data)
    order = refine(data, starts, words)
    repeats = common_prefixes(words, order, lanes, counts) >= WINDOW
    return starts, order, repeats


def _shard(table: pa.Table) -> pa.Table:
    """One shard: marks of repeated bytes, and for grams in several shards the windows that are first here."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("ord", "d64", "start", "count", "splits", "body"))), key=lambda r: r[:3])
    marks: list[tuple] = []  # ord, d64, start, end
    bodies: dict[bytes, tuple] = {}
    distinct: list[tuple] = []
    for r in rows:
        if r[5] is None:
            marks.append((r[0], r[1], r[2], r[2] + r[3] + WINDOW - 1))
        elif (seen := bodies.get(r[5])) is None:
            bodies[r[5]] = r[:3]
            distinct.append(r)
        elif seen != r[:3]:
            marks.append((r[0], r[1], r[2], r[2] + r[3] + WINDOW - 1))
    firsts: list[tuple] = []
    if distinct:
        parts = [r[5] for r in distinct]
        starts, order, repeats = repeated_windows(parts)
        repeated = np.zeros(int(starts[-1]) + 1, bool)
        repeated[order[repeats]] = True
        base = 0
        for r in distinct:
            flags = repeated[base : base + r[3]]
            edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
            marks += [(r[0], r[1], r[2] + int(a), r[2] + int(b) - 1 + WINDOW) for a, b in zip(edge[::2], edge[1::2])]
            if r[4] > 1:
                firsts += [(r[0], r[1], r[2] + int(k), r[5][k : k + WINDOW]) for k in np.flatnonzero(~flags)]
            base += len(r[5])
    columns = [[*(m[k] for m in marks), *(f[k] for f in firsts)] for k in range(3)]
    return pa.table({
        "ord": pa.array(columns[0], pa.int64()), "d64": pa.array(columns[1], pa.int64()), "start": pa.array(columns[2], pa.int64()),
        "end": pa.array([m[3] for m in marks] + [None] * len(firsts), pa.int64()),
        "body": pa.array([None] * len(marks) + [f[3] for f in firsts], pa.binary()),
    })


_SHARD_ROWS = "ord long, d64 long, start long, end long, body binary"


def _merge(table: pa.Table) -> pa.Table:
    """First windows of several shards, merged in ascending order of place; those that were there before are marked."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("ord", "d64", "start", "body"))), key=lambda r: r[:3])
    merged = np.empty(0, f"S{WINDOW}")
    again = []
    step = 4096
    for k in range(0, len(rows), step):
        run = np.array([r[3] for r in rows[k : k + step]], f"S{WINDOW}")
        place, first = np.searchsorted(merged, run), np.zeros(len(run), bool)
        known = (place < len(merged)) & (merged[np.minimum(place, max(0, len(merged) - 1))] == run) if len(merged) else np.zeros(len(run), bool)
        unique, index = np.unique(run, return_index=True)
        first[index] = True
        again += [rows[k + int(i)] for i in np.flatnonzero(known | ~first)]
        new = unique[~known[index]]
        merged = np.insert(merged, np.searchsorted(merged, new), new)
    return pa.table({
        "ord": pa.array([r[0] for r in again], pa.int64()), "d64": pa.array([r[1] for r in again], pa.int64()),
        "start": pa.array([r[2] for r in again], pa.int64()), "end": pa.array([r[2] + WINDOW for r in again], pa.int64()),
    })


def _bytes_of(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _grams(span: int):
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``gram, d64, buffer, twice`` for every distinct gram of each text, or of each buffer of a text that is cut; ``buffer`` is where that starts."""
        for batch in batches:
            keys = batch.column(1).to_numpy()
            for _, held, _, start, _, _, gram, text in found_stretches(_bytes_of(batch.column(0)), span):
                order = np.lexsort((text, gram))
                gram, text = gram[order], text[order]
                fresh = np.ones(len(gram), bool)
                fresh[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
                at = np.flatnonzero(fresh)
                twice = np.diff(np.append(at, len(gram))) > 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[at].view(np.int64)), pa.array(keys[np.array(held, np.int64)[text[at]]]), pa.array(np.full(len(at), start, np.int64)), pa.array(twice)],
                    ["gram", "d64", "buffer", "twice"],
                )

    return grams


def _stretches_to_compare(span: int):
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``gram, splits, ord, d64, start, count, body`` of stretches with a repeated gram.

        Of equal stretches of one buffer only the earliest carries its bytes; the others are repeats already.
        Those that touch each other become one row, which any shard can pass on.
        """
        for batch in batches:
            ords, keys = batch.column("ord").to_pylist(), batch.column("d64").to_pylist()
            listed = batch.column("grams")
            for data, held, bounds, start, first, count, gram, text in found_stretches(_bytes_of(batch.column("text")), span):
                some = pa.concat_arrays([listed[k].values for k in held if listed[k].values is not None])
                known, index = np.unique(some.field("gram").to_numpy().view(U64), return_index=True)
                splits = some.field("splits").to_numpy()[index]
                place = np.minimum(np.searchsorted(known, gram), len(known) - 1)
                hit = np.flatnonzero(known[place] == gram)
                raw = data.tobytes()
                rows: list[list] = []
                earliest: dict[bytes, int] = {}
                for f, c, g, s, t in zip(first[hit].tolist(), count[hit].tolist(), gram[hit].view(np.int64).tolist(), splits[place[hit]].tolist(), text[hit].tolist()):
                    body = raw[f : f + c + WINDOW - 1]
                    k = held[t]
                    row = [g, s, ords[k], keys[k], f - int(bounds[t]) + start, c, body]
                    seen = earliest.setdefault(body, len(rows))
                    if seen != len(rows):
                        if row[2:5] < rows[seen][2:5]:
                            rows[seen][6] = None
                            earliest[body] = len(rows)
                        elif row[2:5] > rows[seen][2:5]:
                            row[6] = None
                    rows.append(row)
                rows = [r for r in rows if r[6] is not None] + _joined_repeats([r for r in rows if r[6] is None])
                for k in range(0, len(rows), 10_000):
                    part = list(zip(*rows[k : k + 10_000]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(part, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()])],
                        ["gram", "splits", "ord", "d64", "start", "count", "body"],
                    )

    return compared


def _joined_repeats(rows: list[list]) -> list[list]:
    out: list[list] = []
    end = 0
    for _, _, order, key, start, count, _ in sorted(rows, key=lambda r: r[2:5]):
        if out and out[-1][2:4] == [order, key] and start <= end:
            end = max(end, start + count + WINDOW - 1)
            out[-1][5] = end - out[-1][4] - WINDOW + 1
        else:
            end = start + count + WINDOW - 1
            # No gram decides where it goes: repeats of a frequent one must not meet.
            out.append([hash((order, key, start)), 1, order, key, start, count, None])
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its marked bytes."""
    for batch in batches:
        out: list[tuple] = []
        for text, marks in zip(_bytes_of(batch.column("text")), batch.column("marks")):
            begin = np.sort(marks.values.field("start").to_numpy())
            end = np.maximum.accumulate(marks.values.field("end").to_numpy()[np.argsort(marks.values.field("start").to_numpy(), kind="stable")])
            new = np.ones(len(begin), bool)
            new[1:] = begin[1:] > end[:-1]
            heads = np.flatnonzero(new)
            begin, end = begin[heads], end[np.append(heads[1:], len(end)) - 1]
            kept = [text[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(text)])]
            out.append((int((end - begin).sum()), len(begin), hashlib.sha256(b"".join(kept)).hexdigest(), list(map(int, np.stack([begin, end], 1).reshape(-1)))))
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("ord"), batch.column("d64"), *(pa.array(x, t) for x, t in zip(columns, [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]))],
            ["ord", "d64", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` for every row of ``docs``.

    A byte of a text's UTF-8 form goes if a string of WINDOW bytes that covers it also starts earlier:
    in a document with a smaller id, or earlier in the same one. Strings are judged on the input.
    ``spans`` lists begin and end of each maximal removed run.

    Of equal texts the one with the smallest id is compared with the rest; the others go whole if they
    have WINDOW bytes. Null texts count as empty. Rows without an id count as later than all others.
    Rows of one id and equal texts count as one document; of one id and different texts, the order of
    the texts' hashes decides. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("ord"), text.alias("text"))
    base = base.withColumns({"d64": F.xxhash64("text"), "sha": F.sha2(F.col("text").cast("binary"), 256), "n_bytes": F.octet_length("text").cast("long")})
    firsts = settled(base.groupBy("sha").agg(F.min("ord").alias("first"), F.first("d64").alias("d64"), F.count(F.lit(1)).alias("n")), "texts")
    grams = settled(base.where(f"n_bytes >= {WINDOW}").select("text", "d64").mapInArrow(_grams(SPAN), "gram long, d64 long, buffer long, twice boolean"), "grams")
    # Copies of one text agree in text and buffer and count once; a text may also repeat a gram in another of its buffers.
    often = grams.groupBy("gram").agg(
        F.min("d64").alias("low"), F.max("d64").alias("high"), F.min("buffer").alias("begin"), F.max("buffer").alias("end"), F.max("twice").alias("twice"), F.count(F.lit(1)).alias("n")
    )
    often = settled(often.where("low < high or begin < end or twice").select("gram", "n", F.ceil(F.col("n") / HOT).cast("int").alias("splits")), "often")
    # A gram that very many texts hold meets its row in several tasks.
    met = spread_join(grams.select("gram", "d64"), often.select("gram", "splits"), "gram", "inner", row_id="d64", hot=hot_among(often, "gram"))
    listed = met.groupBy("d64").agg(F.collect_set(F.struct("gram", "splits")).alias("grams"))
    listed = settled(firsts.join(listed, "d64").select("d64", F.col("first").alias("ord"), "grams"), "listed")
    release(spark, grams, often)
    total, split = listed.agg(F.sum(F.size("grams")), F.max(F.array_max(F.transform("grams", lambda g: g["splits"])))).first()
    shards = max(1, -(-(total or 0) * (WINDOW + 34) // SHARD_BYTES))
    texts = base.select("ord", "d64", "text")
    compared = texts.join(listed, ["d64", "ord"]).select("ord", "d64", "text", "grams").mapInArrow(
        _stretches_to_compare(SPAN), "gram long, splits int, ord long, d64 long, start long, count long, body binary"
    )
    salt = F.pmod(F.xxhash64("ord"), F.col("splits"))
    shard: Column = F.pmod(F.xxhash64("gram", salt), F.lit(shards))
    sharded = settled(compared.withColumn("shard", shard).groupBy("shard").applyInArrow(_shard, _SHARD_ROWS), "shards")
    marks = sharded.where("body is null").select("ord", "d64", "start", "end")
    if (split or 1) > 1:
        first_windows = sharded.where("body is not null")
        buckets = max(1, -(-first_windows.count() // 50_000))
        dealt = first_windows.withColumn("bucket", F.pmod(F.xxhash64("body"), F.lit(buckets)))
        marks = marks.union(dealt.groupBy("bucket").applyInArrow(_merge, "ord long, d64 long, start long, end long"))
    per_text = marks.groupBy("ord", "d64").agg(F.collect_set(F.struct("start", "end")).alias("marks"))
    cut = texts.join(per_text, ["d64", "ord"])
    cut = cut.select("ord", "d64", "text", "marks").mapInArrow(_cut, "ord long, d64 long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
    cut = cut.dropDuplicates(["ord", "d64"])
    narrow = base.select("doc_id", "ord", "d64", "sha", "n_bytes")
    narrow = spread_join(narrow, firsts.select("sha", "first"), "sha", "inner", row_id="ord", hot=hot_among(firsts, "sha")).join(cut, ["ord", "d64"], "left")
    copy = (F.col("ord") > F.col("first")) & (F.col("n_bytes") >= WINDOW)
    empty = hashlib.sha256(b"").hexdigest()
    return narrow.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copy, F.array(F.lit(0).cast("long"), F.col("n_bytes"))).otherwise(F.coalesce("spans", F.array().cast("array<long>"))).alias("spans"),
    )
