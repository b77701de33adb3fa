"""Rewriting a table so that filters on any of several columns skip files."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalith.operators.joins import partitions_of

BITS = 6
# Cut points are this exact: each lies within one part in so many of its place.
EXACT = 10_000
# Bytes of a text that are compared with cut points.
PREFIX = 7


def placing(df: DataFrame, column: str) -> Column:
    """A number that rises with the column: times as microseconds, texts by their first bytes, booleans as 0 and 1."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        first = F.rpad(F.substring(c.cast("binary"), 1, PREFIX), F.lit(PREFIX), F.lit(b"\0"))
        return F.conv(F.hex(first), 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    return c.cast("int") if isinstance(kind, T.BooleanType) else c


def cut_points(df: DataFrame, cols: Sequence[str], bits: int = BITS, exact: int = EXACT) -> dict[str, list[Any]]:
    """Up to ``2**bits - 1`` ascending numbers per column that split its rows into equal shares, on the scale of :func:`placing`.

    They come from mergeable quantile sketches of all columns, in one pass over just these: every task sends a sketch and the driver gets
    the cut points, however many rows there are. They place rows in files and decide nothing else.
    """
    shares = F.array(*[F.lit(k / 2**bits) for k in range(1, 2**bits)])
    found = df.agg(*[F.percentile_approx(placing(df, c), shares, exact).alias(c) for c in cols]).first()
    return {c: sorted(set(found[c] or [])) for c in cols}


def with_buckets(df: DataFrame, cuts: dict[str, Sequence[Any]], bits: int = BITS) -> tuple[DataFrame, list[str]]:
    """Add, per column, how many cut points are at or below its value; NULL goes first.

    A binary search with one projection per halving, for all columns together. Each step
    looks one element up in a constant array, so the generated code stays small.
    """
    points = {c: F.lit(list(v)) if v else None for c, v in cuts.items()}
    names, places = {c: f"_bucket_{i}" for i, c in enumerate(cuts)}, {c: f"_place_{i}" for i, c in enumerate(cuts)}
    df = df.withColumns({**{n: F.lit(0) for n in names.values()}, **{places[c]: placing(df, c) for c in cuts}})
    for step in (1 << k for k in reversed(range(bits))):
        # A look-up behind the last cut point gives NULL, which counts as not reached.
        df = df.withColumns({
            n: F.col(n) + F.when(F.col(places[c]) >= F.get(points[c], F.col(n) + (step - 1)), step).otherwise(0)
            for c, n in names.items() if points[c] is not None
        })
    return df.drop(*places.values()), list(names.values())


def z_address(buckets: Sequence[Column], bits: int = BITS) -> Column:
    """Interleave the bits of the buckets, most significant first (Morton order)."""
    width = len(buckets)
    address = F.lit(0).cast("long")
    for bit in range(bits):
        for i, b in enumerate(buckets):
            one = F.shiftright(b, bit).bitwiseAND(F.lit(1)).cast("long")
            address = address.bitwiseOR(F.shiftleft(one, bit * width + (width - 1 - i)))
    return address


def cluster_by(
    df: DataFrame,
    cols: Sequence[str],
    *,
    within: Sequence[str] = (),
    bits: int | None = None,
    cuts: dict[str, list[Any]] | None = None,
    files: int | None = None,
) -> DataFrame:
    """The same rows, range-partitioned and sorted along a Z-curve over ``cols``.

    There are as many partitions as ``files``. By default there are as many as the session shuffles into, of which adaptive execution
    joins small ones up to its advisory size. The curve has several cells for each.

    ``within`` columns come first, for tables stored in partitions. The raw columns refine
    the order inside a Z-cell and the task number splits rows that agree on everything, so
    a value that holds a third of the table is spread over many files. The task number is
    the same when a lost task is run again, unlike a random or running number.
    """
    parts = partitions_of(df) if files is None else files
    bits = max(BITS, math.ceil(math.log2(parts) / len(cols)) + 2) if bits is None else bits
    if len(cols) == 1:
        keyed, curve = df, []
    else:
        cuts = cuts or cut_points(df, cols, bits)
        searched, buckets = with_buckets(df, {c: cuts[c] for c in cols}, bits)
        keyed = searched.withColumn("_z", z_address([F.col(n) for n in buckets], bits)).drop(*buckets)
        curve = ["_z"]
    keyed = keyed.withColumn("_task", F.spark_partition_id())
    order = [*within, *curve, *cols]
    dealt = keyed.repartitionByRange(*([files] if files else []), *order, "_task")
    return dealt.sortWithinPartitions(*order).drop("_z", "_task")


def by_partition(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bring the rows of each partition value together before a partitioned write.

    A plain repartition gives each value one task, however large. The rebalance lets
    adaptive execution split large values into several files and join small ones.
    """
    return df.hint("rebalance", *cols)
