"""Exact distinct counts that can be merged.

The distinct values of an integer key in a group are kept as bitmaps, one for each stretch of 32,768 values that
holds any. Bitmaps of several groups are combined with a bitwise or, so the counts of a month follow from those
of its days, which a number per day cannot give. A row is ``(group columns..., counted, bucket, members, amount)``: for every
key a row per bucket with its members, and for every sum one without.

The bitmaps are built where the rows are: only they are shuffled, never the keys, and no row is repeated
per key as a plain query with several distinct counts does. A bitmap has 4 KB whatever it holds; nearly empty ones shrink to
little in compressed files and shuffles, and are fewest if keys that occur together are near each other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratalith.functions.columns import MONEY

COUNTED, BUCKET, MEMBERS, AMOUNT = "counted", "bucket", "members", "amount"
PARTS = (COUNTED, BUCKET, MEMBERS, AMOUNT)


def _free(by: Sequence[str]) -> list[str]:
    if taken := set(by) & set(PARTS):
        raise ValueError(f"group columns may not be named {sorted(taken)}")
    return list(by)


def key_sets(df: DataFrame, by: Sequence[str], keys: Mapping[str, str]) -> DataFrame:
    """``(by..., counted, bucket, members)`` of each key; ``keys`` maps what is counted to its integer column.

    NULL keys are in no set. Negative keys and zero are values like any other.
    """
    by, out = _free(by), None
    for name, column in keys.items():
        key = F.col(column).cast("long")
        sets = df.filter(key.isNotNull()).groupBy(*by, F.bitmap_bucket_number(key).alias(BUCKET)).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(MEMBERS)
        )
        part = sets.select(*by, F.lit(name).alias(COUNTED), BUCKET, MEMBERS)
        out = part if out is None else out.unionByName(part)
    return out


def group_parts(df: DataFrame, by: Sequence[str], keys: Mapping[str, str], sums: Mapping[str, Column]) -> DataFrame:
    """The sets of :func:`key_sets` and the exact sum of each of ``sums``, in one table that can be stored and merged.

    Every group has a row for each sum, also if all its keys are NULL.
    """
    sets = key_sets(df, by, keys).withColumn(AMOUNT, F.lit(None).cast(MONEY))
    totals = df.groupBy(*by).agg(*[F.sum(c.cast(MONEY)).cast(MONEY).alias(name) for name, c in sums.items()])
    for name in sums:
        part = totals.select(
            *by, F.lit(name).alias(COUNTED), F.lit(None).cast("long").alias(BUCKET), F.lit(None).cast("binary").alias(MEMBERS), F.col(name).alias(AMOUNT)
        )
        sets = sets.unionByName(part)
    return sets


def merged(parts: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    """The parts of coarser groups, or of several deliveries of parts; ``by`` gives the group columns over the old ones."""
    names = _free(list(by))
    regrouped = parts.select(*[c.alias(n) for n, c in by.items()], *PARTS)
    return regrouped.groupBy(*names, COUNTED, BUCKET).agg(
        F.when(F.count(MEMBERS) > 0, F.bitmap_or_agg(MEMBERS)).alias(MEMBERS), F.sum(AMOUNT).cast(MONEY).alias(AMOUNT)
    )


def totals(parts: DataFrame, by: Sequence[str], sums: Mapping[str, str], counts: Mapping[str, str]) -> DataFrame:
    """One row per group: the sums, rounded to cents, and the distinct counts; the mappings give what each column shows.

    The parts must hold a set of a group once: those of :func:`group_parts`, or :func:`merged` ones.
    """
    shown = {name: F.round(F.sum(F.when(F.col(COUNTED) == what, F.col(AMOUNT))), 2).cast("double") for name, what in sums.items()}
    shown |= {name: F.coalesce(F.sum(F.when(F.col(COUNTED) == what, F.bitmap_count(MEMBERS))), F.lit(0)) for name, what in counts.items()}
    return parts.groupBy(*_free(by)).agg(*[c.alias(name) for name, c in shown.items()])
