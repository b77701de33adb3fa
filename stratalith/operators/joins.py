"""Equi-joins that are safe against hot and missing keys."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot from this part of an even partition on; the sketch tracks no more values than this.
HOT_PART, MOST_TRACKED = 0.5, 10_000


def partitions_of(df: DataFrame) -> int:
    """Partitions of a shuffle in this session: what a share of the rows is measured against."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, cols: Sequence[str], share: float | None = None) -> dict[str, list[Any]]:
    """Values that hold more than ``share`` of the rows, per column.

    By default that is half of what a shuffle partition should hold, so it falls as the number of
    partitions grows with the data.

    One pass with a mergeable heavy-hitter sketch: keys are not shuffled, and at most
    ``1 / share`` values per column come back whatever the size of the table. The lists
    only steer the spread of :func:`spread_join`; its result is the same for any list.
    """
    share = max(1 / MOST_TRACKED, min(0.5, HOT_PART / partitions_of(df)) if share is None else share)
    most = int(1 / share)
    tracked = most * 40
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"approx_top_k(`{c}`, {most}, {tracked})").alias(c) for c in cols],
    ).first()
    floor = row["n"] * share
    return {c: [e["item"] for e in row[c] or [] if e["item"] is not None and e["count"] > floor] for c in cols}


def names_of(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def any_null(names: Sequence[str]) -> Column:
    test = F.lit(False)
    for k in names:
        test = test | F.col(k).isNull()
    return test


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    how: str,
    *,
    row_id: str | None = None,
    hot: Sequence[Any] = (),
) -> DataFrame:
    """Inner, left, semi or anti equi-join in which no key gathers its left rows in one task.

    There are as many salts as shuffle partitions.

    Left rows with a NULL key match nothing, yet a plain outer or anti join sends them all
    to one task; here they are spread by ``row_id`` (or by all their columns). The same is
    done to the rows of the ``hot`` values of a single key, whose right rows are repeated
    once per salt. Nothing is dropped, and Spark is still free to broadcast the right side
    when its measured size allows.
    """
    names = names_of(keys)
    if how in ("inner", "left_semi") and not hot:
        return left.join(right, names, how)  # Spark filters the NULL keys away by itself
    by = [row_id] if row_id else left.columns
    salts = partitions_of(left)
    spread = F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")
    is_hot = F.col(names[0]).isin(list(hot)) if hot else F.lit(False)
    salted = left.withColumn("_salt", F.when(any_null(names) | is_hot, spread).otherwise(F.lit(0)))
    # Always 0, but not a constant to the optimizer, which would take the salt out of the
    # shuffle keys again.
    zero = F.pmod(F.xxhash64(*names), F.lit(1)).cast("int")
    if hot:
        copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(zero))
        right = right.withColumn("_salt", F.explode(copies))
    else:
        right = right.withColumn("_salt", zero)
    return salted.join(right, [*names, "_salt"], how).drop("_salt")


def only_keys_of(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``keys``, each once."""
    return df.join(keys.select(key), key, "left_semi")
