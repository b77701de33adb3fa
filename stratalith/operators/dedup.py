"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalith.functions.columns import newest_first


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """Keep the first row of every key under ``order_by`` (plain names sort newest first).

    The caller passes a total order. Spark plans the rank filter as a group limit before
    the shuffle as well as after it: each map task sends one row per key, so a key that
    holds a third of the table reaches its reducer as one row per map task.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    order = [c if isinstance(c, Column) else newest_first(c)[0] for c in order_by]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*names).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
