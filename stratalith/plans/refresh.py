"""The sales fact in a folder by year and month, of which only the months that a change touches are written again."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratalith.operators.joins import only_keys_of
from stratalith.plans.gold import FACT_PARTITIONS, fact_sales
from stratalith.sources.files import overwrite_partitions, partition_path, remove


@dataclass(frozen=True)
class Refreshed:
    """The months that were written again, and those that have no rows any more; as ``(year, month)``."""

    written: list[tuple[int | None, int | None]]
    emptied: list[tuple[int | None, int | None]]


def _month(year: Column, month: Column) -> Column:
    """One number per month; rows without a date have one of their own."""
    return F.coalesce(year * 12 + month - 1, F.lit(-1))


def _pair(number: int) -> tuple[int | None, int | None]:
    return (None, None) if number == -1 else (number // 12, number % 12 + 1)


def read_fact(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored fact with the columns and types of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def write_fact(fact: DataFrame, path: str, observe: Mapping[str, Column] | None = None) -> dict:
    """Write all months, whatever is there before; gives the ``observe`` aggregates."""
    remove(fact.sparkSession, path)
    return overwrite_partitions(fact, path, FACT_PARTITIONS, observe)


def months_of(rows: DataFrame, ts: str = "order_date") -> list[int]:
    """The months in which rows lie. At most one number per month comes back."""
    found = rows.select(_month(F.year(ts), F.month(ts)).alias("month")).distinct().collect()
    return sorted(r["month"] for r in found)


def in_months(rows: DataFrame, months: Sequence[int], ts: str = "order_date") -> DataFrame:
    return rows.filter(_month(F.year(ts), F.month(ts)).isin(list(months)))


def replace_months(fact: DataFrame, path: str, months: Sequence[int], observe: Mapping[str, Column] | None = None) -> tuple[Refreshed, dict]:
    """Put the rows of ``fact``, which must be all rows of these months, in the place of the stored ones.

    Months are replaced when the job commits. One that has no rows any more is removed after that; what is left of it until then
    still tells that it is touched, so a refresh that was cut off is repeated.
    """
    observe = {} if observe is None else dict(observe)
    observe["months"] = F.collect_set(_month(F.col("order_year"), F.col("order_month")))
    seen = overwrite_partitions(fact, path, FACT_PARTITIONS, observe)
    written = sorted(seen["months"])
    emptied = [_pair(m) for m in months if m not in set(written)]
    for pair in emptied:
        remove(fact.sparkSession, partition_path(path, dict(zip(FACT_PARTITIONS, pair))))
    return Refreshed([_pair(m) for m in written], emptied), seen


def refresh_fact(path: str, fact: DataFrame, orders: DataFrame, changed: DataFrame, enrich: Callable[[DataFrame], DataFrame]) -> Refreshed:
    """Bring the stored ``fact`` at ``path`` up to date with the ``orders`` as they are now.

    ``changed`` has the ids of orders that were added, changed or taken away since the fact was written: the months in which they are stored
    and those they belong to now are written again. ``enrich`` makes the enriched sales of some orders; it gets those of
    these months only, all of them, since a month is replaced as a whole. Other months' files stay the same files.
    """
    ids = changed.select("order_id").distinct()
    months = sorted({*months_of(only_keys_of(fact, ids, "order_id")), *months_of(only_keys_of(orders, ids, "order_id"))})
    if not months:
        return Refreshed([], [])
    return replace_months(fact_sales(enrich(in_months(orders, months))).select(*fact.columns), path, months)[0]
