"""Column expressions shared by the operators; all stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Money is summed as an exact decimal: the result does not depend on the order in which
# partial sums meet. It is turned back into a double once, at the end.
MONEY = "decimal(24,6)"


def trimmed(c: Column) -> Column:
    return F.trim(c)


def title_case(c: Column) -> Column:
    return F.initcap(F.trim(c))


def code(c: Column) -> Column:
    return F.upper(F.trim(c))


def typed(kind: str) -> Callable[[Column], Column]:
    """A cast that gives NULL, not an error, for text that does not fit."""
    return lambda c: c.try_cast(kind)


# What a rule name in a TableSpec does to its column. Timestamps have their own step.
RULES: dict[str, Callable[[Column], Column]] = {
    "long": typed("long"),
    "int": typed("int"),
    "double": typed("double"),
    "trim": trimmed,
    "title": title_case,
    "upper": code,
}


# Rules that give NULL for text that does not fit.
TYPED = ("long", "int", "double")


def money_sum(amount: str | Column) -> Column:
    """Exact sum, as decimal."""
    c = F.col(amount) if isinstance(amount, str) else amount
    return F.sum(c.cast(MONEY))


def money_total(amount: str | Column) -> Column:
    """Exact sum rounded to cents, as double."""
    return F.round(money_sum(amount), 2).cast("double")


def average_per(amount: str | Column, key: str) -> Column:
    """Total of ``amount`` over the distinct values of ``key``, two decimals."""
    return F.round(money_sum(amount).cast("double") / F.count_distinct(F.col(key)), 2)


def newest_first(*cols: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols]


def date_parts(ts: str) -> dict[str, Column]:
    c = F.col(ts)
    return {
        "order_date_only": F.to_date(c),
        "order_year": F.year(c),
        "order_month": F.month(c),
        "order_day": F.dayofmonth(c),
    }


def mark_micros(c: str | Column) -> Column:
    """A timestamp as microseconds since 1970, the form in which marks leave Spark."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def mark_literal(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))
