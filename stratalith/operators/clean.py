"""Rule-driven cleaning. Types first, then the key test, so a key that does not parse is a
reject and not a NULL that slips through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalith.functions.columns import RULES, TYPED
from stratalith.spec import TableSpec


def parse_timestamps(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Give every listed column that exists a timestamp type in one projection.

    Text that is no timestamp becomes NULL. Columns that already are timestamps, with or
    without a zone, keep their type.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parsed: dict[str, Column] = {}
    for c in cols:
        kind = types.get(c)
        if isinstance(kind, T.StringType):
            parsed[c] = F.try_to_timestamp(F.col(c))
        elif kind is not None and not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            parsed[c] = F.col(c).cast("timestamp")
    return df.withColumns(parsed) if parsed else df


def unreadable(raw: DataFrame, cols: Sequence[str]) -> Column:
    """The text of every listed column that is no timestamp, as ``column=text``; NULL where all can be read."""
    text = [c for c in cols if isinstance(raw.schema[c].dataType, T.StringType)]
    lost = [F.when(F.try_to_timestamp(F.col(c)).isNull(), F.concat(F.lit(f"{c}="), F.col(c))) for c in text]
    return F.nullif(F.concat_ws("; ", *lost), F.lit(""))


def _ruled(df: DataFrame, spec: TableSpec | None) -> DataFrame:
    if spec is None:
        return df
    present = set(df.columns)
    return df.withColumns(
        {c: RULES[rule](F.col(c)) for c, rule in spec.columns.items() if rule in RULES and c in present}
    )


def clean(df: DataFrame, spec: TableSpec | None) -> DataFrame:
    """Apply the rules of ``spec`` and keep the rows with a usable key.

    ``None`` (a table nobody described) passes through unchanged.
    """
    if spec is None:
        return df
    ruled = _ruled(parse_timestamps(df, spec.timestamp_cols), spec)
    return ruled.filter(F.col(spec.key).isNotNull())


def cast_failures(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``column_name, failed``: how many values of each column are no value of its type, in one pass."""
    typed = parse_timestamps(df.select([F.col(c).alias(f"raw {c}") for c in df.columns] + df.columns), spec.timestamp_cols)
    typed = _ruled(typed, spec)
    checked = [c for c, rule in spec.columns.items() if c in df.columns and rule in (*TYPED, "timestamp")]
    lost = {c: F.count_if(F.col(f"raw {c}").isNotNull() & F.col(c).isNull()) for c in checked}
    rows = typed.agg(*[n.alias(c) for c, n in lost.items()])
    told = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failed")) for c in checked]))
    return rows.select(told.alias("told")).select("told.*")


def reject_reason(spec: TableSpec) -> Column:
    """Why a raw row has no usable key; NULL when it has one."""
    raw, typed_key = F.col(spec.key), RULES[spec.columns[spec.key]](F.col(spec.key))
    return F.when(raw.isNull(), F.lit("missing key")).when(typed_key.isNull(), F.lit("unreadable key"))


def rejects(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The raw rows that :func:`clean` leaves out, untouched, with the reason."""
    return df.withColumn("reject_reason", reject_reason(spec)).filter(F.col("reject_reason").isNotNull())
