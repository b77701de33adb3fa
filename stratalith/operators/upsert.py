"""Merges as joins: ``(target, source) -> new target``.

A source may hold a key once; with ``check=True`` a repeated source key fails the job, as
it does in a MERGE. NULL keys match nothing, so such rows of both sides are kept. Cleaning
makes keys non-NULL; where many may be NULL, ``null_keys=True`` spreads them over the tasks,
which costs a shuffle of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalith.operators.joins import any_null, names_of, partitions_of, spread_join


def source_keys(source: DataFrame, keys: str | Sequence[str], check: bool) -> DataFrame:
    """The keys a merge matches on; counted and tested in the same pass when asked."""
    names = names_of(keys)
    if not check:
        return source.select(*names)
    told = F.concat(F.lit("merge source repeats key "), F.to_json(F.struct(*names)))
    known = source.dropna(subset=names).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    return known.filter(F.when(F.col("_n") > 1, F.raise_error(told).cast("boolean")).otherwise(True)).select(*names)


def _join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str, null_keys: bool) -> DataFrame:
    return spread_join(left, right, names, how) if null_keys else left.join(right, list(names), how)


def insert_missing(target: DataFrame, source: DataFrame, keys: str | Sequence[str], *, null_keys: bool = False) -> DataFrame:
    """Add the source rows whose key the target lacks; existing rows stay as they are."""
    names = names_of(keys)
    return target.unionByName(_unmatched(source, target, names, null_keys))


def _unmatched(source: DataFrame, target: DataFrame, names: Sequence[str], null_keys: bool) -> DataFrame:
    """Source rows whose key the target lacks.

    The target keys are first reduced to those of the source, so a small source never
    makes the target move.
    """
    common = target.select(*names).join(source.select(*names), names, "left_semi")
    return _join(source, common, names, "left_anti", null_keys)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    *,
    only_if_newer: str | None = None,
    check: bool = False,
    null_keys: bool = False,
) -> DataFrame:
    """Replace matched rows and add the rest; the batch wins.

    The target is filtered with an anti join: a batch whose keys fit in a broadcast leaves
    the target unshuffled. With ``only_if_newer`` a matched row is replaced only by one
    with a greater value in that column (a NULL counts as oldest): the target meets the keys
    and clocks of the batch, the batch those of the target rows that it names.

    The test of ``check`` sits on the rows of the batch that are returned, so it is made
    whatever the target holds.
    """
    names = names_of(keys)
    incoming = _checked(source, names) if check else source
    if only_if_newer is None:
        return _join(target, source.select(*names), names, "left_anti", null_keys).unionByName(incoming)

    clock = F.col(only_if_newer)
    offered = source.select(*names, clock.alias("_offered"), F.lit(True).alias("_named"))
    wins = F.col("_named").isNotNull() & F.col("_offered").isNotNull() & (clock.isNull() | (F.col("_offered") > clock))
    kept = _join(target, offered, names, "left", null_keys).filter(~wins).select(*target.columns)
    # Only target rows that the batch names are looked at, so a small batch moves little.
    held = target.join(source.select(*names), names, "left_semi").select(*names, clock.alias("_held"), F.lit(True).alias("_named"))
    loses = F.col("_named").isNotNull() & ~(clock.isNotNull() & (F.col("_held").isNull() | (clock > F.col("_held"))))
    new = _join(incoming, held, names, "left", null_keys).filter(~loses).select(*target.columns)
    return kept.unionByName(new)


def _checked(source: DataFrame, names: Sequence[str]) -> DataFrame:
    """The source, dealt by key once; a key that it repeats fails the job."""
    others = [c for c in source.columns if c not in names]
    told = F.concat(F.lit("merge source repeats key "), F.to_json(F.struct(*names)))
    known = source.dropna(subset=list(names)).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*others)).alias("_row") if others else F.lit(0).alias("_row"))
    once = known.filter(F.when(F.col("_n") > 1, F.raise_error(told).cast("boolean")).otherwise(True))
    kept = once.select(*[F.col(c) if c in names else F.col(f"_row.`{c}`").alias(c) for c in source.columns])
    return kept.unionByName(source.filter(any_null(names)))


def merge_columns(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    *,
    update: Mapping[str, str | Column],
    insert: Mapping[str, str | Column] | None = None,
    check: bool = False,
    similar_size: bool = False,
    null_keys: bool = False,
) -> DataFrame:
    """Merge that sets only the ``update`` columns of matched rows.

    Values are source column names or expressions over ``s.<column>`` and ``t.<column>``.
    Unmatched source rows get the ``insert`` columns (all of them when ``None``), the rest
    NULL; an empty mapping adds none. A match is told by a flag, not by ``coalesce``: a
    NULL in the source overwrites.

    A small batch can be broadcast and leaves the target unshuffled. When both sides are of
    ``similar_size`` one full outer join does the work: each side is read and moved once.
    """
    names = names_of(keys)
    if insert is None:
        insert = {c: c for c in source.columns}
    if check:
        source = _checked(source, names)

    def value(v: str | Column) -> Column:
        return F.col(f"s.{v}") if isinstance(v, str) else v

    types = {f.name: f.dataType for f in target.schema.fields}
    if similar_size:
        return _merge_outer(target, source, names, types, {c: value(v) for c, v in update.items()},
                            {c: value(v) for c, v in insert.items()})
    left, right = target.alias("t"), source.withColumn("_matched", F.lit(True)).alias("s")
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    kept = _join(left, right, names, "left", null_keys).select(*[
        (F.when(matched, value(update[c])).otherwise(F.col(f"t.{c}")) if c in update else F.col(f"t.{c}"))
        .cast(kind).alias(c)
        for c, kind in types.items()
    ])
    if not insert:
        return kept
    new = _unmatched(source, target, names, null_keys).alias("s").select(*[
        (value(insert[c]) if c in insert else F.lit(None)).cast(kind).alias(c) for c, kind in types.items()
    ])
    return kept.unionByName(new)


def _merge_outer(
    target: DataFrame,
    source: DataFrame,
    names: Sequence[str],
    types: Mapping[str, T.DataType],
    update: Mapping[str, Column],
    insert: Mapping[str, Column],
) -> DataFrame:
    def salted(df: DataFrame, flag: str) -> DataFrame:
        # Rows without a key match nothing and must not meet in one task.
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(partitions_of(df))).cast("int")
        return df.withColumns({flag: F.lit(True), "_salt": F.when(any_null(names), spread).otherwise(F.lit(0))})

    t, s = salted(target, "_old").alias("t"), salted(source, "_new").alias("s")
    on = F.col("t._salt") == F.col("s._salt")
    for k in names:
        on = on & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    matched, added = F.col("_old") & F.col("_new"), F.col("_old").isNull()
    out = []
    for c, kind in types.items():
        kept = F.col(f"t.{c}")
        new = insert.get(c, F.lit(None))
        out.append(F.when(matched, update.get(c, kept)).when(added, new).otherwise(kept).cast(kind).alias(c))
    return t.join(s, on, "full_outer" if insert else "left").select(*out)


def update_where(df: DataFrame, predicate: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set ``values`` where ``predicate`` is true; false and NULL leave the row alone."""
    return df.withColumns({c: F.when(predicate, v).otherwise(F.col(c)) for c, v in values.items()})
