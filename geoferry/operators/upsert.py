"""Keyed upserts without a catalog that can merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.functions.text import quoted
from geoferry.operators.joins import join_to_grouped, key_names


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str] | None = None
) -> DataFrame:
    """The target after a merge of the source.

    A target row whose key is in the source takes the source's ``update_columns`` (by default all but the
    keys) and keeps the rest. Source rows whose key is not in the target are added. Null keys match
    nothing. Two source rows for one target row raise when the result is computed.

    Both joins are to a side reduced to one row per key, and split a hot key of the other side.
    """
    others = [name for name in target.columns if name not in keys]
    updated = set(others if update_columns is None else update_columns)
    as_keys = [quoted(key).alias(name) for key, name in zip(keys, key_names(keys))]

    known = source.where(_all([quoted(key).isNotNull() for key in keys]))
    news = known.groupBy(*as_keys).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*[quoted(c) for c in others])).alias("__new")
    )
    one_each = F.when(F.coalesce(F.col("__n"), F.lit(1)) == 1, True).otherwise(
        F.raise_error("two or more source rows match one target row").cast("boolean")
    )

    def value(column: str) -> Column:
        if column not in updated:
            return quoted(column)
        return F.when(F.col("__n").isNotNull(), F.col("__new")[column]).otherwise(quoted(column)).alias(column)

    in_place = join_to_grouped(target, news, keys, "left").where(one_each).select(*[value(c) for c in target.columns])
    rows = source.select(*[quoted(c) for c in target.columns])
    added = join_to_grouped(rows, target.select(*as_keys).distinct(), keys, "left_anti")
    return in_place.unionByName(added)


def current_state(
    log: DataFrame,
    keys: Sequence[str],
    sequence: str,
    update_columns: Sequence[str] | None = None,
    null_is_a_key: bool = False,
) -> DataFrame:
    """The state of an append-only log, as if each row had been merged in sequence.

    Per key, ``update_columns`` (by default all) come from the last row and the others from the first.
    One aggregation, combined before its shuffle. Rows with a null key stand for themselves, as in a
    merge, unless null counts as a key.
    """
    columns = [name for name in log.columns if name != sequence]
    others = [name for name in columns if name not in keys]
    late = [name for name in others if update_columns is None or name in update_columns]
    early = [name for name in others if name not in late]

    def state(rows: DataFrame) -> DataFrame:
        picks = []
        if late:
            picks.append(F.max_by(F.struct(*[quoted(c) for c in late]), quoted(sequence)).alias("__late"))
        if early:
            picks.append(F.min_by(F.struct(*[quoted(c) for c in early]), quoted(sequence)).alias("__early"))
        found = rows.groupBy(*[quoted(k) for k in keys]).agg(*picks)
        source = {**{c: F.col("__late")[c] for c in late}, **{c: F.col("__early")[c] for c in early}}
        return found.select(*[source[c].alias(c) if c in source else quoted(c) for c in columns])

    if null_is_a_key:
        return state(log)
    has_key = _all([quoted(k).isNotNull() for k in keys])
    return state(log.where(has_key)).unionByName(log.where(~has_key).drop(sequence))
