"""Joins to a side that was grouped by the join's keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.functions.text import quoted


def key_names(keys: Sequence[str]) -> list[str]:
    """Names for the key columns of the grouped side, apart from any of the other side."""
    return [f"__key{number}" for number in range(len(keys))]


def join_to_grouped(left: DataFrame, grouped: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join a frame by its key columns to a frame with one row per key, named as ``key_names`` has it.

    A join would take over the partitioning the grouping left behind, and then a hot key of the left side
    could not be split. Matching the hash of the keys as well gives both sides a shuffle of their own, which
    adaptive execution splits where it is skewed. A grouped side that is small is still broadcast.
    """
    others = [F.col(name) for name in key_names(keys)]
    right = grouped.withColumn("__hash", F.xxhash64(*others))
    mine = [quoted(key) for key in keys]
    matches: list[Column] = [a == b for a, b in zip(mine, others)]
    joined = left.join(right, reduce(and_, [F.xxhash64(*mine) == F.col("__hash"), *matches]), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("__hash")
