"""Batches: all rows that share one value of a chosen column. Null is a value like any other."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.functions.text import quoted


def batch_keys(df: DataFrame, batch: str) -> DataFrame:
    """The distinct batch values, as a frame."""
    return df.select(quoted(batch)).distinct()


def batch_subset(df: DataFrame, batch: str, value: Any) -> DataFrame:
    """The rows of one batch; ``None`` selects the rows without a value."""
    return df.where(quoted(batch).eqNullSafe(F.lit(value)))


def batch_counts(df: DataFrame, batch: str | None, count: str = "n_rows", **more: Column) -> DataFrame:
    """Rows per batch, and further aggregates under their names. Without a batch column, one row for the whole frame
    (none for an empty one)."""
    wanted = [F.count(F.lit(1)).alias(count), *[value.alias(name) for name, value in more.items()]]
    if batch is None:
        return df.agg(*wanted).where(F.col(count) > 0)
    return df.groupBy(quoted(batch)).agg(*wanted)


def partition_key(batch: Column) -> Column:
    """Folder name for a batch value, distinct for null, the empty string and every other value.

    Plain short values stay readable. A value that is long, or holds anything else, goes by its md5.
    """
    text = batch.cast("string")
    return (
        F.when(text.isNull(), F.lit("none"))
        .when(text.rlike(r"^[A-Za-z0-9_.\-]{1,100}$"), F.concat(F.lit("v-"), text))
        .otherwise(F.concat(F.lit("h-"), F.md5(text)))
    )


def pending_batches(
    keys: DataFrame, log: DataFrame, batch: str, service: str, run_id: str | None = None, layer: str | None = None
) -> DataFrame:
    """The batches of ``keys`` that the log does not show as a success for the service, or for a layer of it.

    With a ``run_id`` only that run's entries count: what another run of the service wrote is not this one's.
    """
    log = log if run_id is None else log.where(F.col("run_id") == run_id)
    if layer is not None or "layer_name" in log.columns:
        log = log.where(F.col("layer_name").eqNullSafe(F.lit(layer)))
    done = (
        log.where((F.col("status") == "Success") & (F.col("target_svc_name") == service))
        .select(F.col("batch").alias("__done"))
        .distinct()
    )
    return keys.join(done, quoted(batch).cast("string").eqNullSafe(F.col("__done")), "left_anti")
