"""The rows of the two logs, always with an explicit schema."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoferry.fixed_values import BATCH_STATUSES, INGEST_LOG_COLUMNS, MICROS_FORMAT
from geoferry.functions.text import attempt_id


def _value(value: Any, data_type: str) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(data_type)


def ingest_log_rows(
    layers: DataFrame,
    load_id: str,
    status: str | Column,
    error_message: str | Column | None = None,
    moment: Column | None = None,
) -> DataFrame:
    """Ingest log rows for the layers (``item_id, sublayer_id, layer_url, layer_name, target_path, started``).

    ``started`` names the attempt; ``moment`` is the time of the entry, by default the start.
    """
    started = F.col("started")
    rows = layers.select(
        F.lit(load_id).alias("load_id"),
        attempt_id(F.col("target_path"), started).alias("layer_attempt_id"),
        "item_id",
        "sublayer_id",
        "layer_url",
        "layer_name",
        "target_path",
        F.date_format(started if moment is None else moment, MICROS_FORMAT).alias("timestamp"),
        _value(status, "string").alias("status"),
        _value(error_message, "string").alias("error_message"),
    )
    return rows.select(*[F.col(name).cast("string").alias(name) for name in INGEST_LOG_COLUMNS])


def batch_log_rows(
    batches: DataFrame,
    batch: Column,
    target_svc_name: str | Column,
    batch_by_column: str | Column,
    status: str | Column,
    message: str | Column | None = None,
    target_server_url: str | Column | None = None,
    layer_id: str | Column | None = None,
    write_mode: str | Column = "overwrite",
    user: str | Column | None = None,
    load_timestamp: Column | None = None,
    retry_attempts: int | Column = 1,
) -> DataFrame:
    """Batch log rows, one per row of ``batches``. An unknown status raises; an empty message is filled in."""
    given = F.nullif(_value(message, "string"), F.lit(""))
    state = F.col("status")
    known = F.when(state.isin(BATCH_STATUSES), True).otherwise(
        F.raise_error(F.concat(F.lit("unknown batch status: "), F.coalesce(state, F.lit("null")))).cast("boolean")
    )
    moment = F.current_timestamp() if load_timestamp is None else load_timestamp
    rows = batches.select(
        batch.cast("string").alias("batch"),
        _value(target_svc_name, "string").alias("target_svc_name"),
        _value(target_server_url, "string").alias("target_server_url"),
        _value(batch_by_column, "string").alias("batch_by_column"),
        _value(layer_id, "string").alias("layer_id"),
        _value(write_mode, "string").alias("write_mode"),
        _value(user, "string").alias("user"),
        moment.cast("timestamp").alias("load_timestamp"),
        _value(status, "string").alias("status"),
        given.alias("message"),
        _value(retry_attempts, "bigint").alias("retry_attempts"),
    )
    default = F.when(state == "Success", "Complete").otherwise("Unknown error")
    return rows.where(known).withColumn("message", F.coalesce(F.col("message"), default))
