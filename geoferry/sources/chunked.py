"""Writing a frame in chunks of bounded size: one folder per batch and chunk."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoferry.fixed_values import MAX_CHUNK_ROWS
from geoferry.functions.text import quoted
from geoferry.operators.batches import partition_key
from geoferry.operators.chunks import ROWS_PER_RANGE, ROWS_PER_TASK, chunk_rows_of
from geoferry.workspace import replace_folder

BATCH_KEY, CHUNK = "batch_key", "chunk"
#: Files that one task writes where chunks are dealt to tasks.
CHUNKS_PER_TASK = 32


class WriteState(NamedTuple):
    """What the next call has to know."""

    written: bool
    is_first_batch: bool
    write_mode: str


def check_names(df: DataFrame, reserved: Sequence[str]) -> None:
    taken = {name.lower() for name in df.columns} & set(reserved)
    if taken:
        raise ValueError(f"rename the columns {sorted(taken)}: the layout needs these names")


def chunk_count(n_rows: Column, chunk_rows: int) -> Column:
    """How many chunks batches of these rows have together."""
    return F.coalesce(F.sum(F.ceil(n_rows / F.lit(chunk_rows))), F.lit(0))


def spread_chunks(df: DataFrame, parallelism: int | None, n_chunks: int, n_rows: int, order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Bring each chunk to one of a number of writing tasks. A chunk is of bounded size, whatever its batch.

    Each chunk is a file, and making one takes longer than its rows do. Unless told how many tasks there shall be, many
    chunks are dealt to as many as that takes: where they are numbered, a task has all chunks of a batch.
    """
    if parallelism is not None:
        return df.repartition(parallelism, BATCH_KEY, CHUNK)
    if n_chunks <= CHUNKS_PER_TASK:
        return df
    n = max(math.ceil(n_chunks / CHUNKS_PER_TASK), math.ceil(n_rows / ROWS_PER_RANGE))
    order = [quoted(name) if isinstance(name, str) else name for name in order_by]
    return df.repartition(n, BATCH_KEY, CHUNK).sortWithinPartitions(BATCH_KEY, CHUNK, *order)


def chunked_write(
    df: DataFrame,
    target: str,
    chunk_rows: int = MAX_CHUNK_ROWS,
    batch: str | None = None,
    order_by: Sequence[str | Column] = (),
    write_mode: str = "overwrite",
    is_first_batch: bool = True,
    parallelism: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> WriteState:
    """Write the frame to a folder, in chunks of at most ``chunk_rows`` rows, as one job.

    The first write takes the caller's mode, later ones append: pass the state of one call on to the next.
    An overwrite takes the place of the old folder only once it is written whole. An empty frame writes
    nothing and leaves the state as it was. Without ``parallelism`` a few chunks are
    written where they are numbered: a chunk then has one file, or a few where it crosses a range.
    """
    if write_mode not in ("overwrite", "append"):
        raise ValueError("the write mode is overwrite or append")
    check_names(df, [BATCH_KEY, CHUNK])
    chunked = chunk_rows_of(df, chunk_rows, batch, order_by, CHUNK, rows_per_task)
    try:
        if chunked.total_rows == 0:
            return WriteState(True, is_first_batch, write_mode)
        key = partition_key(quoted(batch)) if batch else F.lit("all")
        n_chunks = chunked.counts.agg(chunk_count(F.col("n_rows"), chunk_rows)).first()[0]
        rows = spread_chunks(chunked.frame.withColumn(BATCH_KEY, key), parallelism, n_chunks, chunked.total_rows, order_by)
        writer = rows.write.mode("append").partitionBy(BATCH_KEY, CHUNK)
        if is_first_batch and write_mode == "overwrite":
            replace_folder(df.sparkSession, target, writer.parquet)
        else:
            writer.parquet(target)
        return WriteState(True, False, "append")
    finally:
        chunked.release()


def read_chunked(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The rows written, with ``batch_key`` and ``chunk``. Types come from the schema, not from folder names."""
    layout = T.StructType([*schema.fields, T.StructField(BATCH_KEY, T.StringType()), T.StructField(CHUNK, T.IntegerType())])
    return spark.read.schema(layout).parquet(target)
