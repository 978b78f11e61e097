"""Reading one layer: a folder or file of any format Spark reads, or a catalog table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from geoferry.functions.text import quoted


def is_path(target: str) -> bool:
    """Whether a target names a folder; otherwise it is a catalog table."""
    return "/" in target


def layer_read(
    spark: SparkSession,
    source: str,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    where: str | Column | None = None,
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """The layer, optionally only some columns and the rows that pass a filter.

    The filter may use columns that are not selected. Both reach the scan.
    """
    if is_path(source):
        reader = spark.read.format(fmt).options(**options)
        df = (reader.schema(schema) if schema is not None else reader).load(source)
    else:
        df = spark.table(source)
    if where is not None:
        df = df.where(where)
    return df if columns is None else df.select(*[quoted(name) for name in columns])
