"""Writing whole tables. A target is a catalog table, or a folder if its name holds a slash."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoferry.functions.text import quoted
from geoferry.sources.layers import is_path
from geoferry.workspace import folder_exists, replace_folder


def existing_schema(spark: SparkSession, target: str, fmt: str = "parquet") -> T.StructType | None:
    """Schema of the target, None if there is nothing yet."""
    if not is_path(target):
        return spark.table(target).schema if spark.catalog.tableExists(target) else None
    if not folder_exists(spark, target):
        return None
    try:
        return spark.read.format(fmt).load(target).schema
    except AnalysisException as error:
        # A folder without any file yet.
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def _replace_table(df: DataFrame, target: str, fmt: str) -> None:
    """Write a new catalog table beside the old one and swap their names; the old one is dropped last."""
    spark, schema = df.sparkSession, target.rpartition(".")[0]

    def sql_name(table: str) -> str:
        return ".".join(f"`{part}`" for part in table.split("."))

    new, old = (f"{schema}.{kind}_{uuid.uuid4().hex}".lstrip(".") for kind in ("new", "old"))
    try:
        df.write.format(fmt).saveAsTable(new)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {sql_name(new)}")
        raise
    spark.sql(f"ALTER TABLE {sql_name(target)} RENAME TO {sql_name(old)}")
    try:
        spark.sql(f"ALTER TABLE {sql_name(new)} RENAME TO {sql_name(target)}")
    except Exception:
        spark.sql(f"ALTER TABLE {sql_name(old)} RENAME TO {sql_name(target)}")
        raise
    spark.sql(f"DROP TABLE {sql_name(old)}")


def _aligned(value: Column, own: T.DataType, old: T.DataType, name: str) -> Column:
    """The value under the union of an old type and its own: structs gain the fields they lack, at any depth."""
    if own.simpleString() == old.simpleString():
        return value
    if isinstance(own, T.StructType) and isinstance(old, T.StructType):
        mine = {field.name.lower(): field for field in own.fields}
        fields = []
        for field in old.fields:
            match = mine.pop(field.name.lower(), None)
            part = F.lit(None).cast(field.dataType) if match is None else _aligned(value.getField(match.name), match.dataType, field.dataType, f"{name}.{field.name}")
            fields.append(part.alias(field.name))
        fields += [value.getField(field.name).alias(field.name) for field in mine.values()]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(own, T.ArrayType) and isinstance(old, T.ArrayType):
        return F.transform(value, lambda item: _aligned(item, own.elementType, old.elementType, f"{name}.element"))
    if isinstance(own, T.MapType) and isinstance(old, T.MapType) and own.keyType.simpleString() == old.keyType.simpleString():
        return F.transform_values(value, lambda _, item: _aligned(item, own.valueType, old.valueType, f"{name}.value"))
    raise ValueError(f"column {name} was {old.simpleString()} and is {own.simpleString()}")


def merge_schema(df: DataFrame, old: T.StructType) -> DataFrame:
    """The frame under the union of an old schema and its own.

    Old columns come first, in their order, null if the frame lacks them; new columns follow, and so do the fields of
    structs, also in arrays and as values of maps. Only the schema of the old table is used. A column or field of both
    that differs in type raises ``ValueError``.
    """
    # Spark resolves names without regard to case, so the union does too.
    mine = {field.name.lower(): field for field in df.schema.fields}
    columns = []
    for field in old.fields:
        own = mine.pop(field.name.lower(), None)
        if own is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name, metadata=field.metadata))
        elif own.dataType.simpleString() == field.dataType.simpleString():
            columns.append(quoted(own.name))
        else:
            columns.append(_aligned(quoted(own.name), own.dataType, field.dataType, field.name).alias(own.name, metadata=own.metadata))
    return df.select(*columns, *[quoted(field.name) for field in mine.values()])


def overwrite_merge_schema(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Replace all rows of the target; its schema becomes the union of the old one and the frame's.

    The new rows are written beside the old ones and take their place once they are whole: a write that
    fails leaves the target as it was.
    """
    old = existing_schema(df.sparkSession, target, fmt)
    df = df if old is None else merge_schema(df, old)
    if is_path(target):
        replace_folder(df.sparkSession, target, df.write.format(fmt).save)
    elif old is None:
        df.write.format(fmt).saveAsTable(target)
    else:
        _replace_table(df, target, fmt)


def append(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Create the target on the first write, append afterwards."""
    writer = df.write.mode("append").format(fmt)
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)
