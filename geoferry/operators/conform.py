"""Casts of whole frames: to a layer's field list, or to text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoferry.fixed_values import FIELD_TYPES
from geoferry.functions.geometry import is_geometry
from geoferry.functions.text import quoted


def stringify_columns(df: DataFrame) -> DataFrame:
    """Every column cast to string, order kept."""
    return df.select(*[quoted(name).cast("string").alias(name) for name in df.columns])


def _cast(column: Column, source: T.DataType, target: str, strict: bool) -> Column:
    if target == "binary" and not isinstance(source, (T.StringType, T.BinaryType)):
        return F.encode(column.cast("string"), "UTF-8")
    return column.cast(target) if strict else column.try_cast(target)


def conform_schema(
    df: DataFrame,
    fields: Iterable[Mapping[str, str]],
    strict: bool = True,
    keep_time_of_day: bool = False,
) -> DataFrame:
    """Cast and reorder the frame to a layer's field list (mappings with ``name`` and ``type``).

    Listed fields come first, in the list's order; the other columns follow, unchanged. Fields the frame
    lacks are left out. Names match by exact case. Geometry is not cast. A value that does not fit raises,
    or becomes null when not ``strict``. Dates lose the time of day unless it is kept as a timestamp.
    """
    types = dict(FIELD_TYPES, esriFieldTypeDate="timestamp") if keep_time_of_day else FIELD_TYPES
    wanted = {}
    for field in fields:
        if field["name"] in df.columns:
            wanted.setdefault(field["name"], types.get(field["type"], "string"))
    listed = []
    for name, target in wanted.items():
        source = df.schema[name].dataType
        keep = is_geometry(source)
        listed.append(quoted(name) if keep else _cast(quoted(name), source, target, strict).alias(name))
    return df.select(*listed, *[quoted(name) for name in df.columns if name not in wanted])
