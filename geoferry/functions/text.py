"""Column functions for names, tags, descriptions, ids and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoferry.fixed_values import (
    DESCRIPTION_LINE,
    GEOGCS_NAME,
    ITEM_ID_LINE,
    MAX_NAME_LENGTH,
    MAX_TAGS,
    MICROS_FORMAT,
    NAME_BREAKS,
    PARENT_HEADING,
    SECONDS_FORMAT,
    SPATIAL_REFERENCE_LABELS,
    SPATIAL_REFERENCE_LINE,
    TABLE_NAME_LINE,
    TAG_BREAKS,
)


def quoted(name: str) -> Column:
    """Column by its literal name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_table_name(name: Column, prefix: Column | None = None, postfix: Column | None = None) -> Column:
    """Legal table name from prefix, name and postfix; empty parts are left out."""
    parts = [F.nullif(part, F.lit("")) for part in (prefix, name, postfix) if part is not None]
    joined = F.regexp_replace(F.concat_ws("_", *parts), NAME_BREAKS, "_")
    return F.substring(F.lower(F.btrim(joined, F.lit("_"))), 1, MAX_NAME_LENGTH)


def attempt_id(target_path: Column, moment: Column) -> Column:
    """32 hex digits naming one attempt at a target path at a microsecond."""
    return F.md5(F.concat(target_path, F.lit("-"), F.date_format(moment, MICROS_FORMAT)))


def epoch_millis_to_string(millis: Column) -> Column:
    """Epoch milliseconds as text, in the session's time zone."""
    return F.date_format(F.timestamp_millis(millis), SECONDS_FORMAT)


def geogcs_name(wkt: Column) -> Column:
    """Name of the geographic system inside a WKT definition, null if there is none."""
    return F.nullif(F.regexp_extract(wkt, GEOGCS_NAME, 1), F.lit(""))


def tag_array(tags: Column, kind: T.DataType) -> Column:
    """Tags of any type as an array of text; a scalar becomes an array of one, null an empty array."""
    if not isinstance(kind, T.ArrayType):
        tags = F.when(tags.isNotNull(), F.array(tags.cast("string")))
    return F.coalesce(tags.cast("array<string>"), F.array().cast("array<string>"))


def as_tag_array(df: DataFrame, name: str) -> Column:
    """The column as a tag array; a scalar becomes an array of one."""
    return tag_array(quoted(name), df.schema[name].dataType)


def normalize_tags(parent_tags: Column, layer_tags: Column) -> Column:
    """Cleaned union of two tag arrays: distinct, sorted, at most the permitted number."""
    none = F.array().cast("array<string>")
    tags = F.concat(F.coalesce(parent_tags, none), F.coalesce(layer_tags, none))
    kept = F.filter(tags, lambda tag: tag.isNotNull() & (tag != ""))
    cleaned = F.transform(kept, lambda tag: F.substring(F.regexp_replace(tag, TAG_BREAKS, "_"), 1, MAX_NAME_LENGTH))
    return F.slice(F.array_sort(F.array_distinct(cleaned)), 1, MAX_TAGS)


def _shown(value: Column, is_flag: bool = False) -> Column:
    """A value as it reads in a description: None, True and False are spelt out."""
    if is_flag:
        return F.when(value.isNull(), "None").when(value, "True").otherwise("False")
    return F.coalesce(value.cast("string"), F.lit("None"))


def compose_description(
    table_name: Column,
    item_id: Column,
    layer_text: Column,
    parent_text: Column,
    spatial_reference: dict[str, Column],
) -> Column:
    """Table description from the layer's text, its parent's text and spatial reference entries.

    ``spatial_reference`` gives a Column for each of the columns of ``spatial_reference_info``.
    """
    own = F.coalesce(layer_text, F.lit(""))
    has_parent = F.btrim(F.coalesce(parent_text, F.lit("")), F.lit(" \n\t\r")) != ""
    text = F.when(has_parent, F.concat(own, F.lit(f"\n\n{PARENT_HEADING}\n"), parent_text)).otherwise(own)
    lines = [
        F.concat(F.lit(TABLE_NAME_LINE), table_name),
        F.concat(F.lit(ITEM_ID_LINE), F.lit("`"), item_id, F.lit("`")),
        F.concat(F.lit(DESCRIPTION_LINE), text),
        F.lit(SPATIAL_REFERENCE_LINE),
    ]
    for key, label in SPATIAL_REFERENCE_LABELS.items():
        lines.append(
            F.concat(F.lit(f"    - {label} : "), _shown(spatial_reference[key], is_flag=key == "is_projected"))
        )
    return F.concat(*[part for line in lines for part in (line, F.lit("\n"))])
