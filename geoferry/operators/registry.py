"""The service registry: one row per service, with arrays of its layers and tables.

Columns used: ``id, title, type, owner, url, layers, tables``, where ``layers`` and ``tables`` are arrays
of structs with at least ``id, name, url``. ``enumerate_layers`` needs no more than ``id`` and takes what else
there is: its projection is planned from the schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoferry.fixed_values import NEW_SERVICE_TAGS, NO_SUBLAYER_ID, SERVICE_TYPE
from geoferry.functions.text import quoted
from geoferry.operators.joins import join_to_grouped, key_names


def find_service(services: DataFrame, names: DataFrame, owner: str | None = None) -> DataFrame:
    """Look each row of ``names`` up by exact title in its column ``name``; adds ``found, url, id``.

    Only feature services count, of one owner if given; of several, the one with the smallest id.
    """
    candidates = services.where(F.col("type") == SERVICE_TYPE)
    if owner:
        candidates = candidates.where(F.col("owner") == owner)
    (title,) = key_names(["name"])
    first = candidates.groupBy(F.col("title").alias(title)).agg(
        F.min("id").alias("__id"), F.min_by("url", "id").alias("__url")
    )
    return join_to_grouped(names, first, ["name"], "left").select(
        *[quoted(column) for column in names.columns],
        F.col(title).isNotNull().alias("found"),
        F.col("__url").alias("url"),
        F.col("__id").alias("id"),
    )


def services_to_create(
    found: DataFrame, summary: str | None = None, tags: list[str] | None = None, owner: str | None = None
) -> DataFrame:
    """Registry rows for the names that ``find_service`` did not find, one per name."""
    return (
        found.where(~F.col("found"))
        .select("name")
        .distinct()
        .select(
            F.col("name").alias("title"),
            F.lit(SERVICE_TYPE).alias("type"),
            F.lit(owner).cast("string").alias("owner"),
            (F.lit(summary) if summary else F.concat(F.lit("Service for "), F.col("name"))).alias("description"),
            F.array(*[F.lit(tag) for tag in tags or NEW_SERVICE_TAGS]).alias("tags"),
        )
    )


def service_layers(services: DataFrame) -> DataFrame:
    """Layers, then tables, of each service: ``service_id, position, name, id``."""

    def brief(column: str):
        listed = F.transform(column, lambda entry: F.struct(entry["name"].alias("name"), entry["id"].alias("id")))
        return F.coalesce(listed, F.array().cast("array<struct<name:string,id:int>>"))

    return services.select(
        F.col("id").alias("service_id"),
        F.posexplode(F.concat(brief("layers"), brief("tables"))).alias("position", "entry"),
    ).select("service_id", "position", F.col("entry.name").alias("name"), F.col("entry.id").alias("id"))


def property_of(schema: T.DataType, name: str, parent: str | None = None) -> tuple[Column, T.DataType]:
    """A column, or a field of the struct column ``parent``, with its type; a null where the schema has no such name."""
    known = {field.name.lower(): field for field in schema.fields} if isinstance(schema, T.StructType) else {}
    field = known.get(name.lower())
    if field is None:
        return F.lit(None), T.NullType()
    return quoted(field.name) if parent is None else quoted(parent).getField(field.name), field.dataType


def _layer_array(items: DataFrame) -> tuple[Column, T.DataType]:
    """The layers of each item as an array of structs, and the type of one. Bare text is a URL, a struct one layer."""
    column, kind = property_of(items.schema, "layers")
    if isinstance(kind, T.ArrayType):
        entry = kind.elementType
    else:
        column, entry = F.when(column.isNotNull(), F.array(column)), kind
    if isinstance(entry, T.StructType):
        return column, entry
    bare = T.StructType([T.StructField("url", T.StringType())])
    if isinstance(entry, T.NullType):
        return F.lit(None).cast(T.ArrayType(bare)), bare
    return F.transform(column, lambda url: F.struct(url.cast("string").alias("url"))), bare


def enumerate_layers(items: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per layer of each item: ``item_id, has_layers, sublayer_id, layer_name, layer_url, layer``.

    Columns of the item named in ``keep`` follow. ``layers`` is an array of structs, one struct, an array of URLs, or
    missing; its structs have any of ``id, name, url``.

    A name defaults to the last segment of the URL and an id to a fixed mark. An item without layers
    gives one row with ``has_layers`` false and nulls.
    """
    layers, kind = _layer_array(items)
    rows = items.select(F.col("id").cast("string").alias("item_id"), F.explode_outer(layers).alias("layer"), *keep)
    has_layer = F.col("layer").isNotNull()
    own_name, own_id, url = (property_of(kind, name, "layer")[0].cast("string") for name in ("name", "id", "url"))
    return rows.select(
        "item_id",
        has_layer.alias("has_layers"),
        F.when(has_layer, F.coalesce(own_id, F.lit(NO_SUBLAYER_ID))).alias("sublayer_id"),
        F.when(has_layer, F.coalesce(own_name, F.element_at(F.split(url, "/"), -1))).alias("layer_name"),
        url.alias("layer_url"),
        "layer",
        *keep,
    )
