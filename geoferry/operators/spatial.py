"""Operators over a frame's geometry column and its spatial reference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoferry.fixed_values import SPATIAL_REFERENCES, WKT_COLUMN
from geoferry.functions import geometry as g
from geoferry.functions.projections import Projection, projection_of, same_reference
from geoferry.functions.text import geogcs_name, quoted


def spatial_references(spark: SparkSession) -> DataFrame:
    """The known spatial references: ``srid, wkt, is_projected, unit``."""
    return spark.createDataFrame(SPATIAL_REFERENCES, "srid int, wkt string, is_projected boolean, unit string")


def layer_geometry(spark: SparkSession, layers: dict[str, DataFrame]) -> DataFrame:
    """Geometry column and SRID of each named frame, read off its schema: ``layer, geometry_column, wkid``."""
    rows = []
    for name, df in layers.items():
        field = g.geometry_field(df.schema)
        rows.append((name, field and field.name, field and g.srid_of(field)))
    return spark.createDataFrame(rows, "layer string, geometry_column string, wkid int")


def spatial_reference_info(layers: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """Spatial reference of each row of ``layer, geometry_column, wkid``; nulls where there is no geometry.

    The built-in table of references has little more than a hundred rows and is broadcast; a caller's own is not.
    """
    known = F.broadcast(spatial_references(layers.sparkSession)) if references is None else references
    return (
        layers.join(known, F.col("geometry_column").isNotNull() & (F.col("wkid") == F.col("srid")), "left")
        .select(
            "layer",
            "geometry_column",
            F.when(F.col("geometry_column").isNotNull(), F.col("wkid")).alias("wkid"),
            "wkt",
            "is_projected",
            F.col("unit").alias("units"),
            geogcs_name(F.col("wkt")).alias("name"),
        )
    )


def _named_geometry(df: DataFrame, geometry: str | None):
    return df.schema[geometry] if geometry else g.geometry_field(df.schema)


def _has_image(geometry: Column, start: Projection, end: Projection) -> Column:
    """Whether all points of a geometry in degrees have an image; those without coordinates are not asked."""

    def inside(p: Column) -> Column:
        missing = p["x"].isNull() | p["y"].isNull() | F.isnan(p["x"]) | F.isnan(p["y"])
        return missing | (start.has_image(p) & end.has_image(p))

    return F.coalesce(F.forall(geometry["parts"], lambda part: F.forall(part, lambda ring: F.forall(ring, inside))), F.lit(True))


def reproject(df: DataFrame, out_srid: int = 3857, geometry: str | None = None, outside: str = "raise") -> DataFrame:
    """The frame with its geometry column in another spatial reference.

    Unchanged without a geometry column, or when it already is in that reference. Degrees (4326), Web
    Mercator (3857, also known as 102100) and the UTM zones (32601-32660 and 32701-32760) are supported;
    any other reference raises ``ValueError``. The poles have no image in a projection, and a zone holds what is within 25
    degrees of its central meridian. A geometry with a point that has no image is no geometry there: the job raises, or
    with ``outside="null"`` the whole geometry becomes null. A point without coordinates stays one.
    """
    if outside not in ("raise", "null"):
        raise ValueError("outside is raise or null")
    field = _named_geometry(df, geometry)
    if field is None:
        return df
    srid = g.srid_of(field)
    if srid == out_srid:
        return df
    start, end = projection_of(srid), projection_of(out_srid)
    if start is None or end is None:
        raise ValueError(f"cannot reproject {field.name} from {srid} to {out_srid}")
    column = quoted(field.name)
    if not same_reference(srid, out_srid):
        refused = F.lit(None).cast(g.GEOMETRY_TYPE)
        if outside == "raise":
            refused = F.raise_error(F.concat(F.lit(f"a geometry has no image in {out_srid}: "), column["gtype"])).cast(g.GEOMETRY_TYPE)

        def projected(degrees: Column) -> Column:
            image = g.map_points(degrees, end.forward) if end.forward else degrees
            return F.when(degrees.isNull() | _has_image(degrees, start, end), image).otherwise(refused)

        # As the one element of an array, the degrees are worked out once and then used several times.
        degrees = g.map_points(column, start.inverse) if start.inverse else column
        column = F.transform(F.array(degrees), projected)[0]
    changed = g.with_srid(column, field.name, out_srid)
    return df.select(*[changed if name == field.name else quoted(name) for name in df.columns])


def geometry_as_wkt(df: DataFrame, geometry: str | None = None, decimals: int | None = None) -> DataFrame:
    """The frame with its geometry column replaced, in place, by WKT text; unchanged without one.

    Coordinates read back as the same numbers, unless ``decimals`` are asked for."""
    field = _named_geometry(df, geometry)
    if field is None:
        return df
    text = g.as_wkt(quoted(field.name), decimals).alias(WKT_COLUMN)
    return df.select(*[text if name == field.name else quoted(name) for name in df.columns])
