"""The geometry type, and Column functions over it.

A geometry is a struct of a kind and three nested levels of points: parts, rings or lines, coordinates.

=================  ==========================
Point              ``[[[p]]]``
MultiPoint         ``[[[p]], [[p]], ...]``
LineString         ``[[[p, p, ...]]]``
MultiLineString    ``[[[p, ...]], [[p, ...]]]``
Polygon            ``[[ring, hole, ...]]``
MultiPolygon       ``[[ring, ...], [ring, ...]]``
=================  ==========================

The SRID is kept in the field's metadata, so it survives Parquet; an operator that rebuilds the column
attaches it again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT_TYPE = "struct<x:double,y:double>"
GEOMETRY_TYPE = f"struct<gtype:string,parts:array<array<array<{POINT_TYPE}>>>>"
SRID = "srid"


def is_geometry(data_type: T.DataType) -> bool:
    return data_type.simpleString() == GEOMETRY_TYPE


def geometry_field(schema: T.StructType) -> T.StructField | None:
    """The first geometry field of a schema, or None."""
    return next((field for field in schema.fields if is_geometry(field.dataType)), None)


def srid_of(field: T.StructField) -> int | None:
    return field.metadata.get(SRID)


def with_srid(geometry: Column, name: str, srid: int | None) -> Column:
    """The column under a name, carrying its spatial reference."""
    return geometry.alias(name) if srid is None else geometry.alias(name, metadata={SRID: srid})


def of_kind(kind: str, parts: Column) -> Column:
    return F.struct(F.lit(kind).alias("gtype"), parts.alias("parts")).cast(GEOMETRY_TYPE)


def coordinate(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def point(x: Column, y: Column) -> Column:
    return of_kind("Point", F.array(F.array(F.array(coordinate(x, y)))))


def polygon(*corners: tuple[Column, Column]) -> Column:
    """Polygon of one ring from its corners, the first repeated at the end."""
    return of_kind("Polygon", F.array(F.array(F.array(*[coordinate(x, y) for x, y in corners]))))


def map_points(geometry: Column, steps: Sequence[Callable[[Column], Column]]) -> Column:
    """The geometry with every point taken through the steps, the last of which gives a point; null stays null."""

    def change(ring: Column) -> Column:
        return reduce(F.transform, steps, ring)

    parts = F.transform(geometry["parts"], lambda part: F.transform(part, change))
    changed = F.struct(geometry["gtype"].alias("gtype"), parts.alias("parts"))
    return F.when(geometry.isNotNull(), changed).cast(GEOMETRY_TYPE)


def _rounded(value: Column, decimals: int) -> Column:
    text = value.cast(T.DecimalType(38, decimals)).cast("string")
    # With decimals there always is a point, so only zeros after it are cut.
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit(".")) if decimals else text


def _exact(value: Column) -> Column:
    """The digits that read back as the same double, without an exponent."""

    def plain(text: Column) -> Column:
        sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
        digits = F.rtrim(F.translate(F.substring_index(text, "E", 1), "-.", ""), F.lit("0"))
        return F.transform(
            F.array(F.struct(sign.alias("sign"), digits.alias("digits"), F.substring_index(text, "E", -1).cast("int").alias("power"))), shifted
        )[0]

    def shifted(number: Column) -> Column:
        digits, power = number["digits"], number["power"]
        whole = F.rpad(digits, power + 1, F.lit("0"))
        placed = (
            F.when(power < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits))
            .when(F.char_length(digits) <= power + 1, whole)
            .otherwise(F.concat(F.left(digits, power + 1), F.lit("."), F.substring(digits, power + 2, F.char_length(digits))))
        )
        return F.concat(number["sign"], placed)

    def shown(text: Column) -> Column:
        return F.when(F.contains(text, F.lit("E")), plain(text)).otherwise(F.regexp_replace(text, r"\.0$", ""))

    # Minus zero reads as zero.
    return F.transform(F.array((value + F.lit(0.0)).cast("string")), shown)[0]


def number_text(value: Column, decimals: int | None = None) -> Column:
    """A number as WKT has it: every digit it takes to read back the same double, or rounded to some decimals."""
    return _exact(value) if decimals is None else _rounded(value, decimals)


def as_wkt(geometry: Column, decimals: int | None = None) -> Column:
    """WKT text; ``... EMPTY`` where there is no point. Coordinates read back as the same doubles, unless ``decimals`` are
    asked for.

    A point without coordinates is an empty point. A missing or infinite coordinate in any other kind raises, since the
    shape would be another one without that vertex.
    """
    kind = geometry["gtype"]

    def has_place(p: Column) -> Column:
        return F.coalesce((F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")), F.lit(False))

    def coordinates(points: Column) -> Column:
        placed = F.filter(points, has_place)
        pairs = F.transform(placed, lambda p: F.concat(number_text(p["x"], decimals), F.lit(" "), number_text(p["y"], decimals)))
        is_whole = (kind == "Point") | F.coalesce(F.forall(points, has_place), F.lit(True))
        missing = F.raise_error(F.concat(F.lit("a vertex has no coordinates: "), kind))
        return F.when(is_whole, F.array_join(pairs, ", ")).otherwise(missing)

    def bracket(text: Column) -> Column:
        return F.concat(F.lit("("), text, F.lit(")"))

    def body(parts: Column) -> Column:
        rings = F.array_join(F.transform(F.flatten(parts), bracket), ", ")
        nested = F.transform(parts, lambda part: bracket(F.array_join(F.transform(part, bracket), ", ")))
        return (
            F.when(F.size(parts) == 0, "EMPTY")
            .when(kind.isin("LineString", "Point"), rings)
            .when(kind.isin("Polygon", "MultiPoint", "MultiLineString"), bracket(rings))
            .when(kind == "MultiPolygon", bracket(F.array_join(nested, ", ")))
            .otherwise(F.raise_error(F.concat(F.lit("unknown geometry kind: "), kind)))
        )

    # Per part, the text of each non-empty ring; then only the parts that still have one.
    rings = F.transform(
        geometry["parts"],
        lambda part: F.filter(F.transform(part, coordinates), lambda text: text != ""),
    )
    filled = F.filter(rings, lambda part: F.size(part) > 0)
    # As the one element of an array, the texts are worked out once and then used several times.
    text = F.transform(F.array(filled), body)[0]
    return F.when(kind.isNotNull(), F.concat(F.upper(kind), F.lit(" "), text))
