import math

import pytest
from pyspark.sql import functions as F

from geoferry import geometry_as_wkt, reproject, spatial_reference_info
from geoferry.functions import geometry as g
from geoferry.operators.spatial import layer_geometry

KINDS = [
    ("Point", [[[(1.5, -2.0)]]], "POINT (1.5 -2)"),
    ("LineString", [[[(0.0, 0.0), (10.0, 20.25)]]], "LINESTRING (0 0, 10 20.25)"),
    (
        "Polygon",
        [[[(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]],
        "POLYGON ((0 0, 9 0, 9 9, 0 0), (1 1, 2 1, 2 2, 1 1))",
    ),
    ("MultiPoint", [[[(1.0, 2.0)]], [[(3.0, 4.0)]]], "MULTIPOINT ((1 2), (3 4))"),
    (
        "MultiLineString",
        [[[(0.0, 0.0), (1.0, 1.0)]], [[(2.0, 2.0), (3.0, 3.0)]]],
        "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))",
    ),
    (
        "MultiPolygon",
        [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]], [[(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 5.0)]]],
        "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))",
    ),
    ("Point", [], "POINT EMPTY"),
    ("MultiPolygon", [], "MULTIPOLYGON EMPTY"),
    ("Polygon", [[[]]], "POLYGON EMPTY"),
    ("Point", [[[(None, None)]]], "POINT EMPTY"),
    ("Point", [[[(100.0, 0.000000001)]]], "POINT (100 0.000000001)"),
    ("Point", [[[(-0.0, 1e-12)]]], "POINT (0 0.000000000001)"),
    ("Point", [[[(-1.25e-10, 1.5e22)]]], "POINT (-0.000000000125 15000000000000000000000)"),
    ("Point", [[[(1e7, 0.1 + 0.2)]]], "POINT (10000000 0.30000000000000004)"),
    ("Point", [[[(20037508.342789244, -1234567.5)]]], "POINT (20037508.342789244 -1234567.5)"),
    (None, None, None),
]


def layer(spark, shapes, srid=4326):
    rows = [(i, None if kind is None else (kind, parts), "n") for i, (kind, parts) in enumerate(shapes)]
    df = spark.createDataFrame(rows, f"id long, shape {g.GEOMETRY_TYPE}, name string")
    return df.select("id", g.with_srid(F.col("shape"), "shape", srid), "name")


def points(df):
    return [row[0] and tuple(row[0].parts[0][0][0]) for row in df.orderBy("id").select("shape").collect()]


def test_wkt_of_each_kind(spark):
    df = geometry_as_wkt(layer(spark, [kind[:2] for kind in KINDS]))
    assert df.columns == ["id", "geometry_wkt", "name"]
    assert [row.geometry_wkt for row in df.orderBy("id").collect()] == [kind[2] for kind in KINDS]


def test_wkt_reads_back_as_the_same_numbers(spark):
    import random
    import struct

    rng = random.Random(4)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(5000)] + [rng.uniform(-180, 180) for _ in range(5000)]
    values = [v for v in values if math.isfinite(v)] + [5e-324, 1.7976931348623157e308, 2.2250738585072014e-308, 1e23, 9007199254740993.0, 0.001, 9999999.999, -1e7]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", g.number_text(F.col("v")).alias("t"))
    assert df.where((F.col("t").cast("double") != F.col("v")) | ~F.col("t").rlike(r"^-?(0|[1-9][0-9]*)([.][0-9]*[1-9])?$")).isEmpty()
    rounded = spark.range(1).select(*[g.number_text(F.lit(v), 2).alias(str(n)) for n, v in enumerate((1.005, -3.0, 1e-10, 1234567.891))]).first()
    assert tuple(rounded) == ("1.01", "-3", "0", "1234567.89") or tuple(rounded)[1:] == ("-3", "0", "1234567.89")
    two = geometry_as_wkt(layer(spark, [("Point", [[[(1.23456, 2.0)]]])]), decimals=2)
    assert two.first().geometry_wkt == "POINT (1.23 2)"


def test_unknown_kind_raises(spark):
    with pytest.raises(Exception, match="unknown geometry kind"):
        geometry_as_wkt(layer(spark, [("Circle", [[[(0.0, 0.0)]]])])).collect()


def test_a_vertex_without_place_raises(spark):
    for missing in (None, math.nan, math.inf):
        shapes = [("LineString", [[[(0.0, 0.0), (1.0, missing)]]])]
        with pytest.raises(Exception, match="a vertex has no coordinates: LineString"):
            geometry_as_wkt(layer(spark, shapes)).collect()
    assert geometry_as_wkt(layer(spark, [("Point", [[[(math.nan, 1.0)]]])])).first().geometry_wkt == "POINT EMPTY"


def test_reprojection_keeps_structure_and_sets_the_srid(spark):
    df = layer(spark, [kind[:2] for kind in KINDS[:6]])
    out = reproject(df, 3857)
    assert out.columns == df.columns
    field = out.schema["shape"]
    assert g.is_geometry(field.dataType) and g.srid_of(field) == 3857
    back = reproject(out, 4326)
    for mine, theirs in zip(df.orderBy("id").collect(), back.orderBy("id").collect()):
        assert mine.shape.gtype == theirs.shape.gtype
        for part, other in zip(mine.shape.parts, theirs.shape.parts, strict=True):
            for ring, other_ring in zip(part, other, strict=True):
                for p, q in zip(ring, other_ring, strict=True):
                    assert math.dist(p, q) < 1e-7


def test_known_coordinates(spark):
    shapes = [("Point", [[[(lon, lat)]]]) for lon, lat in ((0.0, 0.0), (180.0, 0.0), (-180.0, 85.0), (10.0, -85.0), (5.0, 90.0), (5.0, -90.0))]
    found = points(reproject(layer(spark, shapes), outside="null"))
    edge = math.pi * 6378137.0
    assert found[0] == (0.0, 0.0)
    assert found[1] == pytest.approx((edge, 0.0))
    north = 6378137.0 * math.log(math.tan(math.pi / 4 + math.radians(85) / 2))
    assert found[2] == pytest.approx((-edge, north))
    assert found[3][1] == pytest.approx(-north)
    assert found[4:] == [None, None]
    text = geometry_as_wkt(reproject(layer(spark, shapes), outside="null")).orderBy("id").collect()
    assert text[4].geometry_wkt is None


UTM = [
    # srid, longitude, latitude, easting, northing
    (32618, -75.0, 40.0, 500000.0, 4427757.219),
    (32631, 3.0, 0.0, 500000.0, 0.0),
    (32631, 0.0, 0.0, 166021.443, 0.0),
]


def test_known_utm_coordinates(spark):
    for srid, lon, lat, easting, northing in UTM:
        (found,) = points(reproject(layer(spark, [("Point", [[[(lon, lat)]]])]), srid))
        assert found == pytest.approx((easting, northing), abs=0.001)
    # South of the equator northings count down from ten million.
    north = points(reproject(layer(spark, [("Point", [[[(153.0, 30.0)]]])]), 32656))[0]
    south = points(reproject(layer(spark, [("Point", [[[(153.0, -30.0)]]])]), 32756))[0]
    assert south == pytest.approx((north[0], 10_000_000 - north[1]), abs=1e-6)


@pytest.mark.parametrize("srid", [3857, 102100, 32601, 32631, 32733])
def test_there_and_back(spark, srid):
    middle = 15 if srid == 32733 else -177 if srid == 32601 else 3
    shapes = [("Point", [[[(middle + dx / 2, float(lat))]]]) for dx in range(-7, 8) for lat in range(-80, 85, 4)]
    df = layer(spark, shapes)
    back = points(reproject(reproject(df, srid), 4326))
    assert max(math.dist(p, q) for p, q in zip(points(df), back, strict=True)) < 1e-7


def test_between_projections(spark):
    df = layer(spark, [("Point", [[[(4.25, 51.5)]]])])
    direct = points(reproject(df, 32631))[0]
    assert points(reproject(reproject(df, 3857), 32631))[0] == pytest.approx(direct, abs=1e-4)


def test_points_without_image(spark):
    shapes = [("Point", [[[(x, y)]]]) for x, y in ((3.0, 90.0), (153.0, 0.0), (93.1, 10.0))]
    assert points(reproject(layer(spark, shapes), 32631, outside="null")) == [None] * 3


LINES = [
    # the vertices, and whether the line has an image in 3857, 32631 and 32660
    ([(0.0, 0.0), (0.0, 90.0)], False, False, False),
    ([(0.0, -89.9), (10.0, 89.9)], True, True, False),
    ([(0.0, 0.0), (28.0, 0.0)], True, True, False),
    ([(0.0, 0.0), (28.5, 0.0)], True, False, False),
    ([(179.0, 10.0), (-179.0, 10.0)], True, False, True),
    ([(177.0, 10.0), (-157.0, 10.0)], True, False, False),
    ([(3.0, 91.0), (3.0, 0.0)], False, False, False),
]


def test_a_geometry_without_image_is_refused_whole(spark):
    shapes = [("LineString", [[vertices]]) for vertices, *_ in LINES]
    for place, srid in enumerate((3857, 32631, 32660), 1):
        found = reproject(layer(spark, shapes), srid, outside="null").orderBy("id").collect()
        assert [row.shape is not None for row in found] == [line[place] for line in LINES]
        assert all(p.x is not None and math.isfinite(p.x) for row in found if row.shape for p in row.shape.parts[0][0])
        with pytest.raises(Exception, match=f"a geometry has no image in {srid}: LineString"):
            reproject(layer(spark, shapes), srid).collect()
    with pytest.raises(ValueError):
        reproject(layer(spark, shapes), outside="drop")
    # One hole over the pole takes its polygon along; a point without coordinates stays an empty point.
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    mixed = [("Polygon", [[ring, [(0.1, 0.1), (0.2, 90.0), (0.1, 0.1)]]]), ("Point", [[[(None, None)]]]), ("MultiPoint", [[[(1.0, 1.0)]], [[(1.0, -90.0)]]]), (None, None)]
    found = reproject(layer(spark, mixed), 3857, outside="null").orderBy("id").collect()
    assert [row.shape and row.shape.gtype for row in found] == [None, "Point", None, None]
    # From a zone: metres too far out are refused as well.
    far = layer(spark, [("Point", [[[(500000.0, 0.0)]]]), ("Point", [[[(9e6, 0.0)]]])], srid=32631)
    assert [p is not None for p in points(reproject(far, 4326, outside="null"))] == [True, False]


def test_same_reference_and_alias(spark):
    df = layer(spark, [KINDS[0][:2]])
    assert reproject(df, 4326) is df
    mercator = reproject(df, 102100)
    assert g.srid_of(mercator.schema["shape"]) == 102100
    assert points(reproject(mercator, 3857)) == points(mercator)
    assert g.srid_of(reproject(mercator, 3857).schema["shape"]) == 3857


def test_unsupported_reference_raises(spark):
    for srid, out in ((4326, 2263), (2263, 4326), (None, 4326)):
        with pytest.raises(ValueError, match=f"{srid} to {out}"):
            reproject(layer(spark, [KINDS[0][:2]], srid), out)


def test_frame_without_geometry_is_unchanged(spark):
    df = spark.range(3)
    assert reproject(df) is df and geometry_as_wkt(df) is df


def test_reference_survives_parquet_and_filters(spark, folder):
    target = folder()
    layer(spark, [KINDS[0][:2]]).write.parquet(target)
    df = spark.read.parquet(target).where("id >= 0").select("shape", "id")
    assert g.srid_of(df.schema["shape"]) == 4326


def test_info_of_frames(spark):
    frames = {"points": layer(spark, [KINDS[0][:2]]), "web": layer(spark, [KINDS[0][:2]], 102100), "plain": spark.range(1)}
    rows = {row.layer: row for row in spatial_reference_info(layer_geometry(spark, frames)).collect()}
    assert (rows["points"].geometry_column, rows["points"].wkid, rows["points"].units) == ("shape", 4326, "Degree")
    assert (rows["web"].is_projected, rows["web"].name, rows["web"].units) == (True, "GCS_WGS_1984", "Meter")
    assert tuple(rows["plain"])[1:] == (None,) * 6
