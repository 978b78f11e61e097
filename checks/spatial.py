"""Geometry columns and spatial references, and the ingest of whole layers."""

from __future__ import annotations

from pyspark.sql import functions as F

import geoferry as gf
from checks.registry import (
    check,
    exact_sql,
    latitude,
    latitude_sql,
    longitude,
    longitude_sql,
    number_sql,
    table,
)
from geoferry.fixed_values import EARTH_RADIUS, MERCATOR_WKT, WGS84_WKT, utm_wkt
from geoferry.functions import geometry as g
from geoferry.functions.text import geogcs_name as geogcs_name_of
from geoferry.workspace import new_folder

X, Y = longitude_sql("c_custkey"), latitude_sql("c_custkey")


def _points(df, key, srid, scale=1):
    place = g.point(longitude(key) * scale, latitude(key) * scale)
    return df.withColumn("shape", g.with_srid(place, "shape", srid))


def _coordinates(df, decimals):
    """Key, rounded coordinates and SRID of a frame of points."""
    first = F.col("shape.parts")[0][0][0]
    return df.select(
        "c_custkey",
        F.round(first["x"], decimals).alias("x"),
        F.round(first["y"], decimals).alias("y"),
        F.lit(g.srid_of(df.schema["shape"])).alias("srid"),
    )


@check(
    "spatial_reference_info",
    f"""
    with layers as (
        select 'part_' || p_partkey as layer,
               case p_partkey % 4 when 0 then 4326 when 1 then 3857 when 2 then 32631 end as srid
        from part
    ), refs as (
        select * from (values (4326, '{WGS84_WKT}', false, 'Degree'), (3857, '{MERCATOR_WKT}', true, 'Meter'),
                              (32631, '{utm_wkt(31, False)}', true, 'Meter'))
            as t(wkid, wkt, is_projected, units)
    )
    select layer, case when srid is not null then 'shape' end as geometry_column, cast(srid as integer) as wkid,
           wkt, is_projected, units, case when srid is not null then 'GCS_WGS_1984' end as name
    from layers left join refs on srid = wkid
    """,
)
def spatial_reference_info(spark, sf_dir):
    layers = table(spark, sf_dir, "part").select(
        F.concat(F.lit("part_"), F.col("p_partkey").cast("string")).alias("layer"),
        F.when(F.col("p_partkey") % 4 < 3, "shape").alias("geometry_column"),
        F.expr("case p_partkey % 4 when 0 then 4326 when 1 then 3857 when 2 then 32631 end").alias("wkid"),
    )
    return gf.spatial_reference_info(layers)


@check(
    "geogcs_name",
    """
    select c_custkey, case c_custkey % 3 when 0 then 'GCS_' || c_name when 2 then 'GCS ' || c_name end as name
    from customer
    """,
)
def geogcs_name(spark, sf_dir):
    wkt = F.expr(
        """case c_custkey % 3
           when 0 then 'PROJCS["P_' || c_name || '",GEOGCS["GCS_' || c_name || '",DATUM["D"]]]'
           when 1 then 'LOCAL_CS["' || c_name || '"]'
           else 'GEOGCS[ "GCS ' || c_name || '",DATUM["D"]]' end"""
    )
    return table(spark, sf_dir, "customer").select("c_custkey", geogcs_name_of(wkt).alias("name"))


@check(
    "reproject_to_mercator",
    f"""
    select c_custkey, round({EARTH_RADIUS} * radians({X}), 3) as x,
           round({EARTH_RADIUS} * ln(tan(pi() / 4 + radians({Y}) / 2)), 3) + 0.0e0 as y, cast(3857 as integer) as srid
    from customer
    """,
)
def reproject_to_mercator(spark, sf_dir):
    layer = _points(table(spark, sf_dir, "customer"), "c_custkey", 4326)
    return _coordinates(gf.reproject(layer, 3857), 3)


@check(
    "reproject_to_wgs84",
    f"""
    select c_custkey, round(degrees({X} * 100000 / {EARTH_RADIUS}), 8) as x,
           round(degrees(2 * atan(exp({Y} * 100000 / {EARTH_RADIUS})) - pi() / 2), 8) as y,
           cast(4326 as integer) as srid
    from customer
    """,
)
def reproject_to_wgs84(spark, sf_dir):
    layer = _points(table(spark, sf_dir, "customer"), "c_custkey", 3857, scale=100000)
    return _coordinates(gf.reproject(layer, 4326), 8)


@check(
    "reproject_same_srid",
    f"select c_custkey, round({X}, 8) as x, round({Y}, 8) as y, cast(4326 as integer) as srid from customer",
)
def reproject_same_srid(spark, sf_dir):
    layer = _points(table(spark, sf_dir, "customer"), "c_custkey", 4326)
    return _coordinates(gf.reproject(layer, 4326), 8)


_ULON, _ULAT = "(cast((c_custkey * 7919) % 600 as double) / 100)", "(cast((c_custkey * 104729) % 8400 as double) / 100)"
_F = 1 / 298.257223563


@check(
    "reproject_to_utm",
    f"""
    with constants as (
        select {_F} / (2 - {_F}) as n
    ), more as (
        select n, 2 * sqrt(n) / (1 + n) as c, 0.9996e0 * {EARTH_RADIUS} / (1 + n) * (1 + n * n / 4 + pow(n, 4) / 64) as r,
               n / 2 - 2 * n * n / 3 + 5 * pow(n, 3) / 16 as a1, 13 * n * n / 48 - 3 * pow(n, 3) / 5 as a2,
               61 * pow(n, 3) / 240 as a3
        from constants
    ), placed as (
        select c_custkey, radians({_ULON} - 3) as dl, sin(radians({_ULAT})) as s from customer
    ), conformal as (
        select c_custkey, dl, sinh(atanh(s) - c * atanh(c * s)) as t, r, a1, a2, a3 from placed cross join more
    ), sphere as (
        select *, atan(t / cos(dl)) as xi, atanh(sin(dl) / sqrt(1 + t * t)) as eta from conformal
    )
    select c_custkey,
           round(500000 + r * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta)
                 + a3 * cos(6 * xi) * sinh(6 * eta)), 3) as x,
           round(r * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta)
                 + a3 * sin(6 * xi) * cosh(6 * eta)), 3) as y,
           cast(32631 as integer) as srid
    from sphere
    """,
)
def reproject_to_utm(spark, sf_dir):
    """Into the UTM zone around 3 degrees east, from points inside it."""
    x = ((F.col("c_custkey") * 7919) % 600).cast("double") / 100
    y = ((F.col("c_custkey") * 104729) % 8400).cast("double") / 100
    layer = table(spark, sf_dir, "customer").withColumn("shape", g.with_srid(g.point(x, y), "shape", 4326))
    return _coordinates(gf.reproject(layer, 32631), 3)


_LON, _LAT = "((c_custkey * 7919) % 360 - 180)", "((c_custkey * 104729) % 181 - 90)"


def _inside_sql(reach: int | None, *vertices: tuple[str, str]) -> str:
    """Whether no vertex is a pole, and none further than some degrees from 3 east."""
    rules = [f"abs({y}) < 90" for _, y in vertices]
    if reach is not None:
        rules += [f"least(abs({x} - 3) % 360, 360 - abs({x} - 3) % 360) <= {reach}" for x, _ in vertices]
    return " and ".join(rules)


_LINE = [(_LON, _LAT), (f"({_LON} + 9)", f"(-{_LAT})")]
_RING = [(_LON, _LAT), (f"({_LON} + 5)", _LAT), (_LON, f"least(90, {_LAT} + 4)")]


@check(
    "reproject_domain",
    f"""
    select c_custkey, 'LineString' as kind, {_inside_sql(None, *_LINE)} as in_mercator, {_inside_sql(25, *_LINE)} as in_zone from customer
    union all
    select c_custkey, 'Polygon', {_inside_sql(None, *_RING)}, {_inside_sql(25, *_RING)} from customer
    """,
)
def reproject_domain(spark, sf_dir):
    """Lines and polygons all over the globe, some over a pole or beyond a zone's reach: those are null as a whole."""
    x, y = (F.col("c_custkey") * 7919) % 360 - 180, (F.col("c_custkey") * 104729) % 181 - 90
    up = F.least(F.lit(90), y + 4)
    line = g.of_kind("LineString", F.array(F.array(F.array(g.coordinate(x, y), g.coordinate(x + 9, -y)))))
    ring = g.polygon((x, y), (x + 5, y), (x, up), (x, y))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.explode(F.array(line, ring)).alias("shape"))
    layer = rows.select("c_custkey", F.col("shape.gtype").alias("kind"), g.with_srid(F.col("shape"), "shape", 4326), g.with_srid(F.col("shape"), "other", 4326))
    both = gf.reproject(gf.reproject(layer, 3857, "shape", outside="null"), 32631, "other", outside="null")

    def whole(name):
        """There, with coordinates for every vertex."""
        is_placed = lambda p: F.coalesce(F.abs(p["x"]) + F.abs(p["y"]) < float("inf"), F.lit(False))
        return F.coalesce(F.forall(F.flatten(F.flatten(f"{name}.parts")), is_placed), F.lit(False))

    return both.select("c_custkey", "kind", whole("shape").alias("in_mercator"), whole("other").alias("in_zone"))


_X, _X1 = exact_sql(X), exact_sql(f"({X} + 1)")
_Y, _Y1 = exact_sql(Y), exact_sql(f"({Y} + 1)")


@check(
    "geometry_as_wkt",
    f"""
    select c_custkey, case c_custkey % 7
        when 0 then 'POINT (' || {_X} || ' ' || {_Y} || ')'
        when 1 then 'LINESTRING (' || {_X} || ' ' || {_Y} || ', ' || {_X1} || ' ' || {_Y} || ')'
        when 2 then 'POLYGON ((' || {_X} || ' ' || {_Y} || ', ' || {_X1} || ' ' || {_Y} || ', ' || {_X} || ' ' || {_Y1}
                    || ', ' || {_X} || ' ' || {_Y} || '))'
        when 3 then 'MULTIPOINT ((' || {_X} || ' ' || {_Y} || '), (' || {_X1} || ' ' || {_Y1} || '))'
        when 4 then 'MULTILINESTRING ((' || {_X} || ' ' || {_Y} || ', ' || {_X1} || ' ' || {_Y} || '), ('
                    || {_X} || ' ' || {_Y1} || ', ' || {_X1} || ' ' || {_Y1} || '))'
        when 5 then 'MULTIPOLYGON (((' || {_X} || ' ' || {_Y} || ', ' || {_X1} || ' ' || {_Y} || ', '
                    || {_X1} || ' ' || {_Y1} || ', ' || {_X} || ' ' || {_Y} || ')), ((' || {_X1} || ' ' || {_Y1} || ', '
                    || {_X} || ' ' || {_Y1} || ', ' || {_X} || ' ' || {_Y} || ', ' || {_X1} || ' ' || {_Y1} || ')))'
        end as geometry_wkt, c_name
    from customer
    """,
)
def geometry_as_wkt(spark, sf_dir):
    """All six kinds, and rows without geometry."""
    x, y = longitude("c_custkey"), latitude("c_custkey")

    def shape(kind, *parts):
        rings = [[F.array(*[g.coordinate(*corner) for corner in ring]) for ring in part] for part in parts]
        return g.of_kind(kind, F.array(*[F.array(*part) for part in rings]))

    a, b, c, d = (x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)
    kinds = [
        g.point(x, y),
        shape("LineString", [[a, b]]),
        g.polygon(a, b, d, a),
        shape("MultiPoint", [[a]], [[c]]),
        shape("MultiLineString", [[a, b]], [[d, c]]),
        shape("MultiPolygon", [[a, b, c, a]], [[c, d, a, c]]),
    ]
    which = F.col("c_custkey") % 7
    value = F.when(which == 0, kinds[0])
    for number, kind in enumerate(kinds[1:], 1):
        value = value.when(which == number, kind)
    layer = table(spark, sf_dir, "customer").select("c_custkey", g.with_srid(value, "shape", 4326), "c_name")
    return gf.geometry_as_wkt(layer)


def _ingested(spark, sf_dir):
    """Two tables, two layers of points, and one layer that is not there; the result, the log and the folder."""
    source, target, log_path = (new_folder(spark, name) for name in ("layers", "tables", "ingest-log"))
    table(spark, sf_dir, "nation").write.parquet(f"{source}/nation")
    table(spark, sf_dir, "region").write.parquet(f"{source}/region")
    _points(table(spark, sf_dir, "customer"), "c_custkey", 4326).write.parquet(f"{source}/customer")
    _points(table(spark, sf_dir, "supplier"), "s_suppkey", 3857, scale=100000).write.parquet(f"{source}/supplier")
    layer = "struct<id:int,name:string,url:string,description:string,tags:array<string>>"
    schema = f"id string, title string, description string, tags array<string>, layers array<{layer}>"
    items = [
        ("a", "Tables", "<p>Plain <b>tables</b></p>", ["x.y"], [
            (0, "Nation (all)", f"{source}/nation", "<p>Nations</p>", ["n"]),
            (1, None, f"{source}/region", None, None),
            (2, "Missing", f"{source}/missing", None, None),
        ]),
        ("b", "Points", None, None, [
            (0, "Customer-Points", f"{source}/customer", None, ["c"]),
            (None, "Supplier Points", f"{source}/supplier", None, None),
        ]),
        ("c", "Nothing", None, None, None),
    ]
    # Projections differ between engines in their last digits.
    result = gf.layer_ingest(spark.createDataFrame(items, schema), target, log_path=log_path, prefix="in", decimals=9)
    return result, gf.ingest_log(spark, log_path), target


@check(
    "layer_ingest",
    """
    select * from (values
        ('in_nation_all', 'Complete', (select count(*) from nation), cast(null as integer), 'Complete'),
        ('in_region', 'Complete', (select count(*) from region), null, 'Complete'),
        ('in_missing', 'Failed', null, null, 'Failed'),
        ('in_customer_points', 'Complete', (select count(*) from customer), 4326, 'Complete'),
        ('in_supplier_points', 'Complete', (select count(*) from supplier), 4326, 'Complete')
    ) as t(table_name, status, row_count, wkid, logged_status)
    """,
)
def layer_ingest(spark, sf_dir):
    result, log, _ = _ingested(spark, sf_dir)
    logged = log.select("target_path", F.col("status").alias("logged_status"))
    return result.join(logged, "target_path").select(
        F.element_at(F.split("target_path", "/"), -1).alias("table_name"), "status", "row_count", "wkid", "logged_status"
    )


_SX, _SY = longitude_sql("s_suppkey"), latitude_sql("s_suppkey")
_SLON = number_sql(f"degrees({_SX} * 100000 / {EARTH_RADIUS})")
_SLAT = number_sql(f"degrees(2 * atan(exp({_SY} * 100000 / {EARTH_RADIUS})) - pi() / 2)")


@check(
    "layer_ingest_rows",
    f"""
    select c_custkey as key, c_name as name, 'POINT (' || {number_sql(X)} || ' ' || {number_sql(Y)} || ')' as geometry_wkt from customer
    union all
    select s_suppkey, s_name, 'POINT (' || {_SLON} || ' ' || {_SLAT} || ')' from supplier
    """,
)
def layer_ingest_rows(spark, sf_dir):
    """The rows of the two layers of points, as they stand in their tables."""
    _, _, target = _ingested(spark, sf_dir)
    customer = spark.read.parquet(f"{target}/in_customer_points").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "geometry_wkt"
    )
    supplier = spark.read.parquet(f"{target}/in_supplier_points").select("s_suppkey", "s_name", "geometry_wkt")
    return customer.union(supplier)


def _description_sql(name: str, item: str, text: str) -> str:
    """A table's description without a geometry."""
    labels = ["Geometry Column", "Spatial Reference WKID", "Spatial Reference WKT", "Spatial Reference is Projected", "Spatial Reference Units", "Spatial Reference Name"]
    lines = [f"'# Table Name : {name}'", f"'- ArcGIS Online ID: `{item}`'", f"'- Description: ' || {text}", "'- Spatial Reference Properties:'"]
    return " || ".join(f"{line} || chr(10)" for line in [*lines, *[f"'    - {label} : None'" for label in labels]])


def _tables(spark, sf_dir, *names):
    """Some of the tables, written as layers; the folder."""
    source = new_folder(spark, "layers")
    for name in names:
        table(spark, sf_dir, name).write.parquet(f"{source}/{name}")
    return source


@check(
    "layer_ingest_bare",
    f"""
    select * from (values
        ('nation', 'Complete', (select count(*) from nation), '', {_description_sql("nation", "1", "''")}, 'Complete'),
        ('region', 'Complete', (select count(*) from region), '', {_description_sql("region", "1", "''")}, 'Complete'),
        ('lines', 'Complete', (select count(*) from lineitem), '', {_description_sql("lines", "2", "''")}, 'Complete'),
        (null, 'Failed', null, '', null, 'Failed')
    ) as t(table_name, status, row_count, tags, description, logged_status)
    """,
)
def layer_ingest_bare(spark, sf_dir):
    """Layers that have an id, a name and a URL, and items that have no more than an id; one layer's name has no letter."""
    source, target, log_path = _tables(spark, sf_dir, "nation", "region", "lineitem"), new_folder(spark, "tables"), new_folder(spark, "ingest-log")
    items = [
        (1, [(0, "Nation", f"{source}/nation"), (1, None, f"{source}/region")]),
        (2, [(None, "Lines", f"{source}/lineitem"), (3, "---", f"{source}/nation")]),
        (3, []),
    ]
    found = gf.layer_ingest(spark.createDataFrame(items, "id int, layers array<struct<id:int,name:string,url:string>>"), target, log_path=log_path)
    logged = gf.ingest_log(spark, log_path).select("target_path", F.col("status").alias("logged_status"))
    named = F.nullif(F.regexp_extract("target_path", "/([a-z]+)$", 1), F.lit(""))
    return found.join(logged, "target_path").select(
        named.alias("table_name"), "status", "row_count", F.array_join("tags", "|").alias("tags"),
        F.when(named.isNotNull(), F.col("description")).alias("description"), "logged_status",
    )


@check(
    "layer_ingest_text_tags",
    f"""
    select * from (values
        ('nation', 'Complete', (select count(*) from nation), 'a_b|world', {_description_sql("nation", "x", "'Nations'")}),
        ('region', 'Complete', (select count(*) from region), 'world', {_description_sql("region", "x", "''")}),
        ('supplier', 'Complete', (select count(*) from supplier), 's', {_description_sql("supplier", "y", "''")})
    ) as t(table_name, status, row_count, tags, description)
    """,
)
def layer_ingest_text_tags(spark, sf_dir):
    """Tags that are one text, of the items and of the layers, and layers without an id."""
    source, target = _tables(spark, sf_dir, "nation", "region", "supplier"), new_folder(spark, "tables")
    items = [
        ("x", "world", [("Nation", f"{source}/nation", "a.b", "Nations"), ("Region", f"{source}/region", "", None)]),
        ("y", None, [(None, f"{source}/supplier", "s", None)]),
    ]
    schema = "id string, tags string, layers array<struct<name:string,url:string,tags:string,description:string>>"
    found = gf.layer_ingest(spark.createDataFrame(items, schema), target)
    return found.select(
        F.element_at(F.split("target_path", "/"), -1).alias("table_name"), "status", "row_count", F.array_join("tags", "|").alias("tags"), "description"
    )
