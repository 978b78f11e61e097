import datetime

import pytest
from pyspark.sql import functions as F

import geoferry as gf
from conftest import SF_DIR, plan_of
from geoferry.functions import geometry as g


def test_filter_and_columns_reach_the_scan(spark):
    df = gf.layer_read(spark, f"{SF_DIR}/lineitem.parquet", columns=["l_orderkey"], where="l_returnflag = 'A'")
    plan = plan_of(df)
    assert "EqualTo(l_returnflag,A)" in plan and "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan
    assert df.columns == ["l_orderkey"]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats(spark, folder, fmt):
    target = folder()
    spark.range(5).withColumn("s", F.lit("x")).write.format(fmt).save(target)
    df = gf.layer_read(spark, target, fmt, ["id"], F.col("id") > 2, schema="id bigint, s string")
    assert sorted(row.id for row in df.collect()) == [3, 4]


def test_schema_union_on_overwrite(spark, folder):
    target = folder()
    gf.overwrite_merge_schema(spark.range(2).withColumn("x", F.lit(1)), target)
    gf.overwrite_merge_schema(spark.range(3).withColumn("y", F.lit("a")), target)
    df = spark.read.parquet(target)
    assert df.columns == ["id", "x", "y"] and df.count() == 3
    assert df.where("x is null and y = 'a'").count() == 3
    gf.overwrite_merge_schema(spark.range(1).withColumn("X", F.lit(5)), target)
    assert [tuple(row) for row in spark.read.parquet(target).collect()] == [(0, 5, None)]


def test_type_clash_raises_and_keeps_the_table(spark, folder):
    target = folder()
    gf.overwrite_merge_schema(spark.range(2), target)
    with pytest.raises(ValueError, match="id was bigint and is string"):
        gf.overwrite_merge_schema(spark.range(2).select(F.col("id").cast("string")), target)
    assert spark.read.parquet(target).count() == 2


def test_catalog_tables(spark):
    spark.sql("create database if not exists layers")
    gf.overwrite_merge_schema(spark.range(2).withColumn("x", F.lit(1)), "layers.merged")
    gf.overwrite_merge_schema(spark.range(3).withColumn("y", F.lit(1)), "layers.merged")
    assert spark.table("layers.merged").columns == ["id", "x", "y"] and spark.table("layers.merged").count() == 3
    gf.append(spark.range(2), "layers.log")
    gf.append(spark.range(3), "layers.log")
    assert gf.layer_read(spark, "layers.log", where="id < 1").count() == 2


@pytest.mark.parametrize("catalog", [False, True])
def test_a_failed_overwrite_keeps_the_old_rows(spark, folder, catalog):
    target = "kept_rows" if catalog else folder()
    gf.overwrite_merge_schema(spark.range(50), target)
    bad = spark.range(50).select(F.when(F.col("id") < 40, F.col("id")).otherwise(F.raise_error("no").cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="no"):
        gf.overwrite_merge_schema(bad, target)
    assert gf.layer_read(spark, target).count() == 50
    with pytest.raises(Exception, match="no"):
        gf.chunked_write(bad, target if not catalog else folder(), 10, order_by=["id"])
    gf.overwrite_merge_schema(gf.layer_read(spark, target).where("id < 7"), target)
    assert gf.layer_read(spark, target).count() == 7


def test_append_creates_then_adds(spark, folder):
    target = folder()
    gf.append(spark.range(2), target)
    gf.append(spark.range(3), target)
    assert spark.read.parquet(target).count() == 5


TYPES = {
    "SmallInteger": "bigint", "Integer": "bigint", "OID": "bigint", "Single": "double", "Double": "double",
    "String": "string", "GlobalID": "string", "GUID": "string", "XML": "string", "Blob": "binary", "Raster": "binary",
    "Geometry": "binary", "Date": "date",
}


def test_every_field_type(spark):
    df = spark.range(1).select(*[F.lit("2024-01-02" if n == "Date" else "7").alias(n) for n in TYPES], F.lit(1).alias("more"))
    fields = [{"name": n, "type": f"esriFieldType{n}"} for n in reversed(TYPES)]
    out = gf.conform_schema(df, fields)
    assert out.columns == [*reversed(TYPES), "more"]
    assert {name: kind for name, kind in out.dtypes if name != "more"} == TYPES
    assert out.first().Integer == 7
    assert gf.conform_schema(out, fields).collect() == out.collect()


def test_names_case_extra_and_missing_fields(spark):
    df = spark.createDataFrame([("1", 2.9, True)], "a string, b double, c boolean")
    fields = [{"name": n, "type": "esriFieldTypeInteger"} for n in ("b", "A", "zz", "b")]
    out = gf.conform_schema(df, fields)
    assert out.columns == ["b", "a", "c"] and tuple(out.first()) == (2, "1", True)


def test_strict_raises_and_lenient_gives_null(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    fields = [{"name": "a", "type": "esriFieldTypeInteger"}]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        gf.conform_schema(df, fields).collect()
    assert [row.a for row in gf.conform_schema(df, fields, strict=False).collect()] == [1, None]


def test_dates_geometry_and_binary(spark):
    moment = datetime.datetime(2024, 5, 6, 7, 8, 9)
    df = spark.createDataFrame([(moment, 12)], "d timestamp, n int").withColumn(
        "g", g.with_srid(g.point(F.lit(1), F.lit(2)), "g", 4326)
    )
    fields = [{"name": n, "type": f"esriFieldType{t}"} for n, t in (("d", "Date"), ("n", "Blob"), ("g", "Geometry"))]
    out = gf.conform_schema(df, fields)
    row = out.first()
    assert row.d == moment.date() and bytes(row.n) == b"12"
    assert g.is_geometry(out.schema["g"].dataType) and g.srid_of(out.schema["g"]) == 4326
    assert gf.conform_schema(df, fields, keep_time_of_day=True).first().d == moment


def test_stringify_keeps_order_and_nulls(spark):
    df = spark.createDataFrame([(1, None, True, 1.5)], "b int, a string, c boolean, d double")
    out = gf.stringify_columns(df)
    assert out.columns == df.columns and tuple(out.first()) == ("1", None, "true", "1.5")


def test_structs_gain_fields_at_any_depth(spark, folder):
    target = folder()
    first = "named_struct('a', 1, 'in', named_struct('x', 1.5D)) as s, array(named_struct('p', 'q')) as l, map('k', named_struct('u', 1)) as m"
    second = "named_struct('IN', named_struct('y', 'new', 'x', 2.5D), 'b', true) as s, array(named_struct('r', 7), null) as l, map('k', named_struct('v', 2)) as m"
    gf.overwrite_merge_schema(spark.sql(f"select id, {first} from range(1)"), target)
    gf.overwrite_merge_schema(spark.sql(f"select id, {second} from range(2)").withColumn("s", F.when(F.col("id") == 0, F.col("s"))), target)
    table = spark.read.parquet(target).orderBy("id")
    assert dict(table.dtypes) == {
        "id": "bigint", "s": "struct<a:int,in:struct<x:double,y:string>,b:boolean>", "l": "array<struct<p:string,r:int>>", "m": "map<string,struct<u:int,v:int>>"
    }
    row, other = table.collect()
    assert row.s.asDict(True) == {"a": None, "in": {"x": 2.5, "y": "new"}, "b": True} and other.s is None
    assert [item and item.asDict() for item in row.l] == [{"p": None, "r": 7}, None] and row.m["k"].asDict() == {"u": None, "v": 2}
    # A third overwrite keeps what it lacks, and its own order of fields changes nothing.
    gf.overwrite_merge_schema(spark.range(1).selectExpr("named_struct('b', false) as s"), target)
    table = spark.read.parquet(target)
    assert table.columns == ["id", "s", "l", "m"] and table.first().s.asDict(True) == {"a": None, "in": None, "b": False}


@pytest.mark.parametrize("value, was, now, where", [
    ("named_struct('in', named_struct('x', 'text')) as s", "double", "string", "s.in.x"),
    ("named_struct('in', 5) as s", "struct<x:double>", "int", "s.in"),
    ("array(named_struct('p', 1)) as l", "string", "int", "l.element.p"),
    ("map(1, named_struct('u', 1)) as m", "map<string,struct<u:int>>", "map<int,struct<u:int>>", "m"),
    ("map('k', named_struct('u', 'x')) as m", "int", "string", "m.value.u"),
])
def test_a_clash_of_types_inside_raises(spark, folder, value, was, now, where):
    target = folder()
    gf.overwrite_merge_schema(spark.range(1).selectExpr("named_struct('in', named_struct('x', 1.5D)) as s", "array(named_struct('p', 'q')) as l", "map('k', named_struct('u', 1)) as m"), target)
    with pytest.raises(ValueError, match=f"column {where} was {was} and is {now}".replace("<", "[<]")):
        gf.overwrite_merge_schema(spark.range(1).selectExpr(value), target)
    assert spark.read.parquet(target).count() == 1
