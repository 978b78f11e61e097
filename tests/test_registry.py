from geoferry import enumerate_layers, find_service, service_layers, services_to_create

LAYERS = "array<struct<id:int,name:string,url:string>>"
SCHEMA = f"id string, title string, type string, owner string, url string, layers {LAYERS}, tables {LAYERS}"


def services(spark):
    rows = [
        ("2", "Roads", "Feature Service", "ann", "u/2", [(0, "L0", "u/2/0"), (1, None, "u/2/1")], [(2, "T", "u/2/2")]),
        ("1", "Roads", "Feature Service", "bob", "u/1", None, None),
        ("3", "roads", "Feature Service", "ann", "u/3", [], [(0, "T3", "u/3/0")]),
        ("0", "Roads", "Web Map", "ann", "u/0", [(None, None, "u/0/layer")], None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_lookup(spark):
    found = find_service(services(spark), names(spark, "Roads", "Rivers", None))
    assert {tuple(row) for row in found.collect()} == {
        ("Roads", True, "u/1", "1"),
        ("Rivers", False, None, None),
        (None, False, None, None),
    }
    by_owner = find_service(services(spark), names(spark, "Roads"), owner="ann").first()
    assert (by_owner.url, by_owner.id) == ("u/2", "2")


def test_missing_services(spark):
    found = find_service(services(spark), names(spark, "Rivers", "Rivers", "Roads"))
    rows = services_to_create(found).collect()
    assert [tuple(row) for row in rows] == [
        ("Rivers", "Feature Service", None, "Service for Rivers", ["automated_creation"])
    ]
    row = services_to_create(found, summary="mine", tags=["a"]).first()
    assert (row.description, row.tags) == ("mine", ["a"])


def test_layers_before_tables(spark):
    found = service_layers(services(spark)).orderBy("service_id", "position").collect()
    assert [tuple(row) for row in found] == [
        ("0", 0, None, None), ("2", 0, "L0", 0), ("2", 1, None, 1), ("2", 2, "T", 2), ("3", 0, "T3", 0)
    ]


def test_enumeration(spark):
    found = enumerate_layers(services(spark), keep=["title"]).drop("layer").collect()
    assert {tuple(row) for row in found} == {
        ("2", True, "0", "L0", "u/2/0", "Roads"),
        ("2", True, "1", "1", "u/2/1", "Roads"),
        ("1", False, None, None, None, "Roads"),
        ("3", False, None, None, None, "roads"),
        ("0", True, "N/A", "layer", "u/0/layer", "Roads"),
    }
