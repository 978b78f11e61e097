"""The registry of services as a stored table, and making what an export needs in it.

The table only grows: a row is one version of a service, and the latest one counts. A target is a folder, or a catalog
table if its name holds no slash.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoferry.operators.joins import join_to_grouped, key_names
from geoferry.operators.registry import find_service, services_to_create
from geoferry.operators.upsert import current_state
from geoferry.sources.layers import layer_read
from geoferry.sources.tables import append, existing_schema
from geoferry.workspace import drop_staged, stage

_ENTRY = "array<struct<id:int,name:string,url:string>>"
_SERVICE = (
    f"id string, title string, type string, owner string, url string, description string, tags array<string>, layers {_ENTRY}, tables {_ENTRY}"
)
_VERSION = "version"


def read_registry(spark: SparkSession, registry: str) -> DataFrame:
    """The services as they are now; none if nothing has been registered yet."""
    if existing_schema(spark, registry) is None:
        return spark.createDataFrame([], _SERVICE)
    return current_state(layer_read(spark, registry), ["id"], _VERSION)


def _lookup(services: DataFrame, wanted: DataFrame, owner: str | None) -> DataFrame:
    """Each wanted ``name, layer_name`` with its service's and its layer's id and URL, null where there is none."""
    of_service = find_service(services, wanted, owner).select("name", "layer_name", F.col("id").alias("service_id"), F.col("url").alias("service_url"))
    none = F.array().cast(_ENTRY)
    listed = F.concat(*[F.coalesce(F.col(name).cast(_ENTRY), none) for name in ("layers", "tables")])
    entries = services.select("id", F.explode(listed).alias("entry"))
    keys = ["service_id", "layer_name"]
    service, layer = key_names(keys)
    first = entries.groupBy(F.col("id").alias(service), F.col("entry.name").alias(layer)).agg(
        F.min("entry.id").alias("layer_id"), F.min_by("entry.url", "entry.id").alias("layer_url")
    )
    return join_to_grouped(of_service, first, keys, "left").select("name", "layer_name", "service_id", "service_url", "layer_id", "layer_url")


def find_layers(spark: SparkSession, registry: str, wanted: DataFrame, owner: str | None = None) -> DataFrame:
    """Where each wanted layer (``name`` of the service, ``layer_name``) is: ``service_id, service_url, layer_id,
    layer_url``. Names are matched as they are; layers come before tables of one name."""
    return _lookup(read_registry(spark, registry), wanted, owner)


def ensure_layers(
    spark: SparkSession,
    registry: str,
    wanted: DataFrame,
    root: str = "services",
    owner: str | None = None,
    summary: str | None = None,
    tags: list[str] | None = None,
) -> DataFrame:
    """As ``find_layers``, after services and layers that were not there have been registered.

    What the registry should hold is compared with what it holds, and only services that differ get a new version:
    asking again changes nothing, not even a file. A new service's id follows from its owner and name, so that a call
    that broke off, or one beside it, makes the same service. New layers take the next free numbers, in the order of
    their names. A null ``layer_name`` asks for the service alone. Two calls that add layers to one service at the same
    time can lose one's layers, which the next call adds again.
    """
    wanted, wanted_path = stage(wanted.select("name", "layer_name").where("name is not null").distinct(), "wanted")
    services, services_path = stage(read_registry(spark, registry).select(*[name.split()[0] for name in _SERVICE.split(", ")]), "services")
    found = find_service(services, wanted.select("name").distinct(), owner)
    made = services_to_create(found, summary, tags, owner)
    identity = F.md5(F.concat_ws("|", "type", F.coalesce("owner", F.lit("")), "title"))
    none = F.array().cast(_ENTRY)
    new = made.withColumns({"id": identity, "layers": none, "tables": none}).withColumn("url", F.concat(F.lit(root.rstrip("/") + "/"), F.col("id")))
    (service,) = key_names(["id"])
    asked = found.where("found").select(F.col("id").alias(service)).distinct()
    known = join_to_grouped(services, asked, ["id"], "left_semi")
    before = known.select(*services.columns, F.lit(False).alias("__new")).unionByName(new.select(*services.columns, F.lit(True).alias("__new")))

    (title,) = key_names(["title"])
    names = wanted.groupBy(F.col("name").alias(title)).agg(F.array_sort(F.collect_set("layer_name")).alias("__names"))
    both = join_to_grouped(before, names, ["title"], "inner")
    entries = F.concat(F.coalesce("layers", none), F.coalesce("tables", none))
    missing = F.array_except("__names", F.transform(entries, lambda entry: entry["name"]))
    free = F.coalesce(F.array_max(F.transform(entries, lambda entry: entry["id"])), F.lit(-1)) + 1
    counted = both.withColumns({"__missing": missing, "__free": free})

    def entry(name, place):
        number = F.col("__free") + place
        return F.struct(number.alias("id"), name.alias("name"), F.concat("url", F.lit("/"), number.cast("string")).alias("url"))

    added = F.transform("__missing", entry).cast(_ENTRY)
    after = counted.withColumn("layers", F.concat(F.coalesce("layers", none), added)).where(F.col("__new") | (F.size("__missing") > 0))
    changes, changes_path = stage(after.select(*services.columns), "changes")
    if not changes.isEmpty():
        append(changes.withColumn(_VERSION, F.lit(time.time_ns())).coalesce(1), registry)
    for path in (services_path, changes_path):
        drop_staged(spark, path)
    places, _ = stage(find_layers(spark, registry, wanted, owner), "places")
    drop_staged(spark, wanted_path)
    return places
