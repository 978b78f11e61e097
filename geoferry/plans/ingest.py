"""Many layers into tables: enumerate, read, reproject, turn into WKT, write, describe, tag, log."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from datetime import UTC, datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from geoferry.fixed_values import COMPLETE, FAILED, PENDING, READ, WKT_COLUMN
from geoferry.functions.geometry import geometry_field, srid_of
from geoferry.functions.markdown import html_to_markdown
from geoferry.functions.text import clean_table_name, compose_description, normalize_tags, quoted, tag_array
from geoferry.operators.logs import ingest_log_rows
from geoferry.operators.registry import enumerate_layers, property_of
from geoferry.operators.spatial import geometry_as_wkt, reproject, spatial_reference_info
from geoferry.operators.upsert import current_state
from geoferry.sources.layers import is_path, layer_read
from geoferry.sources.tables import append, overwrite_merge_schema
from geoferry.workspace import drop_staged, new_folder, observed, stage

_logger = logging.getLogger(__name__)

_SEQUENCE = "sequence"
#: The longest name of a table, as cleaned names have it.
NAME_LENGTH = 255
_KEY = "layer_key"
#: What the driver keeps of a layer while it is worked on.
_NAMED = ["item_id", "sublayer_id", "layer_url", "layer_name", "target_path"]
#: Outcomes that the driver gathers before they are written.
OUTCOMES = 500

Reader = Callable[[SparkSession, str], DataFrame]


class Outcome(NamedTuple):
    """A layer as it was planned, how far it came and when: moments are microseconds since 1970."""

    layer_key: int
    item_id: str | None
    sublayer_id: str | None
    layer_url: str | None
    layer_name: str | None
    target_path: str
    started: int
    read_status: str
    read_error: str | None
    read_at: int
    status: str
    error_message: str | None
    ended_at: int
    geometry_column: str | None
    wkid: int | None
    row_count: int | None
    n_without_image: int | None


_OUTCOME = (
    f"{_KEY} bigint, item_id string, sublayer_id string, layer_url string, layer_name string, target_path string, "
    "started bigint, read_status string, read_error string, read_at bigint, status string, error_message string, "
    "ended_at bigint, geometry_column string, wkid int, row_count bigint, n_without_image bigint"
)


def ingest_log(spark: SparkSession, log_path: str) -> DataFrame:
    """Current state of an ingest log: the latest row of each attempt."""
    return current_state(layer_read(spark, log_path), ["layer_attempt_id"], _SEQUENCE)


def plan_layers(items: DataFrame, target: str, prefix: str | None = None, postfix: str | None = None) -> DataFrame:
    """The layers of the items with the table each goes to, its attempt's start, description and tags.

    Only ``id`` and ``layers`` are needed; descriptions may be missing, and tags be missing, one text or an array. A
    layer that can't have a table has its ``problem`` named, and a path of its own that no table can have.
    """
    named = clean_table_name(
        F.col("layer_name"),
        None if prefix is None else F.lit(prefix),
        None if postfix is None else F.lit(postfix),
    )
    root = F.lit(target.rstrip("/") + ("/" if is_path(target) else "."))
    keep = [field.name for field in items.schema.fields if field.name.lower() in ("description", "tags")]
    layers = enumerate_layers(items, keep).where("has_layers")
    of_item = lambda name: property_of(items.schema, name)
    of_layer = lambda name: property_of(layers.schema["layer"].dataType, name, "layer")
    mark = F.concat(F.lit("?"), F.md5(F.concat_ws("|", F.col(_KEY).cast("string"), "item_id", "sublayer_id", "layer_url")))
    nameless = F.concat(F.lit("no table name is left of layer "), F.coalesce("layer_name", F.lit("None")))
    problem = F.when(named == "", nameless).when(F.col("layer_url").isNull(), F.lit("the layer has no URL"))
    return layers.withColumn(_KEY, F.monotonically_increasing_id()).select(
        _KEY,
        "item_id",
        "sublayer_id",
        "layer_name",
        "layer_url",
        named.alias("table_name"),
        F.concat(root, F.when(F.coalesce(named, F.lit("")) == "", mark).otherwise(named)).alias("target_path"),
        F.coalesce(problem, F.when(named.isNull(), nameless)).alias("problem"),
        F.current_timestamp().alias("started"),
        html_to_markdown(of_layer("description")[0].cast("string")).alias("layer_text"),
        html_to_markdown(of_item("description")[0].cast("string")).alias("parent_text"),
        normalize_tags(tag_array(*of_item("tags")), tag_array(*of_layer("tags"))).alias("tags"),
    )


def _check_names(layers: DataFrame, on_collision: str) -> tuple[DataFrame, str | None]:
    """Two layers must not share a table: raise, or tell them apart by a hash of where they come from.

    Gives the path of the table that was staged for it, too.
    """
    able = layers.where("problem is null")
    shared = able.groupBy("target_path").count().where(F.col("count") > 1).select("target_path")
    clash = shared.first()
    if not clash:
        return layers, None
    if on_collision == "raise":
        raise ValueError(f"several layers would be written to {clash.target_path}")
    source = ["item_id", "sublayer_id", "layer_url"]
    same = F.row_number().over(Window.partitionBy("target_path", *source).orderBy("layer_name"))
    mark = F.concat(F.lit("_"), F.substring(F.md5(F.concat_ws("|", *source, same.cast("string"))), 1, 8))
    tagged = layers.join(shared.withColumn("__shared", F.lit(True)), "target_path", "left").withColumn("__mark", mark)
    name = F.concat(F.substring("table_name", 1, NAME_LENGTH - 9), "__mark")
    folder = F.left("target_path", F.char_length("target_path") - F.char_length("table_name"))
    apart = tagged.withColumns(
        {
            "table_name": F.when(F.col("__shared"), name).otherwise(F.col("table_name")),
            "target_path": F.when(F.col("__shared"), F.concat(folder, name)).otherwise(F.col("target_path")),
        }
    ).select(*layers.columns)
    apart, path = stage(apart, "layer-names")
    left = apart.where("problem is null").groupBy("target_path").count().where(F.col("count") > 1).first()
    if left:
        raise ValueError(f"several layers would still be written to {left.target_path}")
    return apart, path


def _sql_text(text: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _set_properties(spark: SparkSession, table: str, description: str, tags: Iterable[str]) -> None:
    name = ".".join(f"`{part}`" for part in table.split("."))
    values = {"comment": description, "tags": ",".join(tags)}
    pairs = ", ".join(f"{_sql_text(key)} = {_sql_text(value)}" for key, value in values.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def layer_ingest(
    items: DataFrame,
    target: str,
    output_srid: int = 4326,
    log_path: str | None = None,
    prefix: str | None = None,
    postfix: str | None = None,
    reader: Reader = layer_read,
    load_id: str | None = None,
    on_collision: str = "raise",
    max_workers: int = 4,
    outside: str = "raise",
    decimals: int | None = None,
) -> DataFrame:
    """Write every layer of the items to a table of its own.

    ``target`` is a catalog schema, or a folder if its name holds a slash. Each layer is read from its URL
    by ``reader``, reprojected, given WKT text for its geometry, and replaces its table with the schema
    merged, and its rows are counted, all in one step. A layer that fails, also one without a name that a table could
    have, is logged as such and does not stop the others. Returns one row per layer: ``target_path, status,
    row_count, error_message, item_id, layer_name, geometry_column, wkid, n_without_image, description, tags``.

    A geometry that has no image in the output's spatial reference fails its layer, or with ``outside="null"`` becomes
    null and is counted. WKT has all digits, or ``decimals`` of them.

    The driver streams over the planned layers: it holds those at work, twice ``max_workers``, and the outcomes not
    yet written, at most ``OUTCOMES``, which then go to a table and, as the two last phases, to the log. The rows of the
    layers stay on the executors. Catalog tables get their description and tags as properties.
    """
    if on_collision not in ("raise", "suffix"):
        raise ValueError("on_collision is raise or suffix")
    spark = items.sparkSession
    load_id = load_id or str(uuid.uuid4())
    # Staged, so that the attempts keep the start, and with it the id, they were given.
    planned, *paths = stage(plan_layers(items, target, prefix, postfix), "layers")
    layers, renamed = _check_names(planned, on_collision)
    outcomes_path = new_folder(spark, "outcomes")
    paths += [path for path in (renamed, outcomes_path) if path]

    def log(entries: DataFrame, *phases: tuple[int, str | Column, Column | None, Column]) -> None:
        if log_path:
            for phase, status, error, moment in phases:
                rows = ingest_log_rows(entries, load_id, status, error, moment).withColumn(_SEQUENCE, F.lit(phase).cast("bigint"))
                append(rows, log_path)

    def save(found: list[Outcome]) -> None:
        rows = spark.createDataFrame(found, _OUTCOME)
        append(rows.coalesce(1), outcomes_path)
        moments = {name: F.timestamp_micros(name) for name in ("started", "read_at", "ended_at")}
        log(
            rows.withColumns(moments).coalesce(1),
            (2, F.col("read_status"), F.col("read_error"), F.col("read_at")),
            (3, F.col("status"), F.col("error_message"), F.col("ended_at")),
        )

    log(layers, (1, PENDING, None, F.col("started")))
    wanted = layers.select(_KEY, *_NAMED, F.unix_micros("started").alias("started"), "problem").toLocalIterator()
    found: list[Outcome] = []
    for outcome in _worked(lambda row: _ingest_layer(spark, row, reader, output_srid, outside, decimals), wanted, max_workers):
        found.append(outcome)
        if len(found) >= OUTCOMES:
            save(found)
            found = []
    save(found)

    finished = layers.drop("started").join(
        spark.read.schema(_OUTCOME).parquet(outcomes_path).drop(*_NAMED, "started"), _KEY
    )
    references = spatial_reference_info(finished.select(F.col(_KEY).alias("layer"), "geometry_column", "wkid"))
    details = {name: F.col(f"sr.{name}") for name in references.columns if name != "layer"}
    described = finished.alias("f").join(references.alias("sr"), F.col(f"f.{_KEY}") == F.col("sr.layer")).select(
        "target_path",
        "status",
        "row_count",
        "error_message",
        "item_id",
        "layer_name",
        "f.geometry_column",
        "f.wkid",
        "n_without_image",
        compose_description(
            F.col("table_name"), F.col("item_id"), F.col("layer_text"), F.col("parent_text"), details
        ).alias("description"),
        "tags",
    )
    result, _ = stage(described, "ingested")
    for path in paths:
        drop_staged(spark, path)
    if not is_path(target):
        for row in result.where(quoted("status") == COMPLETE).toLocalIterator():
            _set_properties(spark, row.target_path, row.description, row.tags)
    return result


def _worked(work: Callable[[Row], Outcome], rows: Iterable[Row], workers: int) -> Iterator[Outcome]:
    """The outcomes of some threads, in the order they come; rows are taken only as threads get free."""
    with ThreadPoolExecutor(workers) as pool:
        running: set[Future] = set()
        for row in rows:
            running.add(pool.submit(work, row))
            if len(running) >= 2 * workers:
                ended, running = wait(running, return_when=FIRST_COMPLETED)
                yield from (future.result() for future in ended)
        yield from (future.result() for future in running)


def _nulls(column: str | None) -> dict[str, Column]:
    return {"nulls": F.count_if(quoted(column).isNull())} if column else {}


def _now() -> int:
    return int(datetime.now(UTC).timestamp() * 1_000_000)


def _ingest_layer(
    spark: SparkSession, row: Row, reader: Reader, output_srid: int, outside: str = "raise", decimals: int | None = None
) -> Outcome:
    """Read, reproject, write and count one layer."""
    planned = [row[name] for name in (_KEY, *_NAMED, "started")]

    def failed(error: str, read: tuple[str, str | None, int] | None = None, place: tuple = (None, None)) -> Outcome:
        _logger.error("%s: %s", row.target_path, error)
        return Outcome(*planned, *(read or (FAILED, error, _now())), FAILED, error, _now(), *place, None, None)

    if row.problem:
        return failed(row.problem)
    try:
        source = reader(spark, row.layer_url)
        field = geometry_field(source.schema)
        source, had = observed(source, **_nulls(field and field.name))
        df = reproject(source, output_srid, outside=outside)
        field = geometry_field(df.schema)
        place = (field.name, srid_of(field)) if field else (None, None)
    except Exception as error:
        return failed(str(error))
    read = (READ, None, _now())
    try:
        text = geometry_as_wkt(df, place[0], decimals)
        rows, has = observed(text, **_nulls(field and WKT_COLUMN))
        overwrite_merge_schema(rows, row.target_path)
        after, before = has(), had() if field else None
        # Where the job's counts are lost, the footers of the new files have the rows.
        n = after["n"] if after else layer_read(spark, row.target_path, columns=[]).count()
        lost = after["nulls"] - before["nulls"] if after and before else None
        return Outcome(*planned, *read, COMPLETE, None, _now(), *place, n, lost)
    except Exception as error:
        return failed(str(error), read, place)
