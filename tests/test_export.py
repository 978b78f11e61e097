import time

import pytest
from pyspark.sql import functions as F

import geoferry as gf
from conftest import plan_of
from geoferry.operators import chunks
from geoferry.plans.export import write_partitions


@pytest.fixture
def rows(spark):
    """Batches of 40, 30, 20 and 10 rows: a code, a path, the empty string and null."""
    return spark.range(100).select(
        "id", F.expr("case when id < 40 then '01001' when id < 70 then 'a/b=c' when id < 90 then '' end").alias("b")
    )


COUNTS = {"01001": 40, "a/b=c": 30, "": 20, None: 10}


def export(rows, target, **options):
    settings = {"service": "svc", "chunk_rows": 15, "order_by": ["id"], "retry_delay_seconds": 0, "timeout_minutes": None}
    return gf.batch_export(rows, target, "b", **{**settings, **options})


def counts(spark, target, rows):
    found = gf.read_export(spark, target, rows.schema)
    assert found.select("id").distinct().count() * found.select("run_id").distinct().count() == found.count()
    return {row.b: row["count"] for row in found.groupBy("b").count().collect()}


def log_of(spark, path):
    return {row.batch: row for row in gf.batch_log(spark, path).collect()}


def failing(times, batches, crash=False):
    """A sink that loses some batches on its first attempts."""

    def sink(rows, target, overwrite, attempt):
        if attempt <= times:
            key = F.coalesce(F.col("b"), F.lit("null"))
            write_partitions(rows.where(~key.isin(batches)), target, overwrite, attempt)
            if crash:
                raise OSError("the service went away")
        else:
            write_partitions(rows, target, overwrite, attempt)

    return sink


def test_overwrite_leaves_exactly_the_frame(spark, rows, folder):
    target = folder()
    assert export(rows.withColumn("id", F.col("id") + 1000), target)
    assert export(rows, target)
    assert counts(spark, target, rows) == COUNTS
    found = gf.read_export(spark, target, rows.schema)
    assert found.agg(F.max("id")).first()[0] == 99
    sizes = [row["count"] for row in found.groupBy("b", "chunk").count().collect()]
    assert max(sizes) == 15 and len(sizes) == 3 + 2 + 2 + 1


def test_append_adds(spark, rows, folder):
    target = folder()
    assert export(rows, target, write_mode="append")
    assert export(rows, target, write_mode="append")
    assert counts(spark, target, rows) == {b: 2 * n for b, n in COUNTS.items()}


@pytest.mark.parametrize("write_mode", ["overwrite", "append"])
@pytest.mark.parametrize("crash", [False, True])
@pytest.mark.parametrize("rows_per_task", [0, 1000])
def test_a_retry_writes_only_what_is_missing(spark, rows, folder, monkeypatch, write_mode, crash, rows_per_task):
    monkeypatch.setattr(chunks, "ROWS_PER_RANGE", 10)
    target, log_path = folder(), folder("log")
    attempts = []
    lossy = failing(2, ["a/b=c", "null"], crash)

    def sink(frame, *rest):
        attempts.append({row.b for row in frame.select("b").distinct().collect()})
        lossy(frame, *rest)

    assert export(rows, target, write_mode=write_mode, sink=sink, log_path=log_path, rows_per_task=rows_per_task)
    assert attempts == [{"01001", "a/b=c", "", None}, {"a/b=c", None}, {"a/b=c", None}]
    assert counts(spark, target, rows) == COUNTS
    log = log_of(spark, log_path)
    assert {b: (row.status, row.retry_attempts) for b, row in log.items()} == {
        "01001": ("Success", 1), "": ("Success", 1), "a/b=c": ("Success", 3), None: ("Success", 3),
    }
    history = spark.read.parquet(log_path).where("batch = 'a/b=c'").orderBy("sequence").collect()
    assert [row.status for row in history] == ["Failed", "Failed", "Success"]
    assert history[0].message == ("the service went away" if crash else "0 of 30 rows written")
    assert history[2].message == "Batch Complete"


def test_a_retry_numbers_only_what_is_missing(spark, rows, folder):
    plans = []
    lossy = failing(1, ["null"])

    def sink(frame, *rest):
        plans.append(plan_of(frame))
        lossy(frame, *rest)

    assert export(rows, folder(), sink=sink)
    first, second = plans
    assert "LeftSemi" not in first
    assert second.index("Window") < second.index("LeftSemi")


def test_giving_up(spark, rows, folder):
    target, log_path = folder(), folder("log")
    started = time.time()
    assert not export(rows, target, sink=failing(9, [""]), max_attempts=2, log_path=log_path, retry_delay_seconds=3)
    assert {b: row.status for b, row in log_of(spark, log_path).items()}[""] == "Failed"
    # One wait between two attempts, none after the last.
    assert started + 3 < time.time()


def test_a_broken_off_run_goes_on(spark, rows, folder):
    target = folder()
    assert not export(rows, target, sink=failing(9, [""]), max_attempts=1, run_id="r1")
    seen = []

    def sink(frame, *rest):
        seen.append(frame.select("b").distinct().collect())
        write_partitions(frame, *rest)

    assert export(rows, target, sink=sink, run_id="r1")
    assert [[row.b for row in batch] for batch in seen] == [[""]]
    assert counts(spark, target, rows) == COUNTS
    assert export(rows, target, sink=sink, run_id="r1") and len(seen) == 1


def test_unfinished_runs_are_not_read(spark, rows, folder):
    target = folder()
    assert export(rows, target)
    assert not export(rows, target, write_mode="append", sink=failing(9, [""]), max_attempts=1)
    assert counts(spark, target, rows) == COUNTS


def test_a_failed_overwrite_leaves_the_earlier_run(spark, rows, folder):
    target = folder()
    assert export(rows, target)

    def sink(*_):
        raise OSError("away")

    assert not export(rows.limit(5), target, sink=sink, max_attempts=2)
    assert counts(spark, target, rows) == COUNTS


def test_runs_on_one_log_do_not_mix(spark, rows, folder):
    target, log_path = folder(), folder("log")

    def sink(frame, path, overwrite, attempt):
        # Another run of the service succeeds while this one lacks a batch.
        write_partitions(frame.where("b = ''") if attempt == 1 else frame, path, overwrite, attempt)
        if attempt == 1:
            assert export(rows, target, write_mode="append", log_path=log_path, run_id="other")

    assert export(rows, target, write_mode="append", sink=sink, log_path=log_path, run_id="mine")
    assert counts(spark, target, rows) == {b: 2 * n for b, n in COUNTS.items()}
    log = spark.read.parquet(log_path).where("status = 'Success'")
    assert {row.run_id: row["count"] for row in log.groupBy("run_id").count().collect()} == {"mine": 4, "other": 4}
    keys = rows.select("b").distinct()
    assert gf.pending_batches(keys, log, "b", "svc", "mine").count() == 0
    assert gf.pending_batches(keys, log, "b", "svc", "third").count() == 4


def test_a_replaced_run_cannot_go_on(spark, rows, folder):
    target = folder()
    assert export(rows, target, run_id="r1") and export(rows, target, run_id="r2")
    with pytest.raises(ValueError, match="replaced"):
        export(rows, target, run_id="r1")


def test_timeout_is_logged(spark, rows, folder):
    target, log_path = folder(), folder("log")
    def sink(frame, path, overwrite, attempt):
        if attempt == 1:
            # Runs far beyond the deadline unless it is cancelled.
            spark.range(10**13).select(F.sum(F.hash("id"))).write.format("noop").mode("overwrite").save()
        write_partitions(frame, path, overwrite, attempt)

    assert export(rows, target, sink=sink, timeout_minutes=0.01, max_attempts=1, log_path=log_path) is False
    assert {row.status for row in log_of(spark, log_path).values()} == {"Timeout"}
    assert export(rows, target, timeout_minutes=5)


def test_empty_frame_writes_nothing(spark, rows, folder):
    from geoferry.workspace import folder_exists

    target = folder()
    assert export(rows.limit(0), target)
    assert not folder_exists(spark, target)


def test_fields_are_conformed(spark, rows, folder):
    target = folder()
    fields = [{"name": "id", "type": "esriFieldTypeString"}]
    assert export(rows, target, fields=fields)
    schema = gf.conform_schema(rows, fields).schema
    assert dict(gf.read_export(spark, target, schema).dtypes)["id"] == "string"


def test_service_lookup(spark, rows, folder):
    services = spark.createDataFrame(
        [("7", "svc", "Feature Service", "ann", "http://x/7")], "id string, title string, type string, owner string, url string"
    )
    log_path = folder("log")
    assert export(rows, folder(), services=services, log_path=log_path)
    assert {(row.layer_id, row.target_server_url) for row in log_of(spark, log_path).values()} == {("7", "http://x/7")}
    with pytest.raises(LookupError):
        export(rows, folder(), services=services, service="other")


def registry_of(spark, path):
    return {row.title: row for row in gf.read_registry(spark, path).collect()}


def test_missing_services_and_layers_are_registered(spark, rows, folder):
    registry, target, log_path = folder("registry"), folder(), folder("log")
    with pytest.raises(LookupError):
        export(rows, target, registry=registry, create_service=False)
    for layer in ("roads", "a b/c", None):
        assert export(rows.where("id < 50") if layer == "roads" else rows, target, layer=layer, registry=registry, log_path=log_path, user="ann")
    [service] = registry_of(spark, registry).values()
    assert (service.title, service.type, service.owner, service.description, service.tags) == (
        "svc", "Feature Service", "ann", "Service for svc", ["automated_creation"]
    )
    assert [(layer.id, layer.name, layer.url) for layer in service.layers] == [(0, "roads", f"{service.url}/0"), (1, "a b/c", f"{service.url}/1")]
    assert sum(counts(spark, gf_target(target, "roads"), rows).values()) == 50
    assert counts(spark, gf_target(target, "a b/c"), rows) == counts(spark, target, rows) == COUNTS
    log = gf.batch_log(spark, log_path)
    assert {row.layer_name: row["count"] for row in log.groupBy("layer_name").count().collect()} == {"roads": 2, "a b/c": 4, None: 4}
    assert {row.layer_id for row in log.collect()} == {service.id}
    keys = rows.select("b").distinct()
    assert [gf.pending_batches(keys, log, "b", "svc", layer=layer).count() for layer in ("roads", "a b/c", None, "other")] == [2, 0, 0, 4]
    assert export(rows, target, layer="roads", registry=registry, create_service=False, user="ann")
    with pytest.raises(LookupError):
        export(rows, target, layer="paths", registry=registry, create_service=False, user="ann")


def gf_target(target, layer):
    from geoferry.plans.export import layer_target

    return layer_target(target, layer)


def test_registering_again_changes_nothing(spark, folder):
    registry = folder("registry")
    wanted = spark.createDataFrame([("s", "b"), ("s", "a"), ("s", "a"), ("t", None), (None, "x")], "name string, layer_name string")
    first = gf.ensure_layers(spark, registry, wanted, owner="ann").collect()
    files = sorted(spark.read.parquet(registry).inputFiles())
    assert gf.ensure_layers(spark, registry, wanted, owner="ann").count() == len(first)
    assert sorted(spark.read.parquet(registry).inputFiles()) == files
    assert sorted(((row.name, row.layer_name, row.layer_id) for row in first), key=str) == [("s", "a", 0), ("s", "b", 1), ("t", None, None)]
    # Another owner's service of that name is another one; a later layer takes the next number.
    gf.ensure_layers(spark, registry, wanted.where("name = 's'"), owner="bob")
    more = gf.ensure_layers(spark, registry, spark.createDataFrame([("s", "0")], "name string, layer_name string"), owner="ann").first()
    assert more.layer_id == 2 and gf.read_registry(spark, registry).count() == 3


def test_layers_beside_registered_tables(spark, folder):
    registry = folder("registry")
    entry = "array<struct<id:int,name:string,url:string>>"
    row = [("7", "svc", "Feature Service", "ann", "http://x/7", "d", ["t"], None, [(4, "old", "http://x/7/4")], 1)]
    schema = f"id string, title string, type string, owner string, url string, description string, tags array<string>, layers {entry}, tables {entry}, version bigint"
    spark.createDataFrame(row, schema).write.parquet(registry)
    wanted = spark.createDataFrame([("svc", "old"), ("svc", "new")], "name string, layer_name string")
    found = {r.layer_name: (r.service_id, r.layer_id, r.layer_url) for r in gf.ensure_layers(spark, registry, wanted).collect()}
    assert found == {"old": ("7", 4, "http://x/7/4"), "new": ("7", 5, "http://x/7/5")}
    assert [name.name for name in registry_of(spark, registry)["svc"].tables] == ["old"]


def test_a_whole_attempt_lists_no_folder(spark, rows, folder, monkeypatch):
    """Rows are counted by the job that writes them; a resumed run reads its manifest."""
    from geoferry.plans import export as plan

    def listing(*_):
        raise AssertionError("the folders of the run were listed")

    monkeypatch.setattr(plan, "_compare", listing)
    many = spark.range(3000).select("id", F.concat(F.lit("k"), F.col("id") % 1000).alias("b"))
    target, log_path = folder(), folder("log")
    assert export(many, target, log_path=log_path, run_id="r1")
    assert gf.batch_log(spark, log_path).where("status = 'Success'").count() == 1000
    assert gf.read_export(spark, target, many.schema).count() == 3000
    seen = []
    assert export(many, target, run_id="r1", sink=lambda *_: seen.append(1)) and not seen


def test_a_sink_that_counts_too_few_is_not_believed(spark, rows, folder):
    def sink(frame, path, overwrite, attempt):
        return write_partitions(frame.where("b = ''") if attempt == 1 else frame, path, overwrite, attempt)

    target, log_path = folder(), folder("log")
    assert export(rows, target, sink=sink, log_path=log_path)
    assert counts(spark, target, rows) == COUNTS
    assert {b: row.retry_attempts for b, row in log_of(spark, log_path).items()} == {"": 1, "01001": 2, "a/b=c": 2, None: 2}


def test_logs_of_before_layers_are_read(spark, rows, folder):
    target, log_path = folder(), folder("log")
    assert export(rows, target, log_path=log_path)
    old = folder("log")
    spark.read.parquet(log_path).drop("layer_name").write.parquet(old)
    assert gf.batch_log(spark, old).count() == 4
    assert export(rows, target, log_path=old) and gf.batch_log(spark, old).count() == 4
    assert export(rows, target, log_path=old, layer="x") and gf.batch_log(spark, old).count() == 8


def test_reserved_names_and_modes(rows, folder):
    with pytest.raises(ValueError):
        export(rows.withColumn("chunk", F.lit(1)), folder())
    with pytest.raises(ValueError):
        export(rows, folder(), write_mode="merge")


def test_staged_tables_are_removed(spark, rows, folder):
    from geoferry.workspace import shared_folder

    def staged():
        path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
        listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        names = [entry.getPath().getName().split("-")[0] for entry in listed]
        return sum(name in ("counts", "rows", "ranges", "finer", "wide", "offsets", "found", "batch") for name in names)

    before = staged()
    assert export(rows, folder(), rows_per_task=0)
    gf.chunked_write(rows, folder(), 10, "b", rows_per_task=0)
    assert staged() == before


# --- chunked writes ---


def read(spark, target, rows):
    return {(r.b, r.chunk): r["count"] for r in gf.read_chunked(spark, target, rows.schema).groupBy("b", "chunk").count().collect()}


def test_first_write_takes_the_mode_and_later_ones_append(spark, rows, folder):
    target = folder()
    rows.write.parquet(target)
    empty = gf.chunked_write(rows.limit(0), target, 15, "b")
    assert empty == (True, True, "overwrite")
    state = gf.chunked_write(rows.where("b = '01001'"), target, 15, "b", is_first_batch=empty.is_first_batch)
    assert state == (True, False, "append")
    state = gf.chunked_write(
        rows.where("b = ''"), target, 15, "b", write_mode=state.write_mode, is_first_batch=state.is_first_batch
    )
    assert state == (True, False, "append")
    assert read(spark, target, rows) == {("01001", 1): 15, ("01001", 2): 15, ("01001", 3): 10, ("", 1): 15, ("", 2): 5}


def test_a_chunk_is_one_file_when_spread(spark, rows, folder):
    target = folder()
    gf.chunked_write(rows, target, 15, "b", ["id"], parallelism=12)
    files = gf.read_chunked(spark, target, rows.schema).select("b", "chunk", F.input_file_name().alias("f")).distinct()
    assert files.count() == 8


def test_chunks_without_batches(spark, rows, folder):
    target = folder()
    gf.chunked_write(rows, target, 30)
    found = gf.read_chunked(spark, target, rows.schema).groupBy("chunk").count().collect()
    assert {row.chunk: row["count"] for row in found} == {1: 30, 2: 30, 3: 30, 4: 10}


def test_export_can_be_pruned_to_a_batch(spark, rows, folder):
    from geoferry.operators.batches import partition_key

    target = folder()
    gf.chunked_write(rows, target, 15, "b")
    one = gf.read_chunked(spark, target, rows.schema).where(F.col("batch_key") == partition_key(F.lit("01001")))
    assert "PartitionFilters: [isnotnull(batch_key" in plan_of(one) and one.count() == 40
