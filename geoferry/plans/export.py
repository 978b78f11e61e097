"""Publishing a frame batch by batch: one job per attempt, a log row per batch, retries of what is missing."""

from __future__ import annotations

import contextlib
import hashlib
import logging
import re
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoferry.fixed_values import (
    BATCH_LOG_KEYS,
    BATCH_LOG_UPDATED,
    BATCH_MESSAGE,
    MAX_ATTEMPTS,
    MAX_CHUNK_ROWS,
    RETRY_DELAY_SECONDS,
    TIMEOUT_MINUTES,
)
from geoferry.functions.text import quoted
from geoferry.operators.batches import partition_key
from geoferry.operators.chunks import ROWS_PER_TASK, chunk_rows_of
from geoferry.operators.conform import conform_schema
from geoferry.operators.logs import batch_log_rows
from geoferry.operators.registry import find_service
from geoferry.operators.upsert import current_state
from geoferry.sources.chunked import BATCH_KEY, CHUNK, check_names, chunk_count, spread_chunks
from geoferry.plans.services import ensure_layers, find_layers
from geoferry.sources.layers import is_path, layer_read
from geoferry.sources.tables import append
from geoferry.workspace import drop_staged, folder_exists, observed, stage

_logger = logging.getLogger(__name__)

RUN_ID, LAYER = "run_id", "layer_name"
_SEQUENCE, _EXPECTED, _WRITTEN = "sequence", "expected_rows", "written_rows"
_LAYOUT = [RUN_ID, BATCH_KEY, CHUNK]

_RUN_ENTRY = f"{RUN_ID} string, rows bigint, is_complete boolean"

_COMMIT_ENTRY = f"{RUN_ID} string, {BATCH_KEY} string, {_WRITTEN} bigint"

# Takes the rows of an attempt, the target folder, the kind of overwrite (always "dynamic": only the
# partitions it holds) and the attempt's number. A sink that knows how many rows its job wrote returns that.
Sink = Callable[[DataFrame, str, str, int], int | None]


def write_partitions(rows: DataFrame, target: str, overwrite: str, attempt: int) -> int | None:
    """The usual sink. A dynamic overwrite replaces only the batches it holds, so writing twice is writing once.

    Gives the rows that its job took, if they are known; the job has written all of them, or it fails.
    """
    rows, count = observed(rows)
    rows.write.mode("overwrite").option("partitionOverwriteMode", overwrite).partitionBy(*_LAYOUT).parquet(target)
    found = count()
    return found and found["n"]


def layer_target(target: str, layer: str | None) -> str:
    """The folder of one layer of a service; without a layer the service's own."""
    if layer is None:
        return target
    name = f"v-{layer}" if re.fullmatch(r"[A-Za-z0-9_.\-]{1,100}", layer) else f"h-{hashlib.md5(layer.encode()).hexdigest()}"
    return f"{target.rstrip('/')}/layer-{name}"


# Names with an underscore are not read as part of the data.
def _runs(target: str) -> str:
    return f"{target.rstrip('/')}/_runs"


def _commits(target: str) -> str:
    return f"{target.rstrip('/')}/_commits"


def _layout(schema: T.StructType) -> T.StructType:
    keys = [(RUN_ID, T.StringType()), (BATCH_KEY, T.StringType()), (CHUNK, T.IntegerType())]
    return T.StructType([*schema.fields, *[T.StructField(name, kind) for name, kind in keys]])


def _run_states(spark: SparkSession, target: str) -> DataFrame:
    """Each run entered so far, and whether it counts; one that a later overwrite struck out does not."""
    if not folder_exists(spark, _runs(target)):
        return spark.createDataFrame([], f"{RUN_ID} string, is_complete boolean")
    entries = spark.read.schema(_RUN_ENTRY).parquet(_runs(target))
    counts = F.bool_and(F.coalesce(F.col("is_complete"), F.lit(True))).alias("is_complete")
    return entries.groupBy(RUN_ID).agg(counts)


def _publish(spark: SparkSession, target: str, run_id: str, rows: int, replaces: bool) -> None:
    """Enter the run as complete. One that overwrites strikes out the earlier runs in the same one-file entry.

    The folders of those are removed last, so that whatever breaks off before leaves the old rows readable.
    """
    earlier = []
    if replaces:
        others = (F.col(RUN_ID) != run_id) & F.col("is_complete")
        earlier = [row[RUN_ID] for row in _run_states(spark, target).where(others).toLocalIterator()]
    entries = [(run_id, rows, True), *[(old, 0, False) for old in earlier]]
    append(spark.createDataFrame(entries, _RUN_ENTRY).coalesce(1), _runs(target))
    for old in earlier:
        drop_staged(spark, f"{target.rstrip('/')}/{RUN_ID}={old}")


def read_export(spark: SparkSession, target: str, schema: T.StructType, layer: str | None = None) -> DataFrame:
    """The rows of all complete runs, with their ``run_id``, ``batch_key`` and ``chunk``; of one layer if it is named."""
    target = layer_target(target, layer)
    complete = _run_states(spark, target).where("is_complete").select(RUN_ID)
    # By name, so that other files in the target are left out.
    folders = f"{target.rstrip('/')}/{RUN_ID}=*"
    rows = spark.read.schema(_layout(schema)).option("basePath", target).parquet(folders)
    return rows.join(complete, RUN_ID, "left_semi").select(*rows.columns)


def batch_log(spark: SparkSession, log_path: str) -> DataFrame:
    """Current state of a batch log: one row per batch, service and layer. A null batch is one batch.

    Entries of before layers were named are those of the service's own, as null is.
    """
    log = layer_read(spark, log_path, mergeSchema="true") if is_path(log_path) else layer_read(spark, log_path)
    if LAYER not in log.columns:
        log = log.withColumn(LAYER, F.lit(None).cast("string"))
    return current_state(log, [*BATCH_LOG_KEYS, LAYER], _SEQUENCE, [*BATCH_LOG_UPDATED, RUN_ID], null_is_a_key=True)


@contextlib.contextmanager
def _deadline(spark: SparkSession, minutes: float | None) -> Iterator[threading.Event]:
    """Cancel the jobs started inside once the time is up; the event tells whether it was."""
    passed = threading.Event()
    if minutes is None:
        yield passed
        return
    context, tag = spark.sparkContext, f"deadline-{uuid.uuid4().hex}"

    def cancel() -> None:
        passed.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(minutes * 60, cancel)
    timer.daemon = True
    context.addJobTag(tag)
    timer.start()
    try:
        yield passed
    finally:
        timer.cancel()
        context.removeJobTag(tag)


def _compare(spark: SparkSession, expected: DataFrame, target: str, run_id: str) -> DataFrame:
    """The expected batches, each with the rows the target holds of it in this run.

    The target's rows are counted from folder names and file footers, which lists every folder of the run: only an
    attempt that failed, or a sink that does not count, makes it needed.
    """
    folder = f"{target.rstrip('/')}/{RUN_ID}={run_id}"
    if not folder_exists(spark, folder):
        return expected.withColumn(_WRITTEN, F.lit(0).cast("bigint"))
    # Only this run's folders are listed.
    found = spark.read.schema(_layout(T.StructType([]))).option("basePath", target).parquet(folder)
    counts = found.groupBy(BATCH_KEY).agg(F.count(F.lit(1)).alias(_WRITTEN))
    return expected.join(counts, BATCH_KEY, "left").fillna(0, [_WRITTEN])


def _commit(batches: DataFrame, target: str, run_id: str) -> None:
    """Enter batches that are whole in the run's manifest, in one file."""
    rows = batches.select(F.lit(run_id).alias(RUN_ID), BATCH_KEY, F.col(_WRITTEN).cast("bigint").alias(_WRITTEN))
    append(rows.coalesce(1), _commits(target))


def _uncommitted(spark: SparkSession, expected: DataFrame, target: str, run_id: str) -> DataFrame:
    """The expected batches that the manifest does not show as whole in this run.

    What a job wrote whose entry is missing is written again, in the same place.
    """
    if not folder_exists(spark, _commits(target)):
        return expected
    entries = spark.read.schema(_COMMIT_ENTRY).parquet(_commits(target)).where(F.col(RUN_ID) == run_id)
    same = [BATCH_KEY, _EXPECTED]
    return expected.join(entries.select(BATCH_KEY, F.col(_WRITTEN).alias(_EXPECTED)).distinct(), same, "left_anti").select(*expected.columns)


def batch_export(
    df: DataFrame,
    target: str,
    batch: str,
    service: str,
    server_url: str | None = None,
    services: DataFrame | None = None,
    layer_id: str | None = None,
    layer: str | None = None,
    registry: str | None = None,
    create_service: bool = True,
    service_summary: str | None = None,
    service_tags: list[str] | None = None,
    write_mode: str = "overwrite",
    user: str | None = None,
    fields: Iterable[Mapping[str, str]] | None = None,
    chunk_rows: int = MAX_CHUNK_ROWS,
    order_by: Sequence[str | Column] = (),
    parallelism: int | None = None,
    max_attempts: int = MAX_ATTEMPTS,
    retry_delay_seconds: float = RETRY_DELAY_SECONDS,
    timeout_minutes: float | None = TIMEOUT_MINUTES,
    log_path: str | None = None,
    run_id: str | None = None,
    sink: Sink = write_partitions,
    rows_per_task: int = ROWS_PER_TASK,
) -> bool:
    """Publish the frame to a folder, batch by batch; True once every batch is there.

    The timeout is per batch: an attempt has that long for each of the batches it writes.

    ``overwrite`` leaves exactly the frame in the target, ``append`` adds it. A run writes a folder of its
    own; earlier runs stay readable until it is complete, whatever fails. Each attempt is one job over
    the batches still missing. A job that did not fail and took as many rows as were expected has written all its batches;
    after any other the target's rows are counted, and a batch is a success if they are as many as the input's. Whole
    batches are entered in the run's manifest, and each batch gets a log row with the ``run_id``. An attempt that fails or runs
    past the timeout is logged for the batches it left, and the next one writes only those, replacing what is there of
    them in this run: no row is written twice or lost. A call with the ``run_id`` of a broken off run goes on with the
    batches that are not in its manifest.

    ``layer`` names one of several layers of the service: it has a folder of its own in the target and log entries of its
    own. Give ``services`` to look the service up, or the place of a stored ``registry``, where a service or layer that is
    not there is registered unless ``create_service`` is off; a lookup that fails raises.

    A null batch value is a batch. An empty frame writes nothing and returns True.
    """
    if write_mode not in ("overwrite", "append"):
        raise ValueError("the write mode is overwrite or append")
    spark = df.sparkSession
    if services is not None:
        name = spark.createDataFrame([(service,)], "name string")
        known = find_service(services, name, user).first()
        if not known.found:
            raise LookupError(f"no service is called {service}")
        server_url, layer_id = server_url or known.url, layer_id or known.id
    if registry is not None:
        wanted = spark.createDataFrame([(service, layer)], "name string, layer_name string")
        if create_service:
            place = ensure_layers(spark, registry, wanted, owner=user, summary=service_summary, tags=service_tags).first()
        else:
            place = find_layers(spark, registry, wanted, user).first()
            if place.service_id is None or (layer is not None and place.layer_id is None):
                raise LookupError(f"the registry has no {service}" + (f" with a layer {layer}" if layer else ""))
        server_url, layer_id = server_url or place.service_url, layer_id or place.service_id
    target = layer_target(target, layer)
    if fields is not None:
        df = conform_schema(df, fields)
    check_names(df, _LAYOUT)
    if run_id is not None and not re.fullmatch(r"[A-Za-z0-9_.\-]{1,100}", run_id):
        raise ValueError("a run id is made of at most 100 letters, digits, dots, dashes and underscores")
    resumed, run_id = run_id is not None, run_id or uuid.uuid4().hex
    if resumed and not _run_states(spark, target).where((F.col(RUN_ID) == run_id) & ~F.col("is_complete")).isEmpty():
        raise ValueError(f"a later run has replaced {run_id}: take a new run id")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.withColumns({RUN_ID: F.lit(run_id), BATCH_KEY: partition_key(quoted(batch))})

    chunked = chunk_rows_of(df, chunk_rows, batch, order_by, CHUNK, rows_per_task)
    try:
        if chunked.total_rows == 0:
            return True
        key, size = partition_key(quoted(batch)).alias(BATCH_KEY), F.col("n_rows").alias(_EXPECTED)
        expected = chunked.counts.select(quoted(batch), key, size)
        is_there = F.col(_WRITTEN) == F.col(_EXPECTED)

        def compared(batches: DataFrame) -> DataFrame:
            found, path = stage(_compare(spark, batches, target, run_id), "found")
            chunked.staged.append(path)
            return found

        pending, wanted = expected, placed(chunked.frame)
        if resumed:
            pending, path = stage(_uncommitted(spark, expected, target, run_id), "found")
            chunked.staged.append(path)
        for attempt in range(1, max_attempts + 1):
            n_chunks = chunk_count(F.col(_EXPECTED), chunk_rows).alias("chunks")
            sizes = pending.agg(F.count(F.lit(1)).alias("n"), F.sum(_EXPECTED).alias("rows"), n_chunks).first()
            if sizes.n == 0:
                break
            if attempt > 1 or resumed:
                wanted = placed(chunked.only(pending))
            problem = written = None
            with _deadline(spark, timeout_minutes and timeout_minutes * sizes.n) as late:
                try:
                    written = sink(spread_chunks(wanted, parallelism, sizes.chunks, sizes.rows, order_by), target, "dynamic", attempt)
                except Exception as error:
                    problem = str(error).strip() or type(error).__name__
                    _logger.error("attempt %s failed: %s", attempt, problem)
            all_there = problem is None and written == sizes.rows
            # Otherwise what the target holds decides: a failed attempt may have written some batches all the same.
            outcome = pending.withColumn(_WRITTEN, F.col(_EXPECTED)) if all_there else compared(pending)
            _commit(outcome.where(is_there), target, run_id)
            shortfall = F.concat_ws(" ", F.col(_WRITTEN), F.lit("of"), F.col(_EXPECTED), F.lit("rows written"))
            entries = batch_log_rows(
                outcome,
                batch=quoted(batch),
                target_svc_name=service,
                target_server_url=server_url,
                batch_by_column=batch,
                layer_id=layer_id,
                write_mode=write_mode,
                user=user,
                status=F.when(is_there, "Success").otherwise("Timeout" if late.is_set() else "Failed"),
                message=F.when(is_there, BATCH_MESSAGE).otherwise(F.lit(problem) if problem else shortfall),
                retry_attempts=attempt,
            )
            if log_path:
                marks = {LAYER: F.lit(layer).cast("string"), RUN_ID: F.lit(run_id), _SEQUENCE: F.lit(time.time_ns())}
                append(entries.withColumns(marks), log_path)
            if all_there:
                break
            pending = outcome.where(~is_there).select(*expected.columns)
            if pending.isEmpty():
                break
            if attempt < max_attempts:
                time.sleep(retry_delay_seconds)
        else:
            return False
        _publish(spark, target, run_id, chunked.total_rows, write_mode == "overwrite")
        return True
    finally:
        chunked.release()
