"""The shared folder for staged tables: the one the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: How long counts of a job that has ended are waited for.
EVENT_SECONDS = 60


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor reaches.

    A machine-local folder is made only for a local session that names none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors reach in spark.checkpoint.dir")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="geoferry-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder; nothing is made there yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write the frame once and give the written table back, with its path.

    A staged table is the same at each reading, which a recomputed or cached frame need not be once an
    executor is lost, and it is read column by column.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def observed(df: DataFrame, **more: Column) -> tuple[DataFrame, Callable[[], dict[str, int] | None]]:
    """The frame, and the number ``n`` of its rows, and further aggregates by name, that the one job that then writes it
    has seen: no row is read again to count it.

    Let nothing that shuffles or filters come between this and the writer. The counts are those of the writing tasks that
    succeeded. They come with the job's last event; where a crowded driver has lost that, there are none after a minute.
    """
    seen = Observation()
    wanted = [F.count(F.lit(1)).alias("n"), *[value.alias(name) for name, value in more.items()]]

    def counts() -> dict[str, int] | None:
        found: dict[str, int] = {}
        waiting = threading.Thread(target=lambda: found.update(seen.get), daemon=True)
        waiting.start()
        waiting.join(EVENT_SECONDS)
        return {name: int(value) for name, value in found.items()} if found else None

    return df.observe(seen, *wanted), counts


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Remove one staged table, named by the path that ``stage`` gave."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_folder(spark: SparkSession, target: str, write: Callable[[str], None]) -> None:
    """Have ``write`` fill a new folder beside the target, then put it in the target's place.

    A write that fails leaves the target as it was. The old folder is set aside by a rename and removed last;
    a job that dies between the two renames leaves it beside the target, as ``_old-...``. On an object store,
    where a rename copies, take a table format with transactions instead.
    """
    place, mark = target.rstrip("/"), uuid.uuid4().hex
    beside = place.rpartition("/")[0]
    fresh, here, aside = (
        spark._jvm.org.apache.hadoop.fs.Path(path) for path in (f"{beside}/_new-{mark}", place, f"{beside}/_old-{mark}")
    )
    files = here.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        write(f"{beside}/_new-{mark}")
        replaces = files.exists(here)
        if replaces and not files.rename(here, aside):
            raise OSError(f"cannot set {place} aside")
        if not files.rename(fresh, here):
            if replaces:
                files.rename(aside, here)
            raise OSError(f"cannot put the new {place} in its place")
    finally:
        files.delete(fresh, True)
    if replaces:
        files.delete(aside, True)
    spark.catalog.refreshByPath(place)
