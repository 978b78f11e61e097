"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoferry.workspace import drop_staged, stage

Query = Callable[[SparkSession, str], DataFrame]

#: The white space of the contracts, ``[\x20\x09-\x0D]``, and the letters that are lower-cased.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting by which shuffle files go as soon as their job has ended, and not when the driver collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Spark's setting of how many bytes go to a Python worker at a time.
BYTES_AT_A_TIME = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The setting for the jobs that run within, and what it was before from then on."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stage``, with the shuffle files of the job removed behind it: what is read from then on is the written table."""
    with _setting(df.sparkSession, SHUFFLES_GO, "true"):
        return stage(df, f"llm-{name}")


def in_batches(spark: SparkSession, n_bytes: int):
    """For jobs with wide rows: a batch is full at so many bytes, and not only by its rows."""
    return _setting(spark, BYTES_AT_A_TIME, str(n_bytes))


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read again, so that no step computes it twice."""
    return written(df, name)[0]


class Scratch:
    """Written tables that are removed once what was made of them is written."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        table, path = written(df, name)
        self.paths.append(path)
        return table

    def drop(self, spark: SparkSession) -> None:
        while self.paths:
            drop_staged(spark, self.paths.pop())


def texts_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text, null as empty; other columns can't clash with what the operators add."""
    return docs.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(text))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def hash128(prefix: str, *columns: Column) -> list[Column]:
    """Two 64-bit hashes of the columns with seeds of their own: at 10^12 rows one would meet itself by chance."""
    return [F.xxhash64(F.lit(seed), *columns).alias(f"{prefix}{number}") for number, seed in enumerate((1, 2))]


def shuffled_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", always: bool = False) -> DataFrame:
    """Join by keys through shuffles of both sides, which adaptive execution can split at a hot key.

    A side that was grouped by the same keys would otherwise lend its partitioning, and then nothing is split. A right side
    that Spark sees to be small is broadcast, unless the join shall ``always`` be the one of large tables.
    """
    a, b = "__left_hash", "__right_hash"
    mine = left.withColumn(a, F.xxhash64(*keys))
    theirs = right.withColumn(b, F.xxhash64(*keys)).withColumnsRenamed({key: f"__{key}" for key in keys})
    match = reduce(lambda x, y: x & y, [F.col(key) == F.col(f"__{key}") for key in keys], F.col(a) == F.col(b))
    return mine.join(theirs.hint("merge") if always else theirs, match, how).drop(a, b, *[f"__{key}" for key in keys])


#: Numbers that a filter of ids tells apart, 64 to a row: it has 2^19 rows at most, some 8 MB.
FILTER_BITS = 25


def id_filter(ids: DataFrame, key: str, scratch: Scratch | None = None) -> DataFrame:
    """A table of bounded size that says of any id whether it may be among these: a bit for each of 2^25 hashes.

    It is written if there is a ``scratch``; what one job alone reads need not be.
    """
    number = F.pmod(F.xxhash64(F.lit(25), key), F.lit(1 << FILTER_BITS))
    bits = ids.select(F.shiftright(number, 6).alias("__word"), F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int")).alias("__bit"))
    found = bits.groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    return found if scratch is None else scratch.stage(found, "id-filter")


def maybe_among(rows: DataFrame, key: str, known: DataFrame) -> DataFrame:
    """The rows with ``__maybe``: false for those whose id is surely not among the ids of a filter; nothing is shuffled."""
    number = F.pmod(F.xxhash64(F.lit(25), key), F.lit(1 << FILTER_BITS))
    marked = rows.withColumns({"__number": number, "__place": F.shiftright(number, 6)})
    joined = marked.join(F.broadcast(known), F.col("__place") == F.col("__word"), "left")
    bit = F.col("__bits").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__number").bitwiseAND(F.lit(63)).cast("int"))) != 0
    return joined.withColumn("__maybe", F.coalesce(bit, F.lit(False))).drop("__number", "__place", "__word", "__bits")
