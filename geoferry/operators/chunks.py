"""Chunks: runs of at most N rows within a batch, numbered from 1.

Which rows share a chunk follows from the row number within the batch. Rows and bytes are counted per batch first. A
batch that fits a task is numbered by a window. A batch that does not, or a frame without batches, is spread over range
partitions of about the same size, written once to the shared folder, and numbered by adding to each
partition the rows its batch has in earlier partitions. Both give the same numbers.

An input that is more than a scan of files is evaluated once: it is written first, and all that follows reads that.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add, and_

from py4j.java_gateway import JavaObject
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoferry.fixed_values import MAX_CHUNK_ROWS
from geoferry.functions.text import quoted
from geoferry.operators.batches import batch_counts
from geoferry.workspace import drop_staged, stage

# One task may sort this many rows and bytes of one batch; a larger batch is spread.
ROWS_PER_TASK, BYTES_PER_TASK = 5_000_000, 1 << 30
# Rows and bytes aimed at per partition; one of more than twice the bytes is split again.
ROWS_PER_RANGE, BYTES_PER_RANGE = 1_000_000, 128 << 20

_TIE, _SEQ, _BYTES, _POS, _PART, _OUTER = "__tie", "__seq", "__bytes", "__pos", "__part", "__outer"

# Nodes of a plan whose rows cost no more than reading files again, and come in the same order each time.
_CHEAP = {"Project", "Filter", "LogicalRelation", "Relation", "LocalRelation", "Range", "SubqueryAlias"}


@dataclass
class Chunked:
    """A frame with chunk numbers, the rows per batch, and the staged tables both may read."""

    number: Callable[[DataFrame | None], DataFrame]
    counts: DataFrame
    total_rows: int
    staged: list[str] = field(default_factory=list)

    @property
    def frame(self) -> DataFrame:
        return self.number(None)

    def only(self, batches: DataFrame) -> DataFrame:
        """The rows of some batches, with the same numbers; the others are dropped before any numbering."""
        return self.number(batches)

    def release(self) -> None:
        """Remove the staged tables, once the frame is written elsewhere."""
        for path in self.staged:
            drop_staged(self.counts.sparkSession, path)
        self.staged = []


def _chunk_number(row_number: Column, chunk_rows: int) -> Column:
    return (F.call_function("div", row_number - 1, F.lit(chunk_rows)) + 1).cast("int")


def _tie_break(df: DataFrame) -> Column:
    """A hash of the whole row: rows that tie on it too are copies, so it is the same which comes first."""

    def hashable(name: str) -> Column:
        holds_unhashable = any(kind in df.schema[name].dataType.simpleString() for kind in ("map<", "variant"))
        return F.to_json(F.struct(quoted(name))) if holds_unhashable else quoted(name)

    return F.xxhash64(*[hashable(name) for name in df.columns])


def _nodes(plan: JavaObject) -> Iterator[JavaObject]:
    yield plan
    children = plan.children()
    for place in range(children.size()):
        yield from _nodes(children.apply(place))


def _is_plain(df: DataFrame) -> bool:
    """Whether the frame is files with columns and rows picked by plain expressions: no shuffle, Python or chance."""
    plan = df._jdf.queryExecution().optimizedPlan()
    return all(node.getClass().getSimpleName() in _CHEAP and node.deterministic() for node in _nodes(plan))


_WIDTHS = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4, T.DecimalType: 16, T.NullType: 0}


def _width(value: Column, kind: T.DataType) -> tuple[int, list[Column]]:
    """Bytes of a value: a part that all values have, and parts that follow from the value."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 4, [F.coalesce(F.octet_length(value), F.lit(0))]
    if isinstance(kind, T.StructType):
        parts = [_width(value.getField(field.name), field.dataType) for field in kind.fields]
        return sum(fixed for fixed, _ in parts), [part for _, more in parts for part in more]
    if isinstance(kind, T.ArrayType):
        fixed, more = _width(F.lit(None).cast(kind.elementType), kind.elementType)
        sizes = F.greatest(F.size(value), F.lit(0)) * fixed
        if not more:
            return 4, [sizes]
        each = lambda total, item: total + reduce(add, _width(item, kind.elementType)[1]).cast("long")
        return 4, [sizes, F.coalesce(F.aggregate(value, F.lit(0).cast("long"), each), F.lit(0))]
    if isinstance(kind, T.MapType):
        keys, values = (_width(F.map_keys(value), T.ArrayType(kind.keyType)), _width(F.map_values(value), T.ArrayType(kind.valueType)))
        return keys[0] + values[0], keys[1] + values[1]
    return _WIDTHS.get(type(kind), 8), []


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes. Columns whose types have one size are not read for it."""
    parts = [_width(quoted(field.name), field.dataType) for field in df.schema.fields]
    return reduce(add, [part.cast("long") for _, more in parts for part in more], F.lit(sum(fixed for fixed, _ in parts)).cast("long"))


def _n_ranges(rows: int, n_bytes: int) -> int:
    return max(1, math.ceil(rows / ROWS_PER_RANGE), math.ceil(n_bytes / BYTES_PER_RANGE))


def _number_by_window(
    df: DataFrame, batch: str | None, order: list[Column], chunk_rows: int, chunk: str, n: int
) -> DataFrame:
    by = [quoted(batch)] if batch else [F.lit(0)]
    if batch and n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        # More rows than the session's partitions are meant for.
        df = df.repartition(n, *by)
    window = Window.partitionBy(*by).orderBy(*order, F.col(_TIE))
    return df.withColumn(chunk, _chunk_number(F.row_number().over(window), chunk_rows))


def _spread(rows: DataFrame, keys: list[Column], n: int) -> DataFrame:
    """Range partitions of the rows, sorted, with each row's position and partition."""
    return (
        rows.repartitionByRange(n, *keys, F.col(_SEQ))
        .sortWithinPartitions(*keys, F.col(_SEQ))
        .withColumn(_POS, F.monotonically_increasing_id())
        .withColumn(_PART, F.shiftright(_POS, 33))
    )


def _number_by_range(
    df: DataFrame, batch: str | None, order: list[Column], chunk_rows: int, chunk: str, n: int, width: Column
) -> tuple[DataFrame, list[str]]:
    """The numbered rows, and the staged tables they are read from, the ranges last. ``df`` is plain or staged."""
    by = [quoted(batch)] if batch else []
    keys = [*by, *order, F.col(_TIE)]
    # The position in the input splits even a large group of copies over several ranges. The input is files, so a
    # row's position is the same in a task that runs again, and no copy is lost or counted twice.
    rows = df.withColumns({_SEQ: F.monotonically_increasing_id(), _BYTES: width})
    ranges, path = stage(_spread(rows, keys, n), "ranges")
    paths = [path]

    # Ranges hold about as many rows each. Where rows are much wider than elsewhere, they are cut again by bytes.
    parts = ranges.groupBy(_PART).agg(F.sum(_BYTES).alias("__n_bytes"), F.count(F.lit(1)).alias("__n"))
    is_wide = (F.col("__n_bytes") > 2 * BYTES_PER_RANGE) & (F.col("__n") > 1)
    wide, wide_path = stage(parts.where(is_wide).select(F.col(_PART).alias(_OUTER), "__n_bytes"), "wide")
    paths.insert(0, wide_path)
    n_more = sum(math.ceil(row["__n_bytes"] / BYTES_PER_RANGE) for row in wide.select("__n_bytes").toLocalIterator())
    columns = [quoted(name) for name in df.columns]
    staged = ranges.select(*columns, F.col(_PART).alias(_OUTER), F.lit(0).cast("bigint").alias(_PART), _POS)
    if n_more:
        here = F.col(_PART) == F.col(_OUTER)
        cut = ranges.join(wide.select(_OUTER), here).drop(_PART, _POS)
        finer, finer_path = stage(_spread(cut, [F.col(_OUTER), *keys], n_more), "finer-ranges")
        paths.insert(0, finer_path)
        left = ranges.join(wide.select(_OUTER), here, "left_anti")
        staged = left.select(*columns, F.col(_PART).alias(_OUTER), F.lit(-1).cast("bigint").alias(_PART), _POS).unionByName(
            finer.select(*columns, _OUTER, _PART, _POS)
        )

    # At most one row per range partition and batch: sorted ranges share no more than their ends.
    runs = staged.groupBy(*by, _OUTER, _PART).agg(F.count(F.lit(1)).alias("__n"), F.min(_POS).alias("__first"))
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy(_OUTER, _PART).rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")
    of_run = [F.col(name).alias(f"__run{name}") for name in (_OUTER, _PART)]
    offsets, offsets_path = stage(
        runs.select(*of_run, base.alias("__base"), *([quoted(batch).alias("__run_batch")] if batch else [])), "offsets"
    )
    paths.insert(0, offsets_path)
    same = [F.col(name) == F.col(f"__run{name}") for name in (_OUTER, _PART)]
    if batch:
        same.append(quoted(batch).eqNullSafe(F.col("__run_batch")))
    # Being a written table, the offsets are of known size: Spark broadcasts them if that is small, and shuffles if not.
    numbered = (
        staged.join(offsets, reduce(and_, same))
        .withColumn(chunk, _chunk_number(F.col("__base") + F.col(_POS) + 1, chunk_rows))
        .drop(_POS, _PART, _OUTER, *offsets.columns)
    )
    return numbered, paths


def _storable(df: DataFrame) -> bool:
    return not any(kind in df.schema.simpleString() for kind in ("void", "interval"))


def chunk_rows_of(
    df: DataFrame,
    chunk_rows: int = MAX_CHUNK_ROWS,
    batch: str | None = None,
    order_by: Sequence[str | Column] = (),
    chunk: str = "chunk",
    rows_per_task: int = ROWS_PER_TASK,
    bytes_per_task: int = BYTES_PER_TASK,
) -> Chunked:
    """Number the chunks, and keep the counts and staged tables at hand for a writer."""
    if chunk_rows < 1:
        raise ValueError("a chunk holds at least one row")
    order = [quoted(name) if isinstance(name, str) else name for name in order_by]
    staged = []
    if not _is_plain(df) and _storable(df):
        df, path = stage(df, "rows")
        staged.append(path)
    width = row_bytes(df)
    counts, path = stage(batch_counts(df, batch, n_bytes=F.sum(width)), "counts")
    staged.append(path)
    is_large = (F.col("n_rows") > rows_per_task) | (F.col("n_bytes") > bytes_per_task)
    total = lambda name, which: F.coalesce(F.sum(F.when(which, F.col(name))), F.lit(0))
    sizes = counts.agg(
        total("n_rows", is_large).alias("spread"), total("n_bytes", is_large).alias("spread_bytes"),
        total("n_rows", ~is_large).alias("rest"), total("n_bytes", ~is_large).alias("rest_bytes"),
    ).first()
    rows = df.withColumn(_TIE, _tie_break(df))
    small_rows, large_rows = (rows, None) if sizes.spread == 0 else (None, rows)
    if sizes.spread and sizes.rest:
        wanted = counts.where(is_large).select(quoted(batch).alias("__large"))
        match = quoted(batch).eqNullSafe(F.col("__large"))
        small_rows, large_rows = rows.join(wanted, match, "left_anti"), rows.join(wanted, match, "left_semi")
    if large_rows is not None:
        n = _n_ranges(sizes.spread, sizes.spread_bytes)
        spread, paths = _number_by_range(large_rows, batch, order, chunk_rows, chunk, n, width)
        staged += paths

    def kept(part: DataFrame, batches: DataFrame | None) -> DataFrame:
        if batches is None:
            return part
        named = batches.select(quoted(batch).alias("__kept"))
        return part.join(named, quoted(batch).eqNullSafe(F.col("__kept")), "left_semi")

    def number(batches: DataFrame | None) -> DataFrame:
        parts = []
        if small_rows is not None:
            n = _n_ranges(sizes.rest, sizes.rest_bytes)
            parts.append(_number_by_window(kept(small_rows, batches), batch, order, chunk_rows, chunk, n))
        if large_rows is not None:
            parts.append(kept(spread, batches))
        return reduce(DataFrame.unionByName, parts).select(*[quoted(name) for name in [*df.columns, chunk]])

    return Chunked(number, counts, sizes.spread + sizes.rest, staged)


def assign_chunks(
    df: DataFrame,
    chunk_rows: int = MAX_CHUNK_ROWS,
    batch: str | None = None,
    order_by: Sequence[str | Column] = (),
    chunk: str = "chunk",
    rows_per_task: int = ROWS_PER_TASK,
    bytes_per_task: int = BYTES_PER_TASK,
) -> DataFrame:
    """The frame with a chunk number per row.

    Rows are taken in the given order, copies of a row in any; without an order, in that of a row hash.
    """
    return chunk_rows_of(df, chunk_rows, batch, order_by, chunk, rows_per_task, bytes_per_task).frame


def chunk_manifest(df: DataFrame, chunk_rows: int = MAX_CHUNK_ROWS, batch: str | None = None) -> DataFrame:
    """Rows and write mode of every chunk: ``batch, chunk, n_rows, write_mode``.

    A batch of n rows has full chunks but for the last, so the counts per batch say it all: one scan of
    one column. The first chunk of the smallest batch value (null last) replaces the target.
    """
    counts = batch_counts(df, batch, "__rows")
    value = quoted(batch) if batch else F.lit(None).cast("string")
    # Keeping the count in the second reading lets Spark reuse the first one's shuffle.
    first = counts.where(F.col("__rows") > 0).agg(F.min(value).alias("first")).scalar()
    chunk = F.explode(F.sequence(F.lit(1), F.ceil(F.col("__rows") / F.lit(chunk_rows)).cast("int")))
    n_rows = F.least(F.lit(chunk_rows), F.col("__rows") - (F.col("chunk") - 1).cast("bigint") * chunk_rows)
    opens = (F.col("chunk") == 1) & F.col("batch").eqNullSafe(first)
    return (
        counts.select(value.alias("batch"), "__rows", chunk.alias("chunk"))
        .select("batch", "chunk", n_rows.alias("n_rows"), F.when(opens, "overwrite").otherwise("append").alias("write_mode"))
    )
