import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from geoferry import assign_chunks, batch_keys, batch_subset, chunk_manifest
from geoferry.operators import chunks
from geoferry.operators.batches import partition_key

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


@pytest.fixture
def small_ranges(monkeypatch):
    """Ranges so small that every batch crosses several of them."""
    monkeypatch.setattr(chunks, "ROWS_PER_RANGE", 1500)


def sizes(df, *by):
    return {tuple(row[name] for name in by): row["n"] for row in df.groupBy(*by).agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("rows_per_task", [0, 20_000])
@pytest.mark.parametrize("broadcast_bytes", [-1, 10 << 20])
def test_ranges_give_the_numbers_of_a_window(spark, tables, small_ranges, rows_per_task, broadcast_bytes):
    """All batches spread, or only the two above 20,000 rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_bytes)
    try:
        _same_numbers(tables, rows_per_task)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _same_numbers(tables, rows_per_task):
    lineitem = tables("lineitem").select(*ORDER, "l_returnflag")
    by_window = assign_chunks(lineitem, 777, "l_returnflag", ORDER)
    by_range = assign_chunks(lineitem, 777, "l_returnflag", ORDER, rows_per_task=rows_per_task)
    assert by_range.columns == by_window.columns
    assert by_range.exceptAll(by_window).isEmpty() and by_window.exceptAll(by_range).isEmpty()


@pytest.mark.parametrize("rows_per_task", [0, 1_000_000])
def test_copies_of_one_row_are_spread_and_all_kept(spark, small_ranges, rows_per_task):
    """A third of the rows are copies, in one batch."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("b"), F.col("id") % 2)).alias("batch"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("value"),
    )
    found = sizes(assign_chunks(df, 1000, "batch", ["value"], rows_per_task=rows_per_task), "batch", "chunk")
    assert found == {(batch, chunk): 1000 for batch in ("same", "b0", "b1") for chunk in (1, 2, 3)}


def test_copies_do_not_share_one_range(spark, small_ranges):
    df = spark.range(9000).select(F.lit("x").alias("batch"), F.lit(1).alias("value"))
    chunked = chunks.chunk_rows_of(df, 1000, "batch", ["value"], rows_per_task=0)
    staged = spark.read.parquet(chunked.staged[-1])
    parts = [row["count"] for row in staged.groupBy("__part").count().collect()]
    assert len(parts) == 6 and sum(parts) == 9000 and max(parts) < 4500


@pytest.mark.parametrize("rows_per_task", [0, 1_000_000])
def test_null_and_empty_batches_are_batches(spark, small_ranges, rows_per_task):
    df = spark.range(40).select("id", F.expr("case id % 4 when 0 then null when 1 then '' when 2 then '01001' else 'a/b=c' end").alias("b"))
    found = sizes(assign_chunks(df, 4, "b", ["id"], rows_per_task=rows_per_task), "b", "chunk")
    assert found == {(b, c): n for b in (None, "", "01001", "a/b=c") for c, n in ((1, 4), (2, 4), (3, 2))}


@pytest.mark.parametrize("rows_per_task", [0, 12, 1_000_000])
def test_some_batches_keep_their_numbers(spark, small_ranges, rows_per_task):
    df = spark.range(60).select("id", F.expr("case when id < 10 then null when id < 30 then 'a' else 'b' end").alias("b"))
    chunked = chunks.chunk_rows_of(df, 4, "b", ["id"], rows_per_task=rows_per_task)
    wanted = spark.createDataFrame([(None,), ("a",)], "b string")
    some, every = chunked.only(wanted), chunked.frame
    assert some.count() == 30 and some.exceptAll(every.where("b is null or b = 'a'")).isEmpty()
    if rows_per_task == 1_000_000:
        plan = plan_of(some)
        assert plan.index("Window") < plan.index("LeftSemi")


@pytest.mark.parametrize("n_rows, expected", [(1, [1]), (5, [5]), (6, [5, 1]), (10, [5, 5]), (0, [])])
@pytest.mark.parametrize("rows_per_task", [0, 100])
def test_sizes_at_the_edges(spark, n_rows, expected, rows_per_task):
    df = spark.range(n_rows)
    found = sizes(assign_chunks(df, 5, rows_per_task=rows_per_task), "chunk")
    assert [found[key] for key in sorted(found)] == expected
    manifest = chunk_manifest(df, 5).orderBy("chunk").collect()
    assert [row.n_rows for row in manifest] == expected
    assert [row.write_mode for row in manifest] == ["overwrite"] * (n_rows > 0) + ["append"] * (len(expected) - 1)


def test_manifest_with_only_null_batches(spark):
    df = spark.range(3).select(F.lit(None).cast("string").alias("b"))
    assert [tuple(row) for row in chunk_manifest(df, 2, "b").orderBy("chunk").collect()] == [
        (None, 1, 2, "overwrite"),
        (None, 2, 1, "append"),
    ]


def test_manifest_reads_one_column(tables):
    plan = plan_of(chunk_manifest(tables("lineitem"), 5000, "l_returnflag"))
    assert "ReadSchema: struct<l_returnflag:string>" in plan and "Window" not in plan


def test_without_an_order_every_row_has_a_chunk(tables, small_ranges):
    lineitem = tables("lineitem")
    assert sizes(assign_chunks(lineitem, 1000, rows_per_task=0), "chunk") == {(c,): 1000 for c in range(1, 61)}


def test_types_that_cannot_be_hashed(spark):
    df = spark.range(10).select("id", F.create_map(F.lit("k"), F.col("id")).alias("m"))
    assert sizes(assign_chunks(df, 4), "chunk") == {(1,): 4, (2,): 4, (3,): 2}


def test_large_batches_are_not_sorted_in_one_task(tables):
    plan = plan_of(assign_chunks(tables("lineitem"), 5000, order_by=ORDER, rows_per_task=0))
    # The one window left runs over a row per range, above the grouped counts.
    data_side = plan.split("BroadcastExchange")[0]
    assert "Window" not in data_side and "SinglePartition" not in data_side


def test_chunk_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        assign_chunks(spark.range(3), 0)


def test_batch_keys_and_subsets(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "id int, b string")
    assert {row.b for row in batch_keys(df, "b").collect()} == {"a", None}
    assert [row.id for row in batch_subset(df, "b", None).collect()] == [2]
    assert [row.id for row in batch_subset(df, "b", "a").collect()] == [1, 3]


def test_partition_keys_differ(spark):
    values = [None, "", "none", "v-none", "a b", "a/b=c", "x" * 300, "01001", "é"]
    df = spark.createDataFrame([(value,) for value in values], "b string")
    keys = [row.key for row in df.select(partition_key(F.col("b")).alias("key")).collect()]
    assert len(set(keys)) == len(values) and max(map(len, keys)) <= 102


def test_partitions_follow_the_rows(tables, monkeypatch):
    monkeypatch.setattr(chunks, "ROWS_PER_RANGE", 3000)
    lineitem = tables("lineitem").select(*ORDER)
    df = assign_chunks(lineitem, 500, "l_suppkey", ORDER)
    plan = plan_of(df)
    assert "hashpartitioning(l_suppkey" in plan and ", 20), REPARTITION_BY_NUM" in plan and plan.count("Exchange") == 1
    assert df.groupBy("l_suppkey", "chunk").count().agg(F.max("count")).first()[0] <= 500


@pytest.mark.parametrize("rows_per_task, batch", [(0, "b"), (0, None), (100_000, "b")])
def test_an_input_is_evaluated_once(spark, small_ranges, rows_per_task, batch):
    """Python counts the rows it makes; numbering, and numbering some batches again, reads what was written once."""
    made = spark.sparkContext.accumulator(0)

    def make(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame.assign(b=frame.id % 3)

    df = spark.range(6000).mapInPandas(make, "id long, b long")
    chunked = chunks.chunk_rows_of(df, 500, batch, ["id"], rows_per_task=rows_per_task)
    assert chunked.frame.count() == 6000
    if batch:
        assert chunked.only(spark.createDataFrame([(1,)], "b long")).count() == 2000
        assert sizes(chunked.frame, "b", "chunk") == {(b, c): 500 for b in range(3) for c in range(1, 5)}
    assert made.value == 6000
    chunked.release()


def test_no_range_is_beyond_the_bytes(spark, monkeypatch):
    """A tenth of the rows hold nearly all bytes, in one stretch of the order; rows alone would leave them in few ranges."""
    monkeypatch.setattr(chunks, "BYTES_PER_RANGE", 50_000)
    df = spark.range(5000).select("id", F.repeat(F.lit("x"), F.when(F.col("id").between(2000, 2499), 4000).otherwise(4).cast("int")).alias("text"))
    chunked = chunks.chunk_rows_of(df, 333, None, ["id"], bytes_per_task=100_000)
    found = chunked.frame
    assert found.where(F.col("chunk") != F.floor(F.col("id") / 333) + 1).count() == 0 and found.count() == 5000
    finer = next(path for path in chunked.staged if "finer-ranges" in path)
    parts = spark.read.parquet(finer).groupBy("__outer", "__part").agg(F.sum("__bytes").alias("n")).collect()
    assert max(row.n for row in parts) < 2.5 * 50_000 and len(parts) > 20
    ranges = spark.read.parquet(chunked.staged[-1]).groupBy("__part").agg(F.sum("__bytes").alias("n"))
    split = {row["__outer"] for row in spark.read.parquet(finer).select("__outer").distinct().collect()}
    assert {row["__part"] for row in ranges.where("n > 100000").collect()} == split


def test_wide_rows_go_to_ranges_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(chunks, "BYTES_PER_RANGE", 20_000)
    df = spark.range(200).select((F.col("id") % 2).alias("b"), "id", F.repeat(F.lit("y"), F.when(F.col("id") % 2 == 0, 1000).otherwise(1).cast("int")).alias("t"))
    plan = plan_of(chunks.chunk_rows_of(df, 30, "b", ["id"], bytes_per_task=50_000).frame)
    assert "Union" in plan and "Window" in plan  # batch 0 by ranges, batch 1 by a window
    found = sizes(assign_chunks(df, 30, "b", ["id"], bytes_per_task=50_000), "b", "chunk")
    assert found == {(b, c): n for b in (0, 1) for c, n in ((1, 30), (2, 30), (3, 30), (4, 10))}


def test_bytes_of_rows(spark):
    df = spark.sql("""
        select 1 as i, 2L as l, 'abc' as s, cast(null as string) as n, array(1, 2) as a, array('x', 'yz') as t,
               named_struct('p', 1.5D, 'q', 'é') as r, map('k', 5) as m, cast(null as array<string>) as o""")
    assert df.select(chunks.row_bytes(df).alias("n")).first().n == 4 + 8 + (4 + 3) + 4 + (4 + 8) + (4 + 2 * 4 + 3) + (8 + 4 + 2) + (4 + 4 + 1 + 4 + 4) + 4


def test_counting_reads_no_column_of_one_size(tables):
    lineitem = tables("lineitem")
    width = chunks.row_bytes(lineitem.select("l_orderkey", "l_extendedprice", "l_returnflag"))
    plan = plan_of(lineitem.groupBy("l_returnflag").agg(F.sum(width)))
    assert "ReadSchema: struct<l_returnflag:string>" in plan


def test_many_chunks_are_dealt_to_writing_tasks(spark):
    from geoferry.sources import chunked

    rows = spark.range(800).selectExpr("id", f"'v-a' as {chunked.BATCH_KEY}", f"cast(id div 8 + 1 as int) as {chunked.CHUNK}").coalesce(1)
    dealt = chunked.spread_chunks(rows, None, 100, 800, ["id"])
    found = dealt.withColumn("task", F.spark_partition_id()).collect()
    assert dealt.rdd.getNumPartitions() == 4 and len({row.task for row in found}) > 1
    assert len({(row.task, row.chunk) for row in found}) == 100 and sorted(row.id for row in found) == list(range(800))
    assert chunked.spread_chunks(rows, None, chunked.CHUNKS_PER_TASK, 800) is rows
    sizes = spark.createDataFrame([(8,), (9,), (1,)], "n long")
    assert sizes.agg(chunked.chunk_count(F.col("n"), 8)).first()[0] == 4 and sizes.limit(0).agg(chunked.chunk_count(F.col("n"), 8)).first()[0] == 0
