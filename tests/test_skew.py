"""One key holds a third of the rows: the plans must not leave it to one task."""

import pytest
from pyspark.sql import functions as F

import geoferry as gf
from geoferry.operators import chunks

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
}


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, with partitions called skewed early."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def hot(spark, n=120_000, parts=6):
    """A third of the keys are 0; the rest are all different."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") + 1)
    return spark.range(0, n, 1, parts).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


def final_plan(df):
    rows = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") == "new").alias("new"))
    first = rows.collect()[0]
    return first, rows._jdf.queryExecution().executedPlan().toString()


def test_hot_key_in_the_target(spark, shuffled):
    source = spark.range(0, 3000).select((F.col("id") * 3).alias("k"), F.lit("new").alias("v"))
    counts, plan = final_plan(gf.upsert(hot(spark), source, ["k"]))
    # The 40,000 rows of key 0 are updated, and so is every third other key below 9,000.
    matched = 40_000 + sum(1 for i in range(9000) if i % 3 and (i + 1) % 3 == 0 and i + 1 < 9000)
    assert counts.new == matched + (3000 - 1 - (matched - 40_000))
    assert counts.n == 120_000 + 3000 - 1 - (matched - 40_000)
    assert "skew=true" in plan


def test_hot_key_in_the_source(spark, shuffled):
    target = spark.range(1, 3000).select((-F.col("id")).alias("k"), F.lit("old").alias("v"))
    counts, plan = final_plan(gf.upsert(target, hot(spark), ["k"]))
    assert counts.n == 2999 + 120_000
    assert "skew=true" in plan


def test_hot_name(spark, shuffled):
    names = hot(spark).select(F.col("k").cast("string").alias("name"), "v")
    services = spark.range(5000).select(
        F.col("id").cast("string").alias("title"), "id", F.lit("Feature Service").alias("type"), F.lit("u").alias("url")
    )
    counts, plan = final_plan(gf.find_service(services, names).where("found"))
    assert counts.n == 40_000 + sum(1 for i in range(4999) if i % 3)
    assert "skew=true" in plan


def test_hot_title_is_grouped_before_its_shuffle(spark):
    services = hot(spark).select(
        F.col("k").cast("string").alias("title"), F.col("v").alias("id"), F.lit("Feature Service").alias("type"), F.lit("u").alias("url")
    )
    names = spark.createDataFrame([("0",)], "name string")
    plan = gf.find_service(services, names)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(" in plan


def test_hot_batch_is_spread_and_the_rest_is_not(spark, monkeypatch):
    monkeypatch.setattr(chunks, "ROWS_PER_RANGE", 5000)
    df = hot(spark, 60_000)
    chunked = chunks.chunk_rows_of(df, 1000, "k", ["v"], rows_per_task=1000)
    ranges = spark.read.parquet(chunked.staged[-1])
    assert ranges.count() == 20_000
    assert ranges.groupBy("__part").count().agg(F.max("count")).first()[0] < 7000
    found = chunked.frame.groupBy("k", "chunk").count()
    assert found.where("k = 0").count() == 20 and found.where("k = 0 and count = 1000").count() == 20
    assert found.where("k <> 0 and chunk = 1 and count = 1").count() == 40_000
