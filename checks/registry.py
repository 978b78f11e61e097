"""Pairs each query with the SQL that gives the same result on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(key: str, sql: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[key] = query
        ORACLES[key] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A total order of lineitem, which has no natural key.
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
LINEITEM_ORDER_SQL = ", ".join(LINEITEM_ORDER)

EVENT_BATCH_SQL = "case when event_type <> 'error' then event_type end"


def events_with_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, with a batch column that is null for one of the types."""
    return table(spark, sf_dir, "events").withColumn("kind", F.expr(EVENT_BATCH_SQL))


# Points spread over the globe, from a key.
def longitude(key: str) -> Column:
    return ((F.col(key) * 7919) % 36000).cast("double") / 100 - 180


def latitude(key: str) -> Column:
    return ((F.col(key) * 104729) % 17000).cast("double") / 100 - 85


def longitude_sql(key: str) -> str:
    return f"(cast(({key} * 7919) % 36000 as double) / 100 - 180)"


def latitude_sql(key: str) -> str:
    return f"(cast(({key} * 104729) % 17000 as double) / 100 - 85)"


def number_sql(value: str, decimals: int = 9) -> str:
    """A number as it stands in WKT."""
    return f"regexp_replace(cast(cast({value} as decimal(38, {decimals})) as varchar), '\\.?0+$', '')"


def exact_sql(value: str) -> str:
    """A number with all its digits as it stands in WKT; of a size that is written without an exponent."""
    return f"regexp_replace(cast({value} as varchar), '\\.0$', '')"
