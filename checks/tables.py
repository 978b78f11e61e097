"""Sources, sinks, projections, batches and chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

import geoferry as gf
from checks.registry import (
    EVENT_BATCH_SQL,
    LINEITEM_ORDER,
    LINEITEM_ORDER_SQL,
    check,
    events_with_batch,
    table,
)
from geoferry.workspace import new_folder


@check(
    "layer_read",
    """
    select l_orderkey, l_linenumber, l_quantity, l_extendedprice
    from lineitem where l_returnflag = 'A'
    """,
)
def layer_read(spark, sf_dir):
    return gf.layer_read(
        spark,
        f"{sf_dir}/lineitem.parquet",
        columns=["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"],
        where=F.col("l_returnflag") == "A",
    )


@check(
    "table_overwrite_merge_schema",
    "select c_custkey, cast(null as varchar) as c_name, c_acctbal from customer",
)
def table_overwrite_merge_schema(spark, sf_dir):
    target = new_folder(spark, "customer")
    customer = table(spark, sf_dir, "customer")
    gf.overwrite_merge_schema(customer.select("c_custkey", "c_name"), target)
    gf.overwrite_merge_schema(customer.select("c_custkey", "c_acctbal"), target)
    return spark.read.parquet(target)


@check(
    "table_overwrite_merge_structs",
    """
    select c_custkey, cast(null as varchar) as name, cast(null as bigint) as nation, c_mktsegment as segment,
           cast(null as double) as balance, c_name as holder, c_acctbal < 0 as is_negative
    from customer
    """,
)
def table_overwrite_merge_structs(spark, sf_dir):
    """Structs, also in an array, that gain fields and keep those they had."""
    target = new_folder(spark, "customer")
    customer = table(spark, sf_dir, "customer")
    first = ["named_struct('name', c_name, 'place', named_struct('nation', cast(c_nationkey as bigint))) as info", "array(named_struct('balance', c_acctbal)) as accounts"]
    second = ["named_struct('place', named_struct('segment', c_mktsegment), 'negative', c_acctbal < 0) as info", "array(named_struct('holder', c_name)) as accounts"]
    gf.overwrite_merge_schema(customer.selectExpr("c_custkey", *first), target)
    gf.overwrite_merge_schema(customer.selectExpr("c_custkey", *second), target)
    return spark.read.parquet(target).selectExpr(
        "c_custkey", "info.name", "info.place.nation", "info.place.segment", "accounts[0].balance as balance", "accounts[0].holder as holder", "info.negative as is_negative"
    )


@check("table_append", "select * from orders")
def table_append(spark, sf_dir):
    target = new_folder(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    gf.append(orders.where(F.col("o_orderstatus") == "F"), target)
    gf.append(orders.where(F.col("o_orderstatus").isNull() | (F.col("o_orderstatus") != "F")), target)
    return spark.read.parquet(target)


@check(
    "chunked_write",
    f"""
    with numbered as (
        select *, row_number() over (partition by l_returnflag order by {LINEITEM_ORDER_SQL}) as rn from lineitem
    )
    select l_returnflag as batch, cast((rn - 1) // 5000 + 1 as integer) as chunk, count(*) as n_rows,
           cast(sum(l_partkey) as bigint) as sum_partkey
    from numbered group by all
    """,
)
def chunked_write(spark, sf_dir):
    target = new_folder(spark, "chunks")
    lineitem = table(spark, sf_dir, "lineitem")
    # What was there before must be gone after an overwrite.
    lineitem.where("l_returnflag = 'N'").write.parquet(target)
    gf.chunked_write(lineitem, target, 5000, "l_returnflag", LINEITEM_ORDER)
    return (
        gf.read_chunked(spark, target, lineitem.schema)
        .groupBy(F.col("l_returnflag").alias("batch"), "chunk")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_partkey").alias("sum_partkey"))
    )


@check(
    "batch_export",
    f"""
    select {EVENT_BATCH_SQL} as batch, count(*) as n_rows, cast(sum(event_id) as bigint) as sum_event_id,
           round(sum(value), 2) as sum_value, 'Success' as status,
           cast(case when event_type in ('click', 'error') then 2 else 1 end as bigint) as attempts
    from events group by all
    """,
)
def batch_export(spark, sf_dir):
    """Two batches get lost on the first attempt; the second writes just those."""
    from geoferry.plans.export import write_partitions

    def failing(rows, target, overwrite, attempt):
        kept = rows.where(F.col("kind").isNotNull() & (F.col("kind") != "click")) if attempt == 1 else rows
        write_partitions(kept, target, overwrite, attempt)

    events = events_with_batch(spark, sf_dir)
    target, log_path = new_folder(spark, "export"), new_folder(spark, "export-log")
    gf.batch_export(
        events,
        target,
        "kind",
        service="events",
        chunk_rows=700,
        order_by=["event_id"],
        retry_delay_seconds=0,
        log_path=log_path,
        sink=failing,
    )
    found = (
        gf.read_export(spark, target, events.schema)
        .groupBy(F.col("kind").alias("batch"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("event_id").alias("sum_event_id"),
            F.round(F.sum("value"), 2).alias("sum_value"),
        )
    )
    log = gf.batch_log(spark, log_path).select(
        F.col("batch").alias("logged"), "status", F.col("retry_attempts").alias("attempts")
    )
    return found.join(log, F.col("batch").eqNullSafe(F.col("logged")), "left").drop("logged")


@check(
    "export_layers",
    f"""
    with batches as (
        select 'events' as layer, {EVENT_BATCH_SQL} as batch, count(*) as n_rows, 0 as layer_id from events group by all
        union all select 'all orders', o_orderpriority, count(*), 1 from orders group by all
    )
    select layer, batch, n_rows, 'Success' as status, cast(1 as bigint) as attempts, cast(layer_id as integer) as layer_id,
           md5('Feature Service||shop') as service_id, 'services/' || md5('Feature Service||shop') || '/' || layer_id as layer_url,
           cast(2 as bigint) as n_versions, cast(0 as bigint) as n_pending
    from batches
    """,
)
def export_layers(spark, sf_dir):
    """Two layers of a service that was not there, and again the registration, which then changes nothing."""
    target, log_path, registry = (new_folder(spark, name) for name in ("export", "export-log", "registry"))
    layers = {"events": (events_with_batch(spark, sf_dir), "kind"), "all orders": (table(spark, sf_dir, "orders"), "o_orderpriority")}
    found, pending = [], []
    for layer, (rows, batch) in layers.items():
        gf.batch_export(rows, target, batch, service="shop", layer=layer, registry=registry, log_path=log_path, retry_delay_seconds=0)
        export = gf.read_export(spark, target, rows.schema, layer)
        found.append(export.groupBy(F.lit(layer).alias("layer"), F.col(batch).alias("batch")).agg(F.count(F.lit(1)).alias("n_rows")))
        left = gf.pending_batches(gf.batch_keys(rows, batch), gf.batch_log(spark, log_path), batch, "shop", layer=layer)
        pending.append(left.agg(F.count(F.lit(1)).alias("n_pending")).withColumn("layer", F.lit(layer)))
    wanted = spark.createDataFrame([("shop", layer) for layer in layers], "name string, layer_name string")
    places = gf.ensure_layers(spark, registry, wanted).select(F.col("layer_name").alias("layer"), "service_id", "layer_id", "layer_url")
    n_versions = spark.read.parquet(registry).count()
    log = gf.batch_log(spark, log_path).select(
        F.col("layer_name").alias("layer"), F.col("batch").alias("logged"), "status", F.col("retry_attempts").alias("attempts")
    )
    rows, left = found[0].union(found[1]), pending[0].union(pending[1])
    logged = rows.join(log, (rows["layer"] == log["layer"]) & F.col("batch").eqNullSafe(F.col("logged")), "left").drop(log["layer"], "logged")
    return logged.join(places, "layer", "left").join(left, "layer").withColumn("n_versions", F.lit(n_versions).cast("bigint"))


@check(
    "pending_batches",
    """
    with keys as (
        select distinct case when o_orderpriority <> '1-URGENT' then cast(o_custkey as varchar) end as batch from orders
    ), done as (
        select distinct cast(o_custkey as varchar) as batch from orders where o_orderstatus = 'F'
    )
    select batch from keys
    where not exists (select 1 from done where done.batch is not distinct from keys.batch)
    """,
)
def pending_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    keyed = orders.select(F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey").cast("string")).alias("batch"))
    status = F.when(F.col("o_orderstatus") == "F", "Success").otherwise("Failed")
    log = gf.batch_log_rows(orders, F.col("o_custkey"), "orders", "o_custkey", status)
    return gf.pending_batches(gf.batch_keys(keyed, "batch"), log, "batch", "orders")


@check("batch_subset", f"select event_id, user_id, value from events where {EVENT_BATCH_SQL} is null")
def batch_subset(spark, sf_dir):
    return gf.batch_subset(events_with_batch(spark, sf_dir), "kind", None).select("event_id", "user_id", "value")


@check(
    "stringify_columns",
    """
    select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
           cast(o_orderstatus as varchar) as o_orderstatus, cast(o_totalprice as varchar) as o_totalprice,
           cast(o_orderdate as varchar) as o_orderdate,
           cast(nullif(o_orderpriority, '5-LOW') as varchar) as o_orderpriority,
           cast(cast(o_orderdate as date) as varchar) as day, cast(o_totalprice > 100000 as varchar) as large
    from orders
    """,
)
def stringify_columns(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "o_orderpriority": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")),
            "day": F.col("o_orderdate").cast("date"),
            "large": F.col("o_totalprice") > 100000,
        }
    )
    return gf.stringify_columns(orders)


@check(
    "conform_schema",
    """
    select try_cast(p_brand as bigint) as p_brand, cast(trunc(p_retailprice) as bigint) as p_retailprice,
           cast(p_partkey as varchar) as p_partkey, cast(p_size as varchar) as p_size, p_name, p_type
    from part
    """,
)
def conform_schema(spark, sf_dir):
    fields = [
        {"name": "p_brand", "type": "esriFieldTypeInteger"},
        {"name": "p_retailprice", "type": "esriFieldTypeInteger"},
        {"name": "p_partkey", "type": "esriFieldTypeString"},
        {"name": "ZZ", "type": "esriFieldTypeDouble"},
        {"name": "p_size", "type": "unheard of"},
    ]
    return gf.conform_schema(table(spark, sf_dir, "part"), fields, strict=False)


@check("batch_keys", f"select distinct {EVENT_BATCH_SQL} as kind from events")
def batch_keys(spark, sf_dir):
    return gf.batch_keys(events_with_batch(spark, sf_dir), "kind")


@check(
    "chunk_manifest",
    f"""
    with numbered as (
        select l_returnflag as batch,
               row_number() over (partition by l_returnflag order by {LINEITEM_ORDER_SQL}) as rn
        from lineitem
    ), chunks as (
        select batch, cast((rn - 1) // 5000 + 1 as integer) as chunk, count(*) as n_rows from numbered group by all
    )
    select batch, chunk, n_rows,
           case when chunk = 1 and batch = (select min(batch) from chunks) then 'overwrite' else 'append' end as write_mode
    from chunks
    """,
)
def chunk_manifest(spark, sf_dir):
    return gf.chunk_manifest(table(spark, sf_dir, "lineitem"), 5000, "l_returnflag")


_CHUNKS_SQL = f"""
    select {LINEITEM_ORDER_SQL}, l_returnflag,
           cast((row_number() over (partition by l_returnflag order by {LINEITEM_ORDER_SQL}) - 1) // 5000 + 1
                as integer) as chunk
    from lineitem
    """


@check("assign_chunks", _CHUNKS_SQL)
def assign_chunks(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER, "l_returnflag")
    return gf.assign_chunks(lineitem, 5000, "l_returnflag", LINEITEM_ORDER)


@check("assign_chunks_large_batches", _CHUNKS_SQL)
def assign_chunks_large_batches(spark, sf_dir):
    """The way for batches too large for one task, taken for every batch."""
    lineitem = table(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER, "l_returnflag")
    return gf.assign_chunks(lineitem, 5000, "l_returnflag", LINEITEM_ORDER, rows_per_task=0)


@check(
    "assign_chunks_global",
    f"""
    select {LINEITEM_ORDER_SQL},
           cast((row_number() over (order by {LINEITEM_ORDER_SQL}) - 1) // 5000 + 1 as integer) as chunk
    from lineitem
    """,
)
def assign_chunks_global(spark, sf_dir):
    """Without batches, and never in one task."""
    lineitem = table(spark, sf_dir, "lineitem").select(*LINEITEM_ORDER)
    return gf.assign_chunks(lineitem, 5000, order_by=LINEITEM_ORDER, rows_per_task=0)
