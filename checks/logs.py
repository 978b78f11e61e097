"""Upserts, log rows and the service registry."""

from __future__ import annotations

from pyspark.sql import functions as F

import geoferry as gf
from checks.registry import check, table


def _customers_of(spark, sf_dir, is_open):
    """Customers of the open orders, or of all others."""
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus").eqNullSafe("O") == is_open)
        .groupBy("o_custkey")
        .agg(
            F.max("o_orderkey").alias("last_order"),
            F.count(F.lit(1)).alias("n_orders"),
            F.nullif(F.min("o_orderpriority"), F.lit("1-URGENT")).alias("priority"),
        )
    )


_CUSTOMERS_SQL = """
    with f as (
        select o_custkey, max(o_orderkey) as last_order, count(*) as n_orders,
               nullif(min(o_orderpriority), '1-URGENT') as priority
        from orders where o_orderstatus is distinct from 'O' group by o_custkey
    ), o as (
        select o_custkey, max(o_orderkey) as last_order, count(*) as n_orders,
               nullif(min(o_orderpriority), '1-URGENT') as priority
        from orders where o_orderstatus = 'O' group by o_custkey
    )
    select coalesce(o.o_custkey, f.o_custkey) as o_custkey,
           case when o.o_custkey is not null then o.last_order else f.last_order end as last_order,
           case when o.o_custkey is not null then o.n_orders else f.n_orders end as n_orders,
           case when o.o_custkey is not null then o.priority else f.priority end as priority
    from f full join o on f.o_custkey = o.o_custkey
    """


@check("upsert_attempt_log", _CUSTOMERS_SQL)
def upsert_attempt_log(spark, sf_dir):
    return gf.upsert(_customers_of(spark, sf_dir, False), _customers_of(spark, sf_dir, True), ["o_custkey"])


@check("attempt_log_state", _CUSTOMERS_SQL)
def attempt_log_state(spark, sf_dir):
    """The same result, as the state of a log that only grows."""
    log = _customers_of(spark, sf_dir, False).withColumn("seq", F.lit(1)).unionByName(
        _customers_of(spark, sf_dir, True).withColumn("seq", F.lit(2))
    )
    return gf.current_state(log, ["o_custkey"], "seq")


def _supplies_of(spark, sf_dir, status):
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_linestatus") == status)
        .groupBy("l_suppkey", "l_returnflag")
        .agg(
            F.count(F.lit(1)).alias("n_items"),
            F.max("l_partkey").alias("max_part"),
            F.min("l_partkey").alias("min_part"),
            F.when(F.max("l_quantity") < 50, F.max("l_quantity")).alias("top_quantity"),
        )
    )


_SUPPLY_KEYS = ["l_suppkey", "l_returnflag"]
_SUPPLY_UPDATED = ["n_items", "top_quantity"]
_SUPPLIES_SQL = """
    with f as (
        select l_suppkey, l_returnflag, count(*) as n_items, max(l_partkey) as max_part, min(l_partkey) as min_part,
               case when max(l_quantity) < 50 then max(l_quantity) end as top_quantity
        from lineitem where l_linestatus = 'F' group by all
    ), o as (
        select l_suppkey, l_returnflag, count(*) as n_items, max(l_partkey) as max_part, min(l_partkey) as min_part,
               case when max(l_quantity) < 50 then max(l_quantity) end as top_quantity
        from lineitem where l_linestatus = 'O' group by all
    )
    select coalesce(f.l_suppkey, o.l_suppkey) as l_suppkey, coalesce(f.l_returnflag, o.l_returnflag) as l_returnflag,
           case when o.l_suppkey is not null then o.n_items else f.n_items end as n_items,
           case when f.l_suppkey is not null then f.max_part else o.max_part end as max_part,
           case when f.l_suppkey is not null then f.min_part else o.min_part end as min_part,
           case when o.l_suppkey is not null then o.top_quantity else f.top_quantity end as top_quantity
    from f full join o on f.l_suppkey = o.l_suppkey and f.l_returnflag = o.l_returnflag
    """


@check("upsert_batch_log", _SUPPLIES_SQL)
def upsert_batch_log(spark, sf_dir):
    target, source = _supplies_of(spark, sf_dir, "F"), _supplies_of(spark, sf_dir, "O")
    return gf.upsert(target, source, _SUPPLY_KEYS, _SUPPLY_UPDATED)


@check("batch_log_state", _SUPPLIES_SQL)
def batch_log_state(spark, sf_dir):
    log = _supplies_of(spark, sf_dir, "F").withColumn("seq", F.lit(1)).unionByName(
        _supplies_of(spark, sf_dir, "O").withColumn("seq", F.lit(2))
    )
    return gf.current_state(log, _SUPPLY_KEYS, "seq", _SUPPLY_UPDATED)


@check(
    "ingest_log_rows",
    """
    with layers as (
        select cast(page_id as varchar) as item_id, '0' as sublayer_id, url as layer_url,
               split_part(url, '/', -1) as layer_name, 'main.t_' || page_id as target_path,
               timestamp '2024-01-01 00:00:00.000001' + to_seconds(page_id) as started,
               length(html) > 2000 as ok
        from pages
    )
    select 'load-1' as load_id,
           md5(target_path || '-' || strftime(started, '%Y-%m-%d %H:%M:%S.%f')) as layer_attempt_id,
           item_id, sublayer_id, layer_url, layer_name, target_path,
           strftime(started, '%Y-%m-%d %H:%M:%S.%f') as timestamp,
           case when ok then 'Complete' else 'Failed' end as status,
           case when not ok then 'too short' end as error_message
    from layers
    """,
)
def ingest_log_rows(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    started = F.expr("timestamp_ntz'2024-01-01 00:00:00.000001' + make_dt_interval(0, 0, 0, page_id)")
    ok = F.length("html") > 2000
    layers = pages.select(
        F.col("page_id").cast("string").alias("item_id"),
        F.lit("0").alias("sublayer_id"),
        F.col("url").alias("layer_url"),
        F.element_at(F.split("url", "/"), -1).alias("layer_name"),
        F.concat(F.lit("main.t_"), F.col("page_id").cast("string")).alias("target_path"),
        started.alias("started"),
        ok.alias("ok"),
    )
    status = F.when(F.col("ok"), "Complete").otherwise("Failed")
    return gf.ingest_log_rows(layers, "load-1", status, F.when(~F.col("ok"), "too short"))


@check(
    "batch_log_rows",
    """
    with groups as (
        select o_custkey, o_orderstatus, o_orderpriority, max(o_orderdate) as last_date, count(*) as n
        from orders group by all
    ), entries as (
        select *, case o_orderstatus when 'F' then 'Success' when 'O' then 'Failed' else 'Timeout' end as status
        from groups
    )
    select cast(o_custkey as varchar) as batch, 'orders' as target_svc_name, cast(null as varchar) as target_server_url,
           'o_custkey' as batch_by_column, cast(null as varchar) as layer_id, 'append' as write_mode,
           cast(null as varchar) as user, last_date as load_timestamp, status,
           case when o_orderpriority = '5-LOW' or o_orderpriority = '2-HIGH'
                then case when status = 'Success' then 'Complete' else 'Unknown error' end
                else o_orderpriority end as message,
           n as retry_attempts
    from entries
    """,
)
def batch_log_rows(spark, sf_dir):
    groups = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", "o_orderstatus", "o_orderpriority")
        .agg(F.max("o_orderdate").alias("last_date"), F.count(F.lit(1)).alias("n"))
    )
    state = F.col("o_orderstatus")
    priority = F.col("o_orderpriority")
    rows = gf.batch_log_rows(
        groups,
        batch=F.col("o_custkey"),
        target_svc_name="orders",
        batch_by_column="o_custkey",
        status=F.when(state == "F", "Success").when(state == "O", "Failed").otherwise("Timeout"),
        message=F.when(priority == "2-HIGH", "").otherwise(F.nullif(priority, F.lit("5-LOW"))),
        write_mode="append",
        load_timestamp=F.col("last_date"),
        retry_attempts=F.col("n"),
    )
    return rows.withColumn("load_timestamp", F.col("load_timestamp").cast("timestamp_ntz"))


_LAYER = "struct<id:int,name:string,url:string>"


def _services(spark, sf_dir):
    """A registry made of the pages: every kind of type, owner, layers and tables."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"),
        F.element_at(F.split("url", "/"), -1).alias("title"),
        F.expr("case when page_id % 5 = 0 then 'Web Map' else 'Feature Service' end").alias("type"),
        F.expr("case when page_id % 2 = 0 then 'ann' else 'bob' end").alias("owner"),
        "url",
        F.expr(
            f"""case page_id % 4
                when 1 then array(named_struct('id', null, 'name', null, 'url', url))
                when 2 then array(named_struct('id', 0, 'name', concat('Layer ', page_id), 'url', concat(url, '/0')),
                                  named_struct('id', 1, 'name', null, 'url', concat(url, '/1')))
                when 3 then array() end"""
        ).cast(f"array<{_LAYER}>").alias("layers"),
        F.expr(
            """case when page_id % 3 = 0 then
                array(named_struct('id', 7, 'name', concat('Table ', page_id), 'url', concat(url, '/7'))) end"""
        ).cast(f"array<{_LAYER}>").alias("tables"),
    )


@check(
    "find_service",
    """
    with services as (
        select page_id as id, split_part(url, '/', -1) as title, url from pages
        where page_id % 5 <> 0 and page_id % 2 = 1
    ), first as (
        select title, url, id from services qualify row_number() over (partition by title order by id) = 1
    ), names as (
        select p_partkey as probe, cast(p_partkey as varchar) as name from part
        union all select -1 - page_id, split_part(url, '/', -1) from pages
    )
    select probe, name, title is not null as found, url, id from names left join first on name = title
    """,
)
def find_service(spark, sf_dir):
    """Looks up part numbers, which are the titles of some pages, and the titles of all pages."""
    numbers = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("probe"), F.col("p_partkey").cast("string").alias("name")
    )
    titles = table(spark, sf_dir, "pages").select(
        (-1 - F.col("page_id")).alias("probe"), F.element_at(F.split("url", "/"), -1).alias("name")
    )
    return gf.find_service(_services(spark, sf_dir), numbers.union(titles), owner="bob")


@check(
    "services_to_create",
    """
    with names as (select distinct cast(p_partkey as varchar) as name from part)
    select name as title, 'Feature Service' as type, 'bob' as owner, 'Service for ' || name as description,
           'automated_creation' as tags
    from names
    where not exists (
        select 1 from pages where split_part(url, '/', -1) = name and page_id % 5 <> 0 and page_id % 2 = 1)
    """,
)
def services_to_create(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("name"))
    found = gf.find_service(_services(spark, sf_dir), names, owner="bob")
    return gf.services_to_create(found, owner="bob").withColumn("tags", F.array_join("tags", "|"))


@check(
    "service_layers",
    """
    with entries as (
        select page_id as service_id, 0 as position, cast(null as varchar) as name, cast(null as integer) as id
        from pages where page_id % 4 = 1
        union all select page_id, 0, 'Layer ' || page_id, 0 from pages where page_id % 4 = 2
        union all select page_id, 1, null, 1 from pages where page_id % 4 = 2
        union all select page_id, case page_id % 4 when 1 then 1 when 2 then 2 else 0 end, 'Table ' || page_id, 7
        from pages where page_id % 3 = 0
    )
    select service_id, cast(position as integer) as position, name, id from entries
    """,
)
def service_layers(spark, sf_dir):
    return gf.service_layers(_services(spark, sf_dir))


@check(
    "enumerate_layers",
    """
    select cast(page_id as varchar) as item_id, true as has_layers, 'N/A' as sublayer_id,
           split_part(url, '/', -1) as layer_name, url as layer_url
    from pages where page_id % 4 = 1
    union all select cast(page_id as varchar), true, '0', 'Layer ' || page_id, url || '/0' from pages where page_id % 4 = 2
    union all select cast(page_id as varchar), true, '1', '1', url || '/1' from pages where page_id % 4 = 2
    union all select cast(page_id as varchar), false, null, null, null from pages where page_id % 4 in (0, 3)
    """,
)
def enumerate_layers(spark, sf_dir):
    return gf.enumerate_layers(_services(spark, sf_dir)).drop("layer")
