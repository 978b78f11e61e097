"""Names, descriptions, tags, dates and ids over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check, table
from geoferry.fixed_values import WGS84_WKT
from geoferry.functions import markdown, text


@check(
    "clean_table_name",
    r"""
    with names as (
        select p_partkey, case p_partkey % 4
            when 0 then p_name || ' (' || p_type || ') - ' || p_brand
            when 1 then '__' || p_name || '_-' || p_brand || '__'
            when 2 then repeat(p_name || '/', 40)
            else p_name end as name,
            case when p_partkey % 3 = 0 then '' else p_type end as prefix
        from part
    )
    select p_partkey, substr(lower(trim(regexp_replace(
        concat_ws('_', nullif(prefix, ''), name, 'v1'), '[^a-zA-Z0-9_]+', '_', 'g'), '_')), 1, 255) as table_name
    from names
    """,
)
def clean_table_name(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    which = F.col("p_partkey") % 4
    name = (
        F.when(which == 0, F.concat("p_name", F.lit(" ("), "p_type", F.lit(") - "), "p_brand"))
        .when(which == 1, F.concat(F.lit("__"), "p_name", F.lit("_-"), "p_brand", F.lit("__")))
        .when(which == 2, F.repeat(F.concat("p_name", F.lit("/")), 40))
        .otherwise(F.col("p_name"))
    )
    prefix = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.col("p_type"))
    return part.select("p_partkey", text.clean_table_name(name, prefix, F.lit("v1")).alias("table_name"))


# The conversion in SQL, for the tags of the pages: a table of tokens, numbered blocks, and text put together again.
_BLOCKS_SQL = "'p', 'li', 'ul', 'div', 'nav', 'article', 'h1', 'footer', 'html', 'body'"


def _decoded_sql(text: str) -> str:
    for name, character in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"')):
        text = f"replace({text}, '{name}', '{character}')"
    return f"regexp_replace({text}, '&amp;?', '&', 'g')"


MARKDOWN_SQL = rf"""
    with cleaned as (
        select page_id, regexp_replace(coalesce(html, ''),
            '(?is)<!--.*?-->|<script[\s>].*?</script\s*>|<style[\s>].*?</style\s*>|<head[\s>].*?</head\s*>', '', 'g') as h
        from pages
    ), listed as (
        select page_id, regexp_extract_all(h, '(?s)<[^>]*>|[^<]+|<') as found from cleaned
    ), tokens as (
        select page_id, unnest(found) as token, unnest(range(len(found))) as pos from listed
    ), tagged as (
        select *, lower(regexp_extract(token, '^</?([a-zA-Z][a-zA-Z0-9]*)', 1)) as tag, token like '</%' as is_end,
               nullif(regexp_extract(token, '(?i)^<a\s[^>]*href="([^"]*)"', 1), '') as own_href
        from tokens
    ), placed as (
        select *, sum(case when tag in ({_BLOCKS_SQL}) then 1 else 0 end) over w as block,
               last_value(own_href ignore nulls) over w as href
        from tagged window w as (partition by page_id order by pos rows between unbounded preceding and current row)
    ), joined as (
        select page_id, block, bool_or(tag = 'li' and not is_end) as is_item, bool_or(tag = 'h1' and not is_end) as is_title,
               bool_or(tag = 'b' and not is_end) as is_bold,
               string_agg(case when tag = 'a' and is_end then '](' || {_decoded_sql("href")} || ')' when tag = 'a' then '['
                               when tag = 'b' then '**' when tag = 'br' then chr(1)
                               when tag = '' and token not like '<_%' then {_decoded_sql("token")} else '' end, '' order by pos) as body
        from placed group by page_id, block
    ), trimmed as (
        select * replace (trim(regexp_replace(regexp_replace(body, '[ \t\r\n\f]+', ' ', 'g'), ' ?\x01 ?', chr(1), 'g'),
                               ' ' || chr(1)) as body)
        from joined
    ), whole as (
        select page_id, block, is_item, case when is_item then '  * ' when is_title then '# ' else '' end
               || replace(body, chr(1), '  ' || chr(10)) || case when is_bold then '**' else '' end as line
        from trimmed where body not in ('', '**')
    ), apart as (
        select *, case when lag(is_item) over w is null then '' when is_item and lag(is_item) over w then chr(10)
                       else chr(10) || chr(10) end as gap
        from whole window w as (partition by page_id order by block)
    )
    select page_id, coalesce(markdown, '') as markdown
    from pages left join (select page_id, string_agg(gap || line, '' order by block) as markdown from apart group by page_id) using (page_id)
    """


@check("html_to_markdown", MARKDOWN_SQL)
def html_to_markdown(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", markdown.html_to_markdown(F.col("html")).alias("markdown"))


@check(
    "compose_description",
    f"""
    select c_custkey,
           '# Table Name : ' || lower(c_name) || chr(10)
           || '- ArcGIS Online ID: `' || c_custkey || '`' || chr(10)
           || '- Description: ' || case when c_custkey % 2 = 0 then c_mktsegment else '' end
           || case when n_name <> 'NATION_3' then
                chr(10) || chr(10) || '--- Parent Item Description ---' || chr(10) || n_name else '' end || chr(10)
           || '- Spatial Reference Properties:' || chr(10)
           || '    - Geometry Column : ' || case when c_custkey % 3 = 0 then 'shape' else 'None' end || chr(10)
           || '    - Spatial Reference WKID : ' || case when c_custkey % 3 = 0 then '4326' else 'None' end || chr(10)
           || '    - Spatial Reference WKT : ' || case when c_custkey % 3 = 0 then '{WGS84_WKT}' else 'None' end
           || chr(10)
           || '    - Spatial Reference is Projected : ' || case when c_custkey % 3 = 0 then 'False' else 'None' end
           || chr(10)
           || '    - Spatial Reference Units : ' || case when c_custkey % 3 = 0 then 'Degree' else 'None' end || chr(10)
           || '    - Spatial Reference Name : ' || case when c_custkey % 3 = 0 then 'GCS_WGS_1984' else 'None' end
           || chr(10) as description
    from customer join nation on c_nationkey = n_nationkey
    """,
)
def compose_description(spark, sf_dir):
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    placed = F.col("c_custkey") % 3 == 0
    entries = {
        "geometry_column": F.when(placed, "shape"),
        "wkid": F.when(placed, 4326),
        "wkt": F.when(placed, WGS84_WKT),
        "is_projected": F.when(placed, False),
        "units": F.when(placed, "Degree"),
        "name": F.when(placed, text.geogcs_name(F.lit(WGS84_WKT))),
    }
    description = text.compose_description(
        F.lower("c_name"),
        F.col("c_custkey").cast("string"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")),
        F.when(F.col("n_name") != "NATION_3", F.col("n_name")).otherwise(" "),
        entries,
    )
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", description.alias("description")
    )


@check(
    "normalize_tags",
    r"""
    select p_partkey, array_to_string(list_sort(list_distinct(list_transform(
        list_filter(list_concat(string_split(p_name, ' '), [p_type, p_brand || '-1.x', null, '', p_name]),
                    lambda t: t is not null and t <> ''),
        lambda t: substr(regexp_replace(t, '[.,\-=/:]', '_', 'g'), 1, 255)))), '|') as tags
    from part
    """,
)
def normalize_tags(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    parent = F.split("p_name", " ")
    layer = F.array("p_type", F.concat("p_brand", F.lit("-1.x")), F.lit(None), F.lit(""), F.col("p_name"))
    return part.select("p_partkey", F.array_join(text.normalize_tags(parent, layer), "|").alias("tags"))


@check(
    "epoch_millis_to_string",
    "select event_id, strftime(epoch_ms(epoch_us(ts) // 1000), '%Y-%m-%d %H:%M:%S') as moment from events",
)
def epoch_millis_to_string(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select("event_id", text.epoch_millis_to_string(millis).alias("moment"))


@check(
    "attempt_id",
    """
    select event_id, md5('events.' || event_type || '-' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) as attempt_id
    from events
    """,
)
def attempt_id(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = F.concat(F.lit("events."), "event_type")
    return events.select("event_id", text.attempt_id(path, F.col("ts")).alias("attempt_id"))
