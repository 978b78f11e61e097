"""The queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoferry.llm import clusters, context_trees, decontamination, html_text, line_dedup, near_dedup, passages, personal_data, pieces, quality_rules, secret_scan, toxicity, whitening
from geoferry.llm.common import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACES_SQL = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def register(key: str, sql: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[key] = query
        if sql:
            ORACLES[key] = sql
        return query

    return add


@register(
    "op1_decontamination",
    f"""
    with words as (
      select doc_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from documents),
    items as (
      select item_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from benchmark),
    windows as (
      select distinct item_id, array_to_string(w[p0 : p0 + 9], ' ') win, least(len(w), 10) n
      from (select item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) p0 from items where len(w) > 0)),
    sizes as (select distinct n from windows),
    places as (
      select doc_id, p0, n, array_to_string(w[p0 : p0 + n - 1], ' ') win
      from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) p0 from words, sizes where len(w) >= n)),
    found as (select p.doc_id, p.p0, p.n, i.item_id from places p join windows i on p.win = i.win and p.n = i.n),
    hits as (
      select doc_id, count(distinct place) n_hit
      from (select doc_id, unnest(range(p0, p0 + n)) place from found) group by doc_id),
    named as (
      select doc_id, count(*) n_items, string_agg(item, ',' order by item) ids
      from (select distinct doc_id, cast(item_id as varchar) item from found) group by doc_id)
    select w.doc_id, cast(len(w.w) as bigint) n_words, coalesce(h.n_hit, 0) n_hit, coalesce(i.n_items, 0) n_items,
           sha256(coalesce(i.ids, '')) items_sha256, coalesce(h.n_hit, 0) > 0 contaminated
    from words w left join hits h using (doc_id) left join named i using (doc_id)""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register(
    "op2_line_dedup",
    f"""
    with lines as (
      select doc_id, unnest(ls) line, unnest(range(len(ls))) p0
      from (select doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents)),
    keyed as (select *, {LOWER_SQL.format("trim(line, " + SPACES_SQL + ")")} k from lines),
    shared as (
      select k, max(doc_id) keeper from keyed where length(k) >= 40
      group by k having count(distinct doc_id) >= 5),
    judged as (
      select l.*, s.k is not null and l.doc_id is distinct from s.keeper dropped from keyed l left join shared s on l.k = s.k)
    select doc_id, count(*) n_lines, cast(sum(cast(dropped as int)) as bigint) n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by p0) filter (not dropped), '')) kept_sha256
    from judged group by doc_id""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup_report(table(spark, sf_dir, "documents"))


@register(
    "op5_quality_rules",
    f"""
    with texts as (
      select doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w,
             list_filter(string_split(t, chr(10)), lambda x: trim(x, {SPACES_SQL}) <> '') ls
      from (select doc_id, coalesce(text, '') t from documents)),
    windows as (
      select doc_id, p0, array_to_string(w[p0 : p0 + 2], ' ') win
      from (select doc_id, w, unnest(range(1, len(w) - 1)) p0 from texts where len(w) >= 3)),
    repeated as (
      select doc_id, p0 from windows qualify count(*) over (partition by doc_id, win) > 1),
    covered as (
      select doc_id, count(distinct place) n from (select doc_id, unnest(range(p0, p0 + 3)) place from repeated) group by doc_id),
    counted as (
      select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) word_chars,
             cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols,
             cast(length(regexp_replace(t, '[^!?]', '', 'g')) as bigint) n_marks,
             cast(len(ls) - len(list_distinct(ls)) as bigint) n_dup_lines, cast(len(ls) as bigint) n_lines,
             coalesce(c.n, 0) n_repeat_words
      from texts left join covered c using (doc_id))
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < {quality_rules.LEAST_WORDS} or 100 * n_repeat_words > {quality_rules.MOST_REPEATED_PERCENT} * n_words base_failed,
           not (n_words < {quality_rules.LEAST_WORDS} or 100 * n_repeat_words > {quality_rules.MOST_REPEATED_PERCENT} * n_words
             or n_symbols > {quality_rules.MOST_SYMBOLS_PER_WORD} * n_words or n_marks > {quality_rules.MOST_MARKS_PER_WORD} * n_words
             or word_chars > {quality_rules.MOST_CHARS_PER_WORD} * n_words
             or (n_lines >= 5 and n_dup_lines > {quality_rules.MOST_DUPLICATE_LINES} * n_lines)) kept
    from counted""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


@register("op6_sentencepiece")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded_report(table(spark, sf_dir, "documents"))


@register("op8_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.with_components(table(spark, sf_dir, "documents"))


@register("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op10_html_extraction")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


@register("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data_report(table(spark, sf_dir, "documents"))


@register("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"), path="source")


@register("op9_passages")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


@register("op11_context_trees")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_trees.language_scores(table(spark, sf_dir, "documents"))


@register("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def _clusters_sql(rounds: int = clusters.ROUNDS) -> str:
    """The rounds one after the other, each a table of its own."""
    parts = [
        f"""
    with kept as materialized (
      select vec_id, list_transform(embedding, lambda x: cast(floor({clusters.SCALE} * cast(x as double)) as bigint)) q
      from embeddings
      where len(embedding) = {clusters.DIMENSIONS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {clusters.DIMENSIONS}),
    c0 as materialized (
      select row_number() over (order by h, q) - 1 c, q
      from (select sha256('{clusters.SEED}:' || coalesce(cast(vec_id as varchar), '')) h, q from kept order by h, q limit {clusters.CENTROIDS}))"""
    ]
    for n in range(rounds + 1):
        parts.append(f"""
    a{n} as materialized (
      select vec_id, q, min(d * {clusters.CENTROIDS} + c) % {clusters.CENTROIDS} c, min(d * {clusters.CENTROIDS} + c) // {clusters.CENTROIDS} d
      from (select k.vec_id, k.q, c.c, cast(list_sum(list_transform(list_zip(k.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) d
            from kept k, c{n} c)
      group by vec_id, q)""")
        if n < rounds:
            parts.append(f"""
    c{n + 1} as materialized (
      select c.c, coalesce(m.q, c.q) q
      from c{n} c left join (
        select c, list((s - ((s % n + n) % n)) // n order by j) q
        from (select c, j, cast(sum(x) as bigint) s, count(*) n from (select c, unnest(q) x, unnest(range(len(q))) j from a{n}) group by c, j)
        group by c) m on m.c = c.c)""")
    return ",".join(parts) + f"""
    select a.vec_id, cast(a.c as int) cluster, a.d distance, cast(sum(a.d) over (partition by a.c) as bigint) cluster_inertia,
           cast(sum(a.d) over () as bigint) inertia, sha256(array_to_string(c.q, ',')) centroid_sha256
    from a{rounds} a join c{rounds} c on a.c = c.c"""


@register("op13_centroids", _clusters_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clusters(table(spark, sf_dir, "embeddings"))
