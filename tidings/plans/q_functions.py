"""Contract queries for scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import prompts as PR
from ..functions.categories import category_map, category_multi
from ..functions.ids import article_id, lexicographic_date, sourced_article_id, sourced_keys
from ..functions.text import (EMBEDDING_MODES, embedding_docs, html_body, html_title, json_payload,
                              provider_domain, strip_wrapping_quotes, token_chunks)
from . import adapters as A
from .catalog import BODY_SQL, DOMAIN_SQL, ISO, PAD6, TITLE_SQL, UUID_SQL, query
from .q_sourcing import cluster_members, with_texts
from .oracle_ctes import with_views

# vendor category words used to label hits (the map keys plus one unmapped word)
BING_WORDS = list(K.BING_CATEGORIES) + ["Other"]
TNA_WORDS = list(K.THENEWSAPI_COM_CATEGORIES) + ["other"]


def _pick(words: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(idx, F.lit(len(words))) + 1).cast("int"))


def _pick_sql(words: list[str], idx: str) -> str:
    lst = "[" + ", ".join(f"'{w}'" for w in words) + "]"
    return f"{lst}[CAST(({idx}) % {len(words)} + 1 AS INTEGER)]"


def _map_sql(expr: str, agg: str) -> str:
    def case(m):
        if not m:
            return "NULL"
        return "CASE " + " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in m.items()) + " END"
    return (f"coalesce(CASE {agg} WHEN 'bingnews' THEN {case(K.BING_CATEGORIES)} "
            f"WHEN 'newsapi.org' THEN {case(K.NEWSAPI_ORG_CATEGORIES)} "
            f"WHEN 'thenewsapi.com' THEN {case(K.THENEWSAPI_COM_CATEGORIES)} END, 'n/a')")


def vendor_category(doc_id: Column, aggregator: Column) -> Column:
    return F.when(aggregator == K.BING, _pick(BING_WORDS, doc_id)).otherwise(_pick(TNA_WORDS, doc_id))


VENDOR_CAT_SQL = (f"CASE WHEN aggregator_id = 'bingnews' THEN {_pick_sql(BING_WORDS, 'doc_id')} "
                  f"ELSE {_pick_sql(TNA_WORDS, 'doc_id')} END")


@query("fn_category_map", with_views(
    f"SELECT event_id, aggregator_id, vendor_category, {_map_sql('vendor_category', 'aggregator_id')} AS category "
    f"FROM (SELECT event_id, aggregator_id, {VENDOR_CAT_SQL} AS vendor_category FROM hits) x", "hits"))
def fn_category_map(spark, sf):
    """Vendor category -> canonical, unmapped -> 'n/a'."""
    h = A.hits(spark, sf).select("event_id", "aggregator_id",
                                 vendor_category(F.col("doc_id"), F.col("aggregator_id")).alias("vendor_category"))
    return h.withColumn("category", category_map(F.col("vendor_category"), F.col("aggregator_id")))


@query("fn_category_multi", with_views(
    f"SELECT event_id, array_to_string(list_transform([{_pick_sql(TNA_WORDS, 'doc_id')}, "
    f"{_pick_sql(TNA_WORDS, 'doc_id + 3')}], lambda c: {_map_sql('c', chr(39) + 'thenewsapi.com' + chr(39))}), ',') AS categories "
    "FROM hits WHERE aggregator_id = 'thenewsapi.com'", "hits"))
def fn_category_multi(spark, sf):
    """A list of vendor categories mapped one by one and joined with ','."""
    h = A.hits(spark, sf).filter(F.col("aggregator_id") == K.THENEWSAPI_COM)
    cats = F.array(_pick(TNA_WORDS, F.col("doc_id")), _pick(TNA_WORDS, F.col("doc_id") + 3))
    return h.select("event_id", category_multi(cats, F.col("aggregator_id")).alias("categories"))


@query("fn_article_id", with_views(
    f"SELECT event_id, {PAD6('event_id * 211')} || '#' || {UUID_SQL('topic_id', 'aggregator_id', 'url')} AS article_id "
    "FROM hits", "hits"))
def fn_article_id(spark, sf):
    """Zero-padded index (never truncated) + '#' + uuid-shaped key hash."""
    h = A.hits(spark, sf)
    return h.select("event_id", article_id(F.col("event_id") * 211, F.col("topic_id"), F.col("aggregator_id"),
                                           F.col("url")).alias("article_id"))


@query("fn_provider_domain", f"SELECT page_id, url, {DOMAIN_SQL('url')} AS provider_domain FROM pages")
def fn_provider_domain(spark, sf):
    """URL -> provider domain."""
    p = A.read(spark, sf, "pages")
    return p.select("page_id", "url", provider_domain(F.col("url")).alias("provider_domain"))


@query("fn_html_article", f"""
SELECT page_id, title, md5(body) AS body_md5, length(body) AS body_chars FROM (
  SELECT page_id, {TITLE_SQL('html')} AS title, {BODY_SQL('html')} AS body FROM pages) x""")
def fn_html_article(spark, sf):
    """Page -> title + visible body text."""
    p = A.read(spark, sf, "pages").select("page_id", html_title(F.col("html")).alias("title"),
                                          html_body(F.col("html")).alias("body"))
    return p.select("page_id", "title", F.md5("body").alias("body_md5"), F.length("body").cast("long").alias("body_chars"))


@query("fn_sourced_keys", with_views(f"""
SELECT doc_id, sid AS sourced_article_id,
       'sourced_candidate_articles/' || topic_id || '/' || strftime(dt_published, '%Y/%m/%d') || '/' || sid AS prefix,
       'sourced_candidate_articles/' || topic_id || '/' || strftime(dt_published, '%Y/%m/%d') || '/' || sid || '/' || sid || '.json' AS json_key,
       'sourced_candidate_articles/' || topic_id || '/' || strftime(dt_published, '%Y/%m/%d') || '/' || sid || '/Short_summary.txt' AS short_key
FROM (SELECT *, strftime(dt_published, '%Y-%m-%d-%H-%M-%S-%f') || '#' || {UUID_SQL('topic_id', 'doc_id')} AS sid
      FROM sourced) s""", "sourced"))
def fn_sourced_keys(spark, sf):
    """P10: sourced id from the earliest member's time, and its object keys."""
    s = A.sourced(spark, sf)
    sid = sourced_article_id(F.col("dt_published"), F.col("topic_id"), F.col("doc_id"))
    s = s.withColumn("sid", sid)
    k = sourced_keys(F.col("topic_id"), lexicographic_date(F.col("dt_published")), F.col("sid"))
    return s.select("doc_id", F.col("sid").alias("sourced_article_id"), k["prefix"].alias("prefix"),
                    k["json_key"].alias("json_key"), k["short_key"].alias("short_key"))


def _docs_sql(mode: str) -> str:
    names = mode.replace("_concat", "").replace("_avg", "").split("_and_")
    col = {"title": "coalesce(title, '')", "description": "coalesce(description, '')",
           "content": "coalesce(text, '')"}
    parts = [col[n] for n in names]
    if mode.endswith("_avg"):
        docs = "[" + ", ".join(parts) + "]"
    else:
        docs = "[concat_ws(' ', " + ", ".join(parts) + ")]"
    return (f"SELECT doc_id, '{mode}' AS mode, CAST(g.i - 1 AS INTEGER) AS doc_pos, "
            f"replace(({docs})[g.i], chr(10), ' ') AS doc FROM d, "
            f"generate_series(1, {len(parts) if mode.endswith('_avg') else 1}) AS g(i)")


DOCS_BASE = ("d AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, "
             "CASE WHEN strpos(text, chr(10)) > 0 THEN split_part(text, chr(10), 2) ELSE '' END AS description, "
             "text FROM documents)")


@query("fn_embedding_docs", f"WITH {DOCS_BASE} SELECT doc_id, mode, doc_pos, md5(doc) AS doc_md5, "
       f"length(doc) AS doc_chars FROM (" + " UNION ALL ".join(_docs_sql(m) for m in EMBEDDING_MODES) + ") u")
def fn_embedding_docs(spark, sf):
    """The documents embedded per article, for all 11 modes."""
    d = A.read(spark, sf, "documents")
    d = d.select("doc_id", F.substring_index("text", "\n", 1).alias("title"),
                 A.second_line(F.col("text")).alias("description"),
                 "text")
    per_mode = F.array(*[F.struct(F.lit(m).alias("mode"),
                                  embedding_docs(m, F.col("title"), F.col("description"), F.col("text")).alias("docs"))
                         for m in EMBEDDING_MODES])
    x = d.select("doc_id", F.explode(per_mode).alias("m"))
    x = x.select("doc_id", F.col("m.mode").alias("mode"), F.posexplode("m.docs").alias("doc_pos", "doc"))
    return x.select("doc_id", "mode", "doc_pos", F.md5("doc").alias("doc_md5"), F.length("doc").cast("long").alias("doc_chars"))


@query("fn_strip_quotes", """
SELECT doc_id, CASE WHEN starts_with(s, '"') AND ends_with(s, '"')
                    THEN CASE WHEN length(s) >= 2 THEN substr(s, 2, length(s) - 2) ELSE '' END ELSE s END AS title
FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '"' || t || '"' WHEN 1 THEN '"' || t WHEN 2 THEN '"' ELSE t END AS s
      FROM (SELECT doc_id, split_part(text, chr(10), 1) AS t FROM documents) a) b""")
def fn_strip_quotes(spark, sf):
    """Wrapping quotes of generated titles are removed (a lone quote -> '')."""
    d = A.read(spark, sf, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("t"))
    m = F.col("doc_id") % 4
    s = (F.when(m == 0, F.concat(F.lit('"'), F.col("t"), F.lit('"'))).when(m == 1, F.concat(F.lit('"'), F.col("t")))
         .when(m == 2, F.lit('"')).otherwise(F.col("t")))
    return d.select("doc_id", strip_wrapping_quotes(s).alias("title"))


@query("fn_json_payload", with_views(
    "SELECT event_id, CAST(to_json(struct_pack(event_id := event_id, url := url, title := title, "
    "aggregator_id := aggregator_id)) AS VARCHAR) AS article_data FROM hits", "hits"))
def fn_json_payload(spark, sf):
    """The original record kept as a JSON string."""
    h = A.hits(spark, sf)
    return h.select("event_id", json_payload("event_id", "url", "title", "aggregator_id").alias("article_data"))


@query("fn_token_chunks", f"""
SELECT doc_id, CAST(g.k AS INTEGER) AS chunk_idx, md5(array_to_string(list_slice(toks, g.k * {K.CHUNK_TOKENS} + 1, (g.k + 1) * {K.CHUNK_TOKENS}), '')) AS chunk_md5,
       length(array_to_string(list_slice(toks, g.k * {K.CHUNK_TOKENS} + 1, (g.k + 1) * {K.CHUNK_TOKENS}), '')) AS chunk_chars
FROM (SELECT doc_id, regexp_extract_all(text, '(\\s*\\S+)', 1) AS toks FROM documents) d,
     generate_series(0, (len(toks) - 1) // {K.CHUNK_TOKENS}) AS g(k)
WHERE len(toks) > 0""")
def fn_token_chunks(spark, sf):
    """Documents split into 250-token chunks (word tokens, overlap 0)."""
    d = A.read(spark, sf, "documents")
    c = d.select("doc_id", F.posexplode(token_chunks(F.col("text"), K.CHUNK_TOKENS, K.CHUNK_OVERLAP)).alias("chunk_idx", "chunk"))
    return c.select("doc_id", "chunk_idx", F.md5("chunk").alias("chunk_md5"), F.length("chunk").cast("long").alias("chunk_chars"))


def _titles_by_cluster(spark, sf):
    c = with_texts(spark, sf, cluster_members(spark, sf)).filter(F.col("title").isNotNull())
    g = c.groupBy("topic_id", "day", "cluster").agg(
        F.array_sort(F.collect_list(F.struct("member_idx", "title", "text"))).alias("m"))
    return g.select("topic_id", "day", "cluster", A.topic_name(F.col("topic_id")).alias("topic"),
                    F.array_join(F.transform("m", lambda x: x["title"]), PR.STUFF_SEPARATOR).alias("titles"),
                    F.array_join(F.transform("m", lambda x: x["text"]), PR.STUFF_SEPARATOR).alias("full_text"))


def _sql_template(t: str) -> str:
    return "'" + t.replace("'", "''") + "'"


def _summary_sql(definition: str) -> str:
    return (f"replace(replace(replace({_sql_template(K.SUMMARY_TEMPLATE)}, '####topic####', topic), "
            f"'####summary_definition####', {_sql_template(definition)}), '{{text}}', full_text)")


@query("fn_render_prompts", with_views(f"""
SELECT topic_id, day, cluster, md5(tp) AS title_prompt_md5, length(tp) AS title_prompt_chars,
       md5(mp) AS medium_prompt_md5, md5(sp) AS short_prompt_md5 FROM (
  SELECT topic_id, day, cluster, replace(replace({_sql_template(K.TITLE_TEMPLATE)}, '####topic####', topic), '{{text}}', titles) AS tp,
         {_summary_sql(K.MEDIUM_SUMMARY_DEFINITION)} AS mp, {_summary_sql(K.SHORT_SUMMARY_DEFINITION)} AS sp
  FROM (SELECT topic_id, day, cluster, 'Topic ' || split_part(topic_id, '_', 2) AS topic,
               string_agg(title, chr(10) || chr(10) ORDER BY member_idx) AS titles,
               string_agg(text, chr(10) || chr(10) ORDER BY member_idx) AS full_text
        FROM cluster_members WHERE title IS NOT NULL GROUP BY topic_id, day, cluster) a) x""", "cluster_members"))
def fn_render_prompts(spark, sf):
    """Per (topic, cluster) the title prompt (member titles stuffed in)
    and the medium / short summary prompts over the full text."""
    t = _titles_by_cluster(spark, sf)
    p = PR.title_prompt(F.col("topic"), F.col("titles"))
    m = PR.summary_prompt(F.col("topic"), "medium", F.col("full_text"))
    sh = PR.summary_prompt(F.col("topic"), "short", F.col("full_text"))
    return t.select("topic_id", "day", "cluster", F.md5(p).alias("title_prompt_md5"),
                    F.length(p).cast("long").alias("title_prompt_chars"),
                    F.md5(m).alias("medium_prompt_md5"), F.md5(sh).alias("short_prompt_md5"))


@query("fn_refine_plan", f"""
SELECT cluster, position AS step, CASE WHEN rn = 0 THEN 'rewrite' ELSE 'refine' END AS kind, md5(p) AS prompt_md5 FROM (
  SELECT cluster, position, rn,
    CASE WHEN rn = 0 THEN replace(replace({_sql_template(K.REWRITE_TEMPLATE)}, '####topic####', topic), '{{text}}', text)
         ELSE replace(replace(replace({_sql_template(K.REFINE_TEMPLATE)}, '####topic####', topic), '{{text}}', text),
                      '{{existing_answer}}', '{{existing_answer}}') END AS p
  FROM (SELECT conv_id AS cluster, turn AS position, text, 'Topic ' || CAST(conv_id % 8 AS VARCHAR) AS topic,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS rn FROM conversations) a) b""")
def fn_refine_plan(spark, sf):
    """Ordered documents of a cluster -> rewrite step, then refine steps."""
    from pyspark.sql import Window
    t = A.cluster_texts(spark, sf)
    t = t.withColumn("rn", F.row_number().over(Window.partitionBy("cluster").orderBy("position")) - 1)
    topic = F.concat(F.lit("Topic "), (F.col("cluster") % 8).cast("string"))
    p = PR.refine_step_prompt(F.col("rn"), topic, F.col("text"), F.lit("{existing_answer}"))
    return t.select("cluster", F.col("position").alias("step"),
                    F.when(F.col("rn") == 0, F.lit("rewrite")).otherwise(F.lit("refine")).alias("kind"),
                    F.md5(p).alias("prompt_md5"))
