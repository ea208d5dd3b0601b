"""DuckDB definitions of the adapter views (same keys as ``adapters.py``).

``with_views(body, *names)`` prefixes a query with the CTEs it needs (and
their dependencies) in dependency order.
"""

from __future__ import annotations

AGG_CASE = ("CASE e.event_id % 3 WHEN 0 THEN 'bingnews' WHEN 1 THEN 'newsapi.org' "
            "ELSE 'thenewsapi.com' END")

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "hits": ((), f"""
SELECT e.event_id, CAST(e.ts AS TIMESTAMP) AS published_dt, e.user_id,
       'topic_' || CAST(e.user_id % 8 AS VARCHAR) AS topic_id,
       {AGG_CASE} AS aggregator_id,
       d.doc_id, d.source, d.lang, d.text,
       'https://' || d.source || '.example.com/a/' || CAST(d.doc_id AS VARCHAR) AS url,
       d.source || '.example.com' AS provider_domain,
       split_part(d.text, chr(10), 1) AS title
FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)"""),
    "raw_hits": (("hits",), """
SELECT h.*,
  CASE WHEN event_id % 50 = 0 THEN ''
       WHEN event_id % 97 = 0 THEN replace(vs, 'T', ' ')
       ELSE vs END AS raw_published
FROM (SELECT *,
        CASE aggregator_id
          WHEN 'bingnews' THEN strftime(published_dt, '%Y-%m-%dT%H:%M:%S.%f') || '0Z'
          WHEN 'newsapi.org' THEN strftime(published_dt, '%Y-%m-%dT%H:%M:%S') || 'Z'
          ELSE strftime(published_dt, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS vs
      FROM hits) h"""),
    "topics": ((), """
SELECT 'topic_' || CAST(i AS VARCHAR) AS topic_id, 'Topic ' || CAST(i AS VARCHAR) AS topic,
       i % 4 <> 3 AS is_active, CAST(5 + i % 3 AS INTEGER) AS daily_publishing_limit,
       100 AS max_aggregator_results,
       CASE WHEN i % 2 = 0 THEN TIMESTAMP '2024-01-25 00:00:00'
            WHEN i = 3 THEN TIMESTAMP '2024-01-31 00:00:00' END AS last_publishing_date
FROM (SELECT DISTINCT user_id % 8 AS i FROM events) t"""),
    "aggregators": ((), f"""
SELECT DISTINCT {AGG_CASE} AS aggregator_id, TRUE AS is_active,
       CAST(CASE {AGG_CASE} WHEN 'bingnews' THEN 1 ELSE 30 END AS INTEGER) AS horizon_days
FROM events e"""),
    "runs": (("hits",), """
SELECT topic_id, aggregator_id, 'Topic ' || split_part(topic_id, '_', 2) AS topic,
       TIMESTAMP '2024-01-02 00:00:00' AS start_dt, TIMESTAMP '2024-01-29 00:00:00' AS end_dt,
       100 AS max_results, 'relevance' AS sorting
FROM (SELECT DISTINCT topic_id, aggregator_id FROM hits) r"""),
    "watermarks": (("hits",), """
SELECT topic_id, aggregator_id, max(published_dt) AS last_end FROM hits
WHERE published_dt < TIMESTAMP '2024-01-21 00:00:00' AND topic_id <> 'topic_5'
GROUP BY topic_id, aggregator_id"""),
    "trusted": ((), """
SELECT 'en' AS language, source || '.example.com' AS provider_domain, source AS provider_name,
       'us' AS country, CAST(regexp_extract(source, '^src([0-9]+)$', 1) AS INTEGER) % 5 <> 0 AS is_active
FROM (SELECT DISTINCT source FROM documents) s
WHERE regexp_extract(source, '^src([0-9]+)$', 1) <> ''
  AND CAST(regexp_extract(source, '^src([0-9]+)$', 1) AS INTEGER) <= 13"""),
    "decisions": ((), """
SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'PUBLISH' WHEN toxic = 1 THEN 'REJECT'
                    ELSE 'SKIP' END AS decision
FROM labels"""),
    "cluster_texts": ((), """
SELECT conv_id AS cluster, turn AS position, text FROM conversations"""),
    "sourced": (("hits",), """
SELECT 'topic_' || CAST(g.doc_id % 8 AS VARCHAR) AS topic_id,
       'Topic ' || CAST(g.doc_id % 8 AS VARCHAR) AS topic,
       strftime(g.dt_published, '%Y-%m-%d-%H-%M-%S-%f') || '#doc-' || CAST(g.doc_id AS VARCHAR) AS sourced_article_id,
       g.doc_id, g.dt_published, g.dt_published + INTERVAL 1 HOUR AS dt_sourced,
       strftime(g.dt_published, '%Y/%m/%d') AS date_published,
       split_part(d.text, chr(10), 1) AS title,
       CASE g.doc_id % 4 WHEN 0 THEN 'APPROVED' WHEN 1 THEN 'REJECTED' ELSE 'PENDING' END AS article_approval_status
FROM (SELECT doc_id, min(published_dt) AS dt_published FROM hits GROUP BY doc_id) g
JOIN documents d ON d.doc_id = g.doc_id"""),
}


def register(name: str, deps: tuple[str, ...], body: str) -> None:
    VIEWS[name] = (deps, body)


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in VIEWS[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(body: str, *names: str) -> str:
    order = _order(names)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"

register("requests", (), f"""
SELECT topic_id, aggregator_id, TIMESTAMP '2024-01-02 00:00:00' AS start_dt, TIMESTAMP '2024-01-03 00:00:00' AS end_dt,
       CASE WHEN aggregator_id = 'bingnews' THEN 'date' ELSE 'relevance' END AS sorting
FROM (SELECT DISTINCT 'topic_' || CAST(e.user_id % 10 AS VARCHAR) AS topic_id, {AGG_CASE} AS aggregator_id FROM events e) k""")
register("desired", (), """
SELECT 'en' AS language, source || '.example.com' AS provider_domain, source AS provider_name
FROM (SELECT DISTINCT source FROM documents) s
WHERE regexp_extract(source, '^src([0-9]+)$', 1) <> ''
  AND CAST(regexp_extract(source, '^src([0-9]+)$', 1) AS INTEGER) BETWEEN 3 AND 16""")
