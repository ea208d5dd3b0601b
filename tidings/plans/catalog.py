"""Registry of contract queries: key -> (Spark builder, DuckDB oracle SQL).

Builders take (spark, sf_dir) and return a DataFrame; the oracle SQL runs on
the same parquet tables registered as views. Keys follow SURVEY section 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query builder (and its oracle SQL when it has one)."""

    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


def load_all() -> None:
    from . import (q_collect, q_functions, q_sources, q_schedule, q_sourcing,  # noqa: F401
                   q_publish, q_cluster, q_stream, q_udfs, q_pipelines)


def ISO(expr: str) -> str:
    """DuckDB twin of functions.dates.iso_utc."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def UUID_SQL(*cols: str) -> str:
    """DuckDB twin of functions.ids.uuid_of."""
    h = "md5(concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + "))"
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-' || substr({h},13,4) || '-' || "
            f"substr({h},17,4) || '-' || substr({h},21,12))")


def PAD6(expr: str) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({s}) >= 6 THEN {s} ELSE lpad({s}, 6, '0') END)"


def DOMAIN_SQL(url: str) -> str:
    """DuckDB twin of functions.text.provider_domain."""
    return (f"regexp_replace(lower(regexp_extract({url}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)), "
            f"'^(www|m|blog)\\.', '')")


def _unescape_sql(c: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "),
                    ("&amp;", "&")):
        c = f"replace({c}, '{ent}', '{ch}')"
    return c


def _squash_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def TITLE_SQL(html: str) -> str:
    """DuckDB twin of functions.text.html_title."""
    return _squash_sql(_unescape_sql(f"regexp_extract({html}, '(?is)<title[^>]*>(.*?)</title>', 1)"))


def BODY_SQL(html: str) -> str:
    """DuckDB twin of functions.text.html_body."""
    c = f"regexp_replace({html}, '(?is)<script[^>]*>.*?</script>', ' ', 'g')"
    c = f"regexp_replace({c}, '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
    c = f"regexp_replace({c}, '(?is)<nav[^>]*>.*?</nav>', ' ', 'g')"
    c = f"regexp_replace({c}, '(?s)<!--.*?-->', ' ', 'g')"
    c = f"regexp_replace({c}, '(?is)<div class=.ad.[^>]*>.*?</div>', ' ', 'g')"
    art = f"regexp_extract(c, '(?is)<article[^>]*>(.*)</article>', 1)"
    body = f"regexp_extract(c, '(?is)<body[^>]*>(.*)</body>', 1)"
    pick = f"(SELECT CASE WHEN length({art}) > 0 THEN {art} WHEN length({body}) > 0 THEN {body} ELSE c END FROM (SELECT {c} AS c))"
    s = f"regexp_replace({pick}, '<[^>]*>', ' ', 'g')"
    return _squash_sql(_unescape_sql(s))
