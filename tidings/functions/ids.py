"""Deterministic identifiers and object keys.

A random uuid would make re-executed tasks produce different ids, so the
uuid-shaped suffix is an md5 of the row's natural key instead (stable under
task retries and speculative execution).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid_of(*cols: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def zero_pad6(idx: Column) -> Column:
    """Like str.zfill(6): pad short numbers, never truncate long ones."""
    s = idx.cast("string")
    return F.when(F.length(s) >= 6, s).otherwise(F.lpad(s, 6, "0"))


def article_id(idx: Column, *key: Column) -> Column:
    return F.concat(zero_pad6(idx), F.lit("#"), uuid_of(*key))


def lexicographic_dash(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd-HH-mm-ss-SSSSSS")


def lexicographic_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd")


def sourced_article_id(earliest_published: Column, *key: Column) -> Column:
    return F.concat(lexicographic_dash(earliest_published), F.lit("#"), uuid_of(*key))


def sourced_prefix(topic_id: Column, publishing_date: Column, sid: Column) -> Column:
    return F.concat_ws("/", F.lit("sourced_candidate_articles"), topic_id, publishing_date, sid)


def sourced_keys(topic_id: Column, publishing_date: Column, sid: Column) -> dict[str, Column]:
    prefix = sourced_prefix(topic_id, publishing_date, sid)
    return {
        "prefix": prefix,
        "json_key": F.concat(prefix, F.lit("/"), sid, F.lit(".json")),
        "short_key": F.concat(prefix, F.lit("/Short_summary.txt")),
        "medium_key": F.concat(prefix, F.lit("/Medium_summary.txt")),
        "full_key": F.concat(prefix, F.lit("/Full_summary.txt")),
        "marker_key": F.concat(prefix, F.lit("/__SUCCESS__")),
    }
