"""Property test: the one-plan collect stage equals a per-run loop that
pages through hits the way the original service does (random inputs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidings.operators import collect as C

T0 = dt.datetime(2024, 1, 10)
SCHEMA = ("event_id long, topic_id string, aggregator_id string, url string, raw_published string, "
          "provider_domain string, has_body boolean, description string")
AGGS = ("bingnews", "newsapi.org")
START, END = T0 + dt.timedelta(minutes=5), T0 + dt.timedelta(minutes=40)


def raw_date(agg, minute):
    ts = T0 + dt.timedelta(minutes=minute)
    return ts.strftime("%Y-%m-%dT%H:%M:%S.%f") + "0Z" if agg == "bingnews" else ts.strftime("%Y-%m-%dT%H:%M:%SZ")


def reference(rows, page_size, max_results, trusted):
    """Per-run loop: pages, undated skip, URL dedup, page stop, quota; then
    the accept loop with window / body / description / trust checks."""
    out = set()
    quota = max_results * 2
    for run in {(r[1], r[2]) for r in rows}:
        hits = sorted([r for r in rows if (r[1], r[2]) == run], key=lambda r: r[0])
        pages = [hits[i:i + page_size] for i in range(0, len(hits), page_size)]
        seen, cands = set(), []
        for page in pages:
            if len(cands) >= quota:
                break
            new = []
            for r in page:
                if not r[4]:
                    continue
                if r[3] in seen:
                    continue
                seen.add(r[3])
                new.append(r)
            if not new:
                break
            cands.extend(new[:quota - len(cands)])
        accepted = 0
        for r in cands:
            if accepted >= max_results:
                break
            minute = r[8]
            ts = T0 + dt.timedelta(minutes=minute)
            if minute is None or ts < START or ts > END:
                continue
            if not r[6]:
                continue
            if r[2] != "bingnews" and (not r[7] or r[5] not in trusted):
                continue
            out.add((r[0], accepted))
            accepted += 1
    return out


row = st.tuples(st.sampled_from(AGGS), st.integers(0, 6), st.one_of(st.none(), st.integers(0, 50)),
                st.booleans(), st.booleans(), st.sampled_from(["good.com", "bad.com"]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40), st.integers(1, 4), st.integers(1, 5))
def test_collect_matches_page_loop(spark, data, page_size, max_results):
    rows = []
    for i, (agg, u, minute, body, desc, dom) in enumerate(data):
        raw = raw_date(agg, minute) if minute is not None else ""
        rows.append((i, "t", agg, f"u{u}", raw, dom, body, "d" if desc else "", minute))
    runs = spark.createDataFrame([("t", a, "T", START, END, max_results, "relevance") for a in AGGS],
                                 "topic_id string, aggregator_id string, topic string, start_dt timestamp, "
                                 "end_dt timestamp, max_results int, sorting string")
    trusted = spark.createDataFrame([("en", "good.com", "g", "us", True), ("en", "bad.com", "b", "us", False)],
                                    "language string, provider_domain string, provider_name string, country string, "
                                    "is_active boolean")
    h = spark.createDataFrame([r[:8] for r in rows], SCHEMA)
    got = {(r.event_id, r.aggregation_index) for r in
           C.collect(h, runs, trusted, body="has_body", page_size=page_size).collect()}
    assert got == reference(rows, page_size, max_results, {"good.com"})
