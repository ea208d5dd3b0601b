"""Property tests of chunk interleave and window scheduling against plain loops."""

import datetime as dt
import re
from itertools import zip_longest

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidings.constants import ARTICLE_SEPARATOR
from tidings.operators import schedule as S
from tidings.operators import sourcing as SO

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
word = st.text(alphabet="abc", min_size=1, max_size=3)
text = st.lists(word, min_size=0, max_size=9).map(lambda ws: " ".join(ws))


def chunks(t, n):
    toks = re.findall(r"\s*\S+", t)
    return ["".join(toks[i:i + n]) for i in range(0, len(toks), n)]


@SETTINGS
@given(st.lists(text, min_size=1, max_size=5), st.integers(1, 3))
def test_chunk_interleave_matches_zip_longest(spark, texts, n):
    expected = [ARTICLE_SEPARATOR.join(c for c in group if c is not None)
                for group in zip_longest(*[chunks(t, n) for t in texts])]
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "cluster long, position long, text string")
    got = [r.doc for r in SO.chunk_interleave(df, size=n).orderBy("chunk_idx").collect()]
    assert got == expected


TODAY = dt.datetime(2024, 1, 31)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-40 * 24, 3 * 24)), min_size=1, max_size=4),
       st.sampled_from([1, 30]))
def test_fetch_windows_match_scheduler_loop(spark, offsets_h, horizon):
    expected = []
    for i, off in enumerate(offsets_h):
        start = TODAY + dt.timedelta(hours=off) if off is not None else \
            max(TODAY - dt.timedelta(days=horizon), dt.datetime(2023, 1, 1))
        while start <= TODAY:
            expected.append((f"t{i}", start, start + dt.timedelta(days=1)))
            start += dt.timedelta(days=1)
    pairs = spark.createDataFrame([(f"t{i}", "agg") for i in range(len(offsets_h))], "topic_id string, aggregator_id string")
    marks = spark.createDataFrame([(f"t{i}", "agg", TODAY + dt.timedelta(hours=o)) for i, o in enumerate(offsets_h)
                                   if o is not None] or [("none", "agg", TODAY)],
                                  "topic_id string, aggregator_id string, last_end timestamp")
    aggs = spark.createDataFrame([("agg", True, horizon)], "aggregator_id string, is_active boolean, horizon_days int")
    got = sorted((r.topic_id, r.start_dt, r.end_dt) for r in S.fetch_windows(pairs, marks, aggs, TODAY).collect())
    assert got == sorted(expected)
