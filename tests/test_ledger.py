"""Run ledger: save if absent, finish once, failures."""

import datetime as dt

from tidings.operators import ledger as LG

T0, T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


def runs(spark, *topics):
    return spark.createDataFrame([(t, "bingnews", T0, T1) for t in topics], "topic_id string, aggregator_id string, start_dt timestamp, end_dt timestamp")


def test_ledger_life(spark):
    ledger = LG.start_runs(None, runs(spark, "a", "b"), T1)
    ids = {t: f"{t}/bingnews/2024-01-01 00:00:00" for t in "abc"}
    outcomes = spark.createDataFrame([(ids["a"], T0, T0, 3, "p", None), (ids["b"], None, None, None, None, "timeout")],
                                     "run_id string, min_published timestamp, max_published timestamp, n_accepted long, store_paths string, error string")
    ledger = LG.finish_runs(ledger, outcomes, T2)
    again = LG.finish_runs(LG.start_runs(ledger, runs(spark, "a", "c"), T2), outcomes, dt.datetime(2025, 1, 1))
    got = {r.topic_id: r for r in again.collect()}
    assert {t: (r.run_id, r.run_status, r.articles_count) for t, r in got.items()} == {
        "a": (ids["a"], "COMPLETE", 3), "b": (ids["b"], "FAILED", None), "c": (ids["c"], "RUNNING", None)}
    assert got["a"].articles_ref == {"type": "parquet", "paths": "p"} and got["a"].data_end == T0 and got["a"].execution_end == T2
    assert got["b"].articles_ref is None and got["b"].data_end == T1 and got["c"].execution_end is None
