"""Wall-clock benchmark of the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` (default 4), executing
the full plan into Spark's no-op sink (nothing is collected to the driver),
and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidings.plans import catalog  # noqa: E402
from tidings.session import build_session, checkpoint_dir  # noqa: E402

HEADLINE = [
    "win_accept_cap",        # whole collect stage F1..W4 over every run
    "agg_run_summary",
    "win_url_dedup",
    "gen_fetch_windows",
    "flt_request_valid",
    "src_bing_flatten",      # landed JSON -> flattened articles
    "fn_html_article",
    "win_inventory_relevance",
    "win_cluster_topk",
    "agg_sourced_article",
    "udf_summarise",
    "win_chunk_interleave",
    "clu_ward_select_k",
    "join_apply_decisions",
    "agg_published_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="tidings-bench", shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)   # reads spark.checkpoint.dir; a temp folder only when it is unset
    catalog.load_all()
    # warm-up on the smallest data set (same plan shapes): JVM start, class
    # loading and code generation are not charged to the first query
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in ("win_accept_cap", "src_bing_flatten", "clu_ward_select_k"):
            catalog.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
