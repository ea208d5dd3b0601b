"""Write PLANS.md: physical plan trees of key queries with their scan
details (ReadSchema, PushedFilters, PartitionFilters).

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from tidings.plans import catalog  # noqa: E402
from tidings.session import build_session  # noqa: E402

KEYS = ["win_accept_cap", "win_url_dedup", "src_candidates_unsourced", "win_chunk_interleave",
        "clu_ward_select_k", "join_trusted_semi", "gen_fetch_windows"]


def summarise(plan: str) -> str:
    tree, _, details = plan.partition("\n\n\n")
    keep = []
    for block in details.split("\n\n"):
        if block.lstrip().startswith("(") and "Scan" in block.splitlines()[0]:
            lines = [ln for ln in block.splitlines()
                     if ln.startswith("(") or ln.startswith(("ReadSchema", "PushedFilters", "PartitionFilters"))]
            keep.append("\n".join(lines))
    return tree.strip() + "\n\n" + "\n\n".join(keep)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    catalog.load_all()
    out = ["# Physical plans of key queries", "",
           f"Generated by `python tools/plans.py` on `{sf}` (adaptive plans before execution).", ""]
    for k in KEYS:
        df = catalog.QUERIES[k](spark, sf)
        plan = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        plan = re.sub(r"#\d+L?", "", plan)
        out += [f"## `{k}`", "", "```", summarise(plan), "```", ""]
    open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w").write("\n".join(out))


if __name__ == "__main__":
    main()
