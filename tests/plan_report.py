"""Physical-plan summary per registered query (shuffles, broadcasts, Python).

Usage: python tests/plan_report.py [sf_dir]   -> markdown table on stdout.
Counts come from the initial (pre-AQE) physical plan of the final DataFrame;
iterative operators also run per-round jobs that are not included.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])


def summarize(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                   r"Exchange SinglePartition|Exchange RoundRobin", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "python": plan.count("ArrowEvalPython") + plan.count("BatchEvalPython"),
        "partial_topk": len(re.findall(r"WindowGroupLimit.*Partial", plan)),
        "partial_agg": len(re.findall(r"(?:Hash|Sort|ObjectHash)Aggregate\(keys?=\[[^\]]*\], "
                                      r"functions=\[partial_", plan)),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from threadlens.plans import QUERIES, load_all
    from threadlens.session import local_session
    load_all()
    spark = local_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # plan as at scale
    print("| query | shuffles | broadcasts | python evals | partial top-k | partial aggs |")
    print("|---|---|---|---|---|---|")
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['python']} | "
              f"{s['partial_topk']} | {s['partial_agg']} |")


if __name__ == "__main__":
    main()
