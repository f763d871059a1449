"""Write docs/PLANS.md: the executed plans of the headline queries.

    python tools/dump_plans.py [--sf-dir /root/testdata/sf0.1]

Each query is collected and its top-level final adaptive plan
is printed, with column ids and file locations elided for readability.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillrank.plans.inspect import plan_text  # noqa: E402
from quillrank.plans.registry import QUERIES, graph_for  # noqa: E402
from quillrank.session import local_session, scratch_path  # noqa: E402

NOTES = {
    "tfidf_all": "One scan and one explode; df and N read the tf shuffle (ReusedExchange); N is a scalar subquery.",
    "tfidf_topk": "No explode: hits are counted in the token array; one aggregate by title; TakeOrderedAndProject.",
    "distinct_arcs": "Both lineitem sides filtered and pruned at the scan, deduplicated map-side, joined on (order, line).",
    "pagerank_round": "A steady-state round of variant B: bucketed links and ranks joined in place, only the partial sums are shuffled.",
}


def tidy(text: str) -> str:
    text = text.split("\n+- == Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"Location: [^,]*,", "Location: ...,", text)
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    return "\n".join(line[:200] for line in text.splitlines())


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    spark = local_session(8)
    frames = {name: QUERIES[name](spark, a.sf_dir) for name in ("tfidf_all", "tfidf_topk", "distinct_arcs")}
    pr = graph_for(spark, a.sf_dir, "B")
    r0 = scratch_path(spark, "plan-ranks")
    ranks, *_ = pr._written(pr.intermediate(pr.initial()), r0)
    frames["pagerank_round"] = pr.intermediate(ranks)
    out = ["# Executed plans", "",
           f"Generated by `tools/dump_plans.py` at `{a.sf_dir}` on local[8] (AQE final plans,",
           "column ids and paths elided).", ""]
    for name, df in frames.items():
        df.collect()  # runs this DataFrame's own plan, so explain shows its final form
        out += [f"## {name}", "", NOTES[name], "", "```", tidy(plan_text(df, "simple")), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
