"""Headline benchmark: prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's plan is executed in full into Spark's ``noop`` sink (no
collect), after untimed warm-up queries on the sf0.01 tables (JIT). ``value`` is the
sum of the per-query seconds, each the best of ``BENCH_REPEAT`` runs
(default 2, which damps JIT warm-up and machine noise).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillrank.plans.registry import QUERIES  # noqa: E402
from quillrank.session import local_session  # noqa: E402

HEADLINE = ["tfidf_all", "tfidf_topk", "pagerank_a", "pagerank_b", "pagerank_c"]


def run(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    warm = warm if os.path.isdir(warm) else sf_dir
    for name in ("tfidf_all", "pagerank_step_dangling", "distinct_contribs"):
        run(spark, name, warm)  # JVM warm-up of both code paths, not timed
    times = {n: round(min(run(spark, n, sf_dir) for _ in range(repeat)), 3) for n in names}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
