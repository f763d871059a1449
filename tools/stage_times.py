"""Per-job and per-stage times of one registered query, from Spark's event log.

    python tools/stage_times.py QUERY [--sf-dir /root/testdata/sf0.1]

The event log is written to a fresh temporary folder (no UI, no server).
After an untimed warm-up, the query runs once into the noop sink. The tool
prints driver gaps between jobs and, per stage, wall time, task count, summed
run time, the slowest task, CPU and GC time.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("query")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    ev = tempfile.mkdtemp(prefix="quillrank-events-")
    spark = (
        SparkSession.builder.master("local[8]").appName("quillrank-stage-times")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "16g")
        .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{ev}")
        .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from quillrank.plans.registry import QUERIES
    from quillrank.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    QUERIES[a.query](spark, a.sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    t0 = time.time() * 1000
    QUERIES[a.query](spark, a.sf_dir).write.format("noop").mode("overwrite").save()
    t1 = time.time() * 1000
    spark.stop()

    path = max(glob.glob(f"{ev}/*"), key=os.path.getmtime)
    if os.path.isdir(path):
        path = sorted(glob.glob(f"{path}/events_*"))[-1]
    jobs, stages, tasks = {}, {}, {}
    with open(path) as f:
        events = [json.loads(line) for line in f]
    for e in events:
        k = e["Event"]
        if k == "SparkListenerJobStart" and e["Submission Time"] >= t0:
            jobs[e["Job ID"]] = [e["Submission Time"], None]
        elif k == "SparkListenerJobEnd" and e["Job ID"] in jobs:
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif k == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            if si.get("Submission Time", 0) >= t0:
                stages[si["Stage ID"]] = (si["Submission Time"], si["Completion Time"])
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
            m = e.get("Task Metrics") or {}
            d = tasks.setdefault(e["Stage ID"], [0, 0, 0, 0, 0])
            run = m.get("Executor Run Time", 0)
            d[0] += 1
            d[1] += run
            d[2] = max(d[2], run)
            d[3] += m.get("Executor CPU Time", 0) // 1_000_000
            d[4] += m.get("JVM GC Time", 0)
    busy = sum(b - a for a, b in jobs.values() if b)
    print(f"{a.query}: wall {t1 - t0:.0f} ms, {len(jobs)} jobs busy {busy} ms, driver-side {t1 - t0 - busy:.0f} ms")
    prev = t0
    for jid, (s, e) in sorted(jobs.items()):
        print(f"  job {jid}: gap {s - prev:.0f} ms, run {e - s} ms")
        prev = e
    for sid, (s, e) in sorted(stages.items()):
        n, run, mx, cpu, gc = tasks.get(sid, [0, 0, 0, 0, 0])
        print(f"  stage {sid}: {e - s} ms, tasks {n}, run-sum {run} ms, max-task {mx} ms, cpu {cpu} ms, gc {gc} ms")


if __name__ == "__main__":
    main()
