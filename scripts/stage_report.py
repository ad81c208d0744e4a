"""Per-query input and shuffle volumes from Spark's event log.

    python scripts/stage_report.py [--sf /root/testdata/sf0.1] [name ...]

Runs each query through the no-op sink under its own job group with event
logging to a fresh scratch folder, then sums the task metrics of the
query's jobs: tasks, input rows, shuffle bytes written, and the longest
task.  Shows whether a plan reduces before it shuffles.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT = ["zone_efficiency", "rate_by_season", "zone_season_cells", "share_fingerprint",
           "pivot_zone_counts", "profile_nulls", "profile_distinct", "entity_trend", "auc_exact",
           "index_levels", "derive_features"]


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from shotframe.plans.queries import queries
    from shotframe.session import build_session

    logdir = tempfile.mkdtemp(prefix="shotframe-eventlog-")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
                                 "spark.eventLog.compress": "false"})
    qs = queries()
    names = a.names or DEFAULT
    sc = spark.sparkContext
    qs["zone_efficiency"](spark, a.sf).write.format("noop").mode("overwrite").save()  # warm-up
    for n in names:
        sc.setJobGroup(n, n)
        qs[n](spark, a.sf).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("done", "done")
    spark.stop()

    job_group, stage_job, stats = {}, {}, {}
    # Spark 4 writes rolling logs: a folder of events_<n>_* files
    files = [p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True)
             if os.path.isfile(p) and os.path.basename(p).startswith(("events", "local-", "app-"))]
    files.sort(key=lambda p: (len(p), p))
    lines = (line for p in files for line in open(p))
    for line in lines:
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            job_group[ev["Job ID"]] = g
            for s in ev.get("Stage IDs", []):
                stage_job[s] = ev["Job ID"]
        elif kind == "SparkListenerTaskEnd":
            g = job_group.get(stage_job.get(ev["Stage ID"]))
            if g not in names:
                continue
            m = ev.get("Task Metrics") or {}
            st = stats.setdefault(g, {"tasks": 0, "input": 0, "records": 0, "shuffle_write": 0,
                                     "max_task_ms": 0})
            st["tasks"] += 1
            st["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
            st["records"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
            st["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            info = ev.get("Task Info") or {}
            st["max_task_ms"] = max(st["max_task_ms"], info.get("Finish Time", 0) - info.get("Launch Time", 0))
    print(f"{'query':26s} {'tasks':>6s} {'input rows':>11s} {'shuffle KB':>11s} {'max task ms':>12s}")
    for n in names:
        st = stats.get(n, {})
        print(f"{n:26s} {st.get('tasks', 0):6d} {st.get('records', 0):11d} "
              f"{st.get('shuffle_write', 0) / 1e3:11.1f} {st.get('max_task_ms', 0):12d}")


if __name__ == "__main__":
    main()
