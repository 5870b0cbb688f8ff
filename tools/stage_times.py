"""Stage and task times of registered queries, from Spark's event log.

usage: python tools/stage_times.py [sf_dir] key [key ...]
Writes the event log to a fresh scratch folder (no UI, no server), runs each
query into the ``noop`` sink, then prints per stage: tasks, wall time, median
and max task time (a max far above the median is a straggler / skewed task).
"""

import glob
import json
import os
import statistics
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from strata.plans.registry import REGISTRY  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]").appName("strata-stages")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for k in args:
        spark.sparkContext.setJobDescription(k)
        REGISTRY[k](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    tasks, stages = {}, {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        base = os.path.basename(path)
        if os.path.isdir(path) or "appstatus" in base or base.endswith(".crc"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    tasks.setdefault(ev["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
                elif kind == "SparkListenerStageCompleted":
                    si = ev["Stage Info"]
                    stages[si["Stage ID"]] = (si["Stage Name"], si.get("Completion Time", 0) - si.get("Submission Time", 0))
    print(f"event log: {log_dir}")
    print(f"{'stage':>5} {'tasks':>5} {'wall ms':>8} {'median':>7} {'max':>7}  name")
    for sid in sorted(stages):
        name, wall = stages[sid]
        t = tasks.get(sid, [0])
        print(f"{sid:>5} {len(t):>5} {wall:>8} {int(statistics.median(t)):>7} {max(t):>7}  {name[:60]}")


if __name__ == "__main__":
    main()
