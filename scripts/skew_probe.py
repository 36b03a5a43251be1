"""Skew probe: run the skew-sensitive operators on a workload derived from
``lineitem`` where one key holds a third of all rows, and report per-stage
task-time spread from Spark's event log (written to a fresh scratch folder).

Usage: python scripts/skew_probe.py [sf_dir]
Prints, per operator, wall time and the worst stage's max/median task time.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stage_spread(log_dir: str):
    """Per job group: the stage whose slowest task is slowest, with its
    task count, max and median task time (ms).  A hot key that lands in one
    task shows up as max far above median."""
    tasks: dict[int, list[float]] = {}
    stage_group: dict[int, str] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path, errors="replace") as fh:
            for line in fh:
                try:
                    ev = json.loads(line)
                except ValueError:
                    continue
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    tasks.setdefault(ev["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    worst: dict[str, tuple] = {}
    for sid, durs in tasks.items():
        g = stage_group.get(sid)
        if g is None or len(durs) < 4:
            continue
        cand = (sid, max(durs), statistics.median(durs), len(durs))
        if g not in worst or cand[1] > worst[g][1]:
            worst[g] = cand
    return worst


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    from pyspark.sql import functions as F

    from quillspark.operators import claims, health, merge
    from quillspark.session import build_session

    spark = build_session("local[8]", 16, extra={
        "spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false", "spark.driver.memory": "8g",
        "spark.sql.autoBroadcastJoinThreshold": "-1",    # force shuffle joins
        "spark.sql.files.maxPartitionBytes": str(1 << 20)})  # several scan tasks
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # one key (0) holds a third of all rows
    hot = F.when(F.col("l_linenumber") % 3 == 0, F.lit(0)).otherwise(F.col("l_suppkey"))
    base = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                     hot.alias("k"), F.col("l_shipdate").alias("t"), F.col("l_returnflag").alias("flag"))
    c = base.filter(F.col("flag") != "R")
    r = base.filter(F.col("flag") == "R")
    probes = {
        "latest_per_key": lambda: health.latest_per_key(base, "k", ["t", "id"]),
        "count_matches": lambda: claims.count_matches(c, r, ["k"], "t", "t"),
        "apply_reversals": lambda: claims.apply_reversals(c, r, ["k"], "t", "t", "id"),
        "apply_cdc": lambda: merge.apply_cdc(
            health.latest_per_key(base.filter(F.col("t") < "1998-01-01"), "k", ["t", "id"]),
            base.filter(F.col("t") >= "1998-01-01").withColumn("op", F.when(F.col("flag") == "R", "DELETE")),
            ["k"], "op", "t", tie="id", cols=["id", "t", "flag"], broadcast=False),
    }
    walls = {}
    for name, build in probes.items():
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        walls[name] = time.perf_counter() - t0
    spark.stop()
    worst = stage_spread(log_dir)
    for name, wall in walls.items():
        if name in worst:
            sid, mx, med, n = worst[name]
            print(f"{name:16s} wall {wall:6.2f}s  slowest stage {sid}: {n} tasks, max {mx} ms, median {med:.0f} ms")
        else:
            print(f"{name:16s} wall {wall:6.2f}s")


if __name__ == "__main__":
    main()
