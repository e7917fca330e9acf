"""Per-stage task statistics from Spark's event log.

Runs the stock fold (and, for contrast, a fold done with one window per key)
over observations derived from ``events`` in which one user holds a third of
all rows, with the event log written to a new scratch folder, then prints per
stage: tasks, max / median task time and max / median records read. A skewed
plan shows one task far above the median.

Usage: python tools/stage_report.py [sf_dir]
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

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from shelfwise.operators import stock  # noqa: E402
from shelfwise.plans import views as V  # noqa: E402
from shelfwise.session import local_session  # noqa: E402


def skewed_observations(spark, base):
    obs = V.event_observations(spark, base)
    # every third event goes to user 0: one key holds a third of all rows
    return obs.withColumn("user_id", F.when(F.pmod("step", F.lit(3)) == 0, F.lit(0)).otherwise(F.col("user_id")))


def window_fold(obs):
    """The plain formulation: one window per key (all rows of a key in one task)."""
    f = stock.observation_flags(obs, ["user_id"])
    w = Window.partitionBy("user_id").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    f = f.withColumn("stop_before", F.coalesce(F.max("is_stop").over(w), F.lit(False)))
    live = ~F.col("stop_before")
    return f.groupBy("user_id").agg(
        F.max(F.when(live, F.col("fail"))).alias("failed"),
        F.max_by(F.when(live, F.col("parsed")), F.when(live & F.col("parsed").isNotNull(), F.col("step"))).alias("q"))


def stage_stats(log_dir):
    tasks = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = e.get("Task Metrics") or {}
                info = e["Task Info"]
                recs = (m.get("Input Metrics", {}).get("Records Read", 0)
                        + m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0))
                tasks.setdefault(e["Stage ID"], []).append((info["Finish Time"] - info["Launch Time"], recs))
    return tasks


def run(name, df, extra_conf):
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = local_session(8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
                                    **extra_conf})
    t0 = time.perf_counter()
    df(spark).write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    spark.stop()
    print(f"\n{name}: {wall:.2f} s wall")
    print("stage  tasks  max_ms  median_ms  max_records  median_records")
    for sid, ts in sorted(stage_stats(log_dir).items()):
        d = [t for t, _ in ts]
        r = [x for _, x in ts]
        print(f"{sid:5d} {len(ts):6d} {max(d):7d} {statistics.median(d):10.0f} {max(r):12d} {statistics.median(r):15.0f}")


def main():
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    warm = local_session(8, extra=conf)                    # untimed warm-up of the JVM
    for q in (stock.fold_stock(skewed_observations(warm, base), ["user_id"], bucket_steps=1024),
              window_fold(skewed_observations(warm, base))):
        q.write.format("noop").mode("overwrite").save()
    warm.stop()
    run("bucketed fold (shelfwise)", lambda s: stock.fold_stock(skewed_observations(s, base), ["user_id"],
                                                                 bucket_steps=1024), conf)
    run("window per key", lambda s: window_fold(skewed_observations(s, base)), conf)


if __name__ == "__main__":
    main()
