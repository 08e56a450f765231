"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS], writes every result through the ``noop`` sink (the whole
result is computed, nothing is collected), and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}
Each query is timed warm (after one untimed run) as the median of
$BENCH_REPS runs (default 3); ``spread`` has the fastest and slowest run.
``refresh`` is timed without the full build that precedes it.

``shuffle_bytes_per_run`` and ``plan_shape`` come from Spark's event log,
written to a fresh scratch folder. The shape counts the nodes of the plans
that really ran (after adaptive re-planning), of all jobs of one run, so
eager checkpoints and model fits are in it.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["customer_features", "curated", "daily_quantity_by_country", "asof_serve", "refresh",
            "train_set", "batch_predict", "arima_fit", "forecast"]
NODES = {"exchanges": r"^(Exchange|ShuffleQueryStage)", "broadcasts": r"^Broadcast(Exchange|QueryStage)",
         "pairwise_joins": r"CartesianProduct|BroadcastNestedLoopJoin",
         "python_nodes": r"Python|Pandas|InArrow", "scans": r"^(Scan parquet|FileScan)"}


def prepared(name, query, spark, sf_dir):
    """A callable that does the timed part of a query, and what goes before."""
    if name != "refresh":
        return lambda: None, lambda _: query(spark, sf_dir)
    from basketlab.operators import store
    from basketlab.plans import queries as q

    def timed(table):
        store.refresh_features(table, q.typed(spark, sf_dir, q.REFRESH_DAY), q.raw(spark, sf_dir), q.REFRESH_DAY,
                               at=q.T1, key="hash")
        return table.read()

    return lambda: q.built_table(spark, sf_dir, q.BUILD_AS_OF), timed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from basketlab.plans.queries import QUERIES
    from basketlab.session import get_session

    log_dir = tempfile.mkdtemp(prefix="basketlab-bench-events-")
    shuffle_partitions = max(8, int(cpus) * 2)
    spark = get_session(f"local[{cpus}]", "basketlab-bench", {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="basketlab-bench-"),
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times, spread, windows = {}, {}, {}
    for name in only or HEADLINE:
        before, timed = prepared(name, QUERIES[name], spark, sf_dir)
        runs = []
        for _ in range(reps + 1):
            ready = before()
            began, t0 = time.time(), time.perf_counter()
            timed(ready).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
            windows[name] = (began, time.time())
        times[name] = round(statistics.median(runs[1:]), 3)
        spread[name] = [round(min(runs[1:]), 3), round(max(runs[1:]), 3)]
    version = spark.version
    spark.stop()
    shuffle, shapes = from_log(log_dir, windows)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "spread": spread,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "spark": version, "shuffle_partitions": shuffle_partitions,
                      "shuffle_bytes_per_run": shuffle, "plan_shape": shapes}))


def from_log(log_dir: str, windows: dict[str, tuple[float, float]]):
    """Of the last run of each query: shuffle bytes written, and the nodes of
    its plans."""
    shuffle = dict.fromkeys(windows, 0)
    plans: dict[int, dict] = {}
    started: dict[int, str] = {}

    def at(ms):
        return next((n for n, (a, b) in windows.items() if a <= ms / 1000 <= b), None)

    for folder, _, names in os.walk(log_dir):
        for file in (f for f in names if not f.startswith((".", "appstatus"))):
            with open(os.path.join(folder, file), encoding="utf-8") as lines:
                for e in map(json.loads, lines):
                    if "sparkPlanInfo" in e:
                        plans[e["executionId"]] = e["sparkPlanInfo"]  # the last is the one that ran
                        if "time" in e and at(e["time"]):
                            started[e["executionId"]] = at(e["time"])
                    elif e.get("Event") == "SparkListenerTaskEnd" and (n := at(e["Task Info"]["Launch Time"])):
                        written = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                        shuffle[n] += int(written.get("Shuffle Bytes Written", 0))
    shapes = {n: Counter(dict.fromkeys(NODES, 0)) for n in windows}
    for execution, name in started.items():
        todo = [plans[execution]]
        while todo:
            node = todo.pop()
            for kind, pattern in NODES.items():
                shapes[name][kind] += bool(re.search(pattern, node["nodeName"].strip()))
            todo += node["children"]
    return shuffle, {n: dict(c) for n, c in shapes.items()}


if __name__ == "__main__":
    main()
