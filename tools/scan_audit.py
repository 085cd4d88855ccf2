"""How many times each registered query really scans each input table.

    python tools/scan_audit.py [sf_dir] [query ...]

Two counts: the scans of the returned plan, and those of the jobs that building
the query runs before it returns (the calendar, stored states), from the event log.

Walks the physical plan (not its text, which prints a cached subtree once per
use and AQE's initial and final plans both): the current plan of every
adaptive node, each cached relation once however often it is read, reused
exchanges not at all.  A scan is keyed by table and number of columns read,
so a full read is told apart from a narrow one (the calendar reads ``ts``
only).  Scans of one table over disjoint date ranges count separately.
"""

from __future__ import annotations

import collections
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _seq(s):
    return [s.apply(i) for i in range(s.size())]


def scan_counts(df) -> collections.Counter:
    """Counter of ``table[<n>c]`` -> physical scans in ``df``'s plan."""
    jvm = df.sparkSession._jvm
    counts: collections.Counter = collections.Counter()
    seen: set = set()

    def walk(node):
        cls = node.getClass().getSimpleName()
        if cls == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if cls.endswith("QueryStageExec"):
            return walk(node.plan())
        if cls == "ReusedExchangeExec":
            return
        if cls == "InMemoryTableScanExec":
            builder = node.relation().cacheBuilder()
            ident = jvm.System.identityHashCode(builder)
            if ident not in seen:
                seen.add(ident)
                walk(builder.cachedPlan())
            return
        if cls == "FileSourceScanExec":
            root = str(_seq(node.relation().location().rootPaths())[0]).rstrip("/").rsplit("/", 1)[-1]
            table = root[: -len(".parquet")] if root.endswith(".parquet") else root
            counts[f"{table}[{node.requiredSchema().size()}c]"] += 1
            return
        for child in _seq(node.children()):
            walk(child)
        for sub in _seq(node.subqueries()):
            walk(sub)

    walk(df._jdf.queryExecution().executedPlan())
    return counts


def eager_scan_counts(event_log: str, start: int = 0) -> tuple[collections.Counter, int, int]:
    """Scans of the SQL executions in an event log from byte ``start`` on, by
    table; the number of executions; and the log's length.  Run around the
    building of a query (before any action on it), this shows the jobs that
    building it runs."""
    counts: collections.Counter = collections.Counter()
    runs = 0
    with open(event_log, encoding="utf-8") as f:
        f.seek(start)
        for line in f:
            event = json.loads(line)
            if not event["Event"].endswith("SQLExecutionStart"):
                continue
            runs += 1
            todo = [event["sparkPlanInfo"]]
            while todo:
                node = todo.pop()
                todo += node["children"]
                if node["nodeName"].startswith("Scan parquet"):
                    where = node["metadata"].get("Location", "").rstrip("].").rsplit("/", 1)[-1]
                    columns = node["metadata"].get("ReadSchema", "").count(":")
                    counts[f"{where.removesuffix('.parquet')}[{columns}c]"] += 1
        return counts, runs, f.tell()


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.001"
    from tools.local import local_session
    from vhist.plans.catalog import QUERIES

    folder = tempfile.mkdtemp(prefix="vhist-events-")
    events = {"enabled": "true", "dir": f"file://{folder}", "rolling.enabled": "false", "compress": "false"}
    spark = local_session(app="vhist-scan-audit", conf={f"spark.eventLog.{k}": v for k, v in events.items()})
    log = os.path.join(folder, next(n for n in os.listdir(folder) if not n.startswith(".")))
    at = 0
    tables = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    show = lambda counts: ", ".join(f"{k} x{v}" for k, v in sorted(counts.items()) if k.split("[")[0] in tables) or "none"
    for name in args or sorted(QUERIES):
        _, _, at = eager_scan_counts(log, at)
        df = QUERIES[name](spark, sf_dir)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        eager, runs, at = eager_scan_counts(log, at)
        print(f"{name}: plan {show(scan_counts(df))}; {runs} executions while built: {show(eager)}", flush=True)
        spark.catalog.clearCache()
    spark.stop()


if __name__ == "__main__":
    main()
