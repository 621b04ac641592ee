"""Benchmark: the whole build and its headline queries at one scale factor.

Prints ONE JSON line:
  {"metric": "pipeline_sec", "value": <bronze+silver+gold+dashboard>, "unit": "sec",
   "queries": {...per stage and per mart...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per item after one untimed warm-up of that item, median
reported; default 3).  The spread is the largest over the smallest timed run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from tarmac.session import build_session

    spark = build_session(
        "tarmac-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(max(8, 2 * cpus)),
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": f"file://{tempfile.mkdtemp(prefix='tarmac-bench-')}",
        },
    )

    from tarmac.operators import marts
    from tarmac.plans import build_bronze, build_gold, build_silver
    from tarmac.plans.dashboard import Dashboard
    from tarmac.plans.gold import previews
    from tarmac.plans.silver import OBT_TABLE
    from tarmac.registry import build_config, export_sources
    from tarmac.sources.tables import load_table

    cfg = build_config(spark, sf_dir + "/bench")
    # Setup, not timed: the CSV sources derived from the parquet tables.
    sources = export_sources(spark, sf_dir, cfg)

    def drain(df) -> int:
        return len(df.collect())

    def bronze():
        return drain(build_bronze(spark, cfg, sources))

    def silver():
        return drain(build_silver(spark, cfg))

    def gold():
        return drain(build_gold(spark, cfg))

    def dashboard():
        board = Dashboard(spark, cfg)
        n = 0
        for tab in (board.revenue_tab(), board.performance_tab(), board.revenue_tab(None)):
            n += sum(drain(df) for df in tab.values())
        n += sum(drain(df) for df in previews(spark, cfg).values())
        board.close()
        return n

    def mart(name):
        def run():
            obt = load_table(spark, cfg, "silver", OBT_TABLE)
            return drain(marts.build_mart(obt, name, cfg))

        return run

    def timed(fn) -> float:
        t0 = time.perf_counter()
        fn()
        return time.perf_counter() - t0

    stages = [("bronze", bronze), ("silver", silver), ("gold", gold), ("dashboard", dashboard)]
    items = [*stages, *((f"mart:{spec.name}", mart(spec.name)) for spec in marts.MARTS)]
    # Warm-up: one full pass over every item (JVM JIT, file listing caches).
    for _, fn in items:
        fn()
    results: dict[str, list[float]] = {name: [] for name, _ in items}
    for _ in range(runs):
        for name, fn in items:
            results[name].append(timed(fn))

    queries = {k: round(statistics.median(v), 3) for k, v in results.items()}
    total = round(sum(queries[name] for name, _ in stages), 3)
    spread = {k: round(max(v) / min(v), 2) for k, v in results.items()}
    out = {"metric": "pipeline_sec", "value": total, "unit": "sec", "queries": queries, "sf": sf}
    print(json.dumps({**out, "cpus": cpus, "machine_cores": os.cpu_count(), "runs": runs, "spread": spread}))
    spark.stop()


if __name__ == "__main__":
    main()
