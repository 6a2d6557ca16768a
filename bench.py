"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

computed, nothing collected); one first run of every query, reported as ``cold`` (it also pays
for the table statistics, lookup checks and inlined rows that later runs find cached), then timed
rounds over all queries; the median per query is reported. The
headline value is the sum of the headline medians (default ``auto`` numbering: plain window when
a proven bound shows every group fits one task, split plan for hot groups). Extra entries force the
skew-proof split numbering (``__split``, the plan used for huge or hot groups), a plain
one-window ``row_number`` without staging (``__window``), and plain ranking without the
priority-1 pre-filter (``__no_prefilter``); all give the same results.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from slipflow.operators import manifest, selection  # noqa: E402
from slipflow.plans import catalog  # noqa: E402
from slipflow.session import local_session  # noqa: E402

HEADLINE = ["selected_documents", "batch_manifest", "batch_orders", "fetch_status"]


def variants(spark, sf_dir):
    reg = catalog.registry(spark, sf_dir)
    cfg = catalog.CFG
    return {
        "selected_documents__split": lambda: selection.selected_documents(reg, cfg, strategy="split"),
        "batch_manifest__split": lambda: manifest.batch_manifest(
            selection.selected_documents(reg, cfg, ordered=False, strategy="split"),
            catalog.MANIFEST_FOLDER_SIZE, strategy="split"),
        "batch_orders__split": lambda: manifest.batch_orders(
            spark.read.parquet(f"{sf_dir}/orders.parquet"), catalog.ORDERS_FOLDER_SIZE,
            strategy="split"),
        "selected_documents__window": lambda: selection.selected_documents(reg, cfg, strategy="window"),
        "selected_documents__no_prefilter": lambda: selection.selected_documents(reg, cfg, prefilter=False),
        "batch_manifest__window": lambda: manifest.batch_manifest(
            selection.selected_documents(reg, cfg, ordered=False, strategy="window"),
            catalog.MANIFEST_FOLDER_SIZE, strategy="window"),
        "batch_orders__window": lambda: manifest.batch_orders(
            spark.read.parquet(f"{sf_dir}/orders.parquet"), catalog.ORDERS_FOLDER_SIZE,
            strategy="window"),
    }


def run_once(build) -> float:
    t = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def timed_all(queries: dict, runs: int) -> dict:
    """Run every query once cold, then time them in round-robin rounds (so JVM warm-up and
    machine noise do not land on one query)."""
    cold = {name: round(run_once(build), 3) for name, build in queries.items()}
    times = {name: [] for name in queries}
    for _ in range(runs):
        for name, build in queries.items():
            times[name].append(run_once(build))
    return {name: {"median": round(statistics.median(t), 3), "min": round(min(t), 3),
                   "max": round(max(t), 3), "cold": cold[name]} for name, t in times.items()}


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus if cpus != "*" else "8"))
    spark = local_session(cores=cpus, shuffle_partitions=partitions, app="slipflow-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    queries = {name: (lambda n=name: catalog.QUERIES[n](spark, sf_dir)) for name in HEADLINE}
    queries.update(variants(spark, sf_dir))
    detail = timed_all(queries, runs)
    value = round(sum(detail[n]["median"] for n in HEADLINE), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_queries_total_median",
        "value": value,
        "unit": "sec",
        "queries": {n: d["median"] for n, d in detail.items()},
        "ranges": {n: [d["min"], d["max"]] for n, d in detail.items()},
        "cold": {n: d["cold"] for n, d in detail.items()},
        "cold_total": round(sum(detail[n]["cold"] for n in HEADLINE), 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "config": {"cores": cpus, "driver_memory": spark.conf.get("spark.driver.memory"),
                   "spark": spark.version, "shuffle_partitions": partitions,
                   "aqe": spark.conf.get("spark.sql.adaptive.enabled"), "runs": runs,
                   "sink": "noop"},
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
