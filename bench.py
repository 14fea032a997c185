"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ..., ...}

Each query is timed end to end (its writes, gates and read-backs) and its
returned DataFrame is fully executed with the ``noop`` sink, so nothing is
collected to the driver. The quality gate is also timed two ways on the same
silver orders: fused (two actions: all scalar rules, then a key-only shuffle)
and one action per rule (what a check-by-check gate does), with the Spark job
count of each.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from terrace import sources  # noqa: E402
from terrace import session as S  # noqa: E402
from terrace.operators import quality as Q  # noqa: E402
from terrace.plans import events, orders  # noqa: E402
from terrace.plans.jobs import publish  # noqa: E402
from terrace.queries import QUERIES, _land_events, _orders_as_text, _run  # noqa: E402
from terrace.session import build_session  # noqa: E402

HEADLINE = [
    "silver_normalize",
    "silver_gate_observed",
    "gold_enrich",
    "bi_snapshot",
    "medallion_chain",
    "backfill_business_date",
    "partition_scan",
    "partition_prune_filter",
    "partition_overwrite_day",
    "snapshot_csv_single_file",
    "numeric_partition_layout",
    "run_summary",
    "quality_report",
    "quality_pk_duplicates",
    "csv_bronze_scan",
    "stream_landing_ingest",
]


def _per_rule_gate(df, contract, run):
    """One count() per rule over the uncached frame (the check-by-check shape)."""
    rules = Q.compile_rules(contract, df.columns, run)
    for rule in rules:
        if rule.predicate is None:
            df.where(Q._key_not_null(contract.primary_key)).groupBy(*contract.primary_key).count().where("count > 1").count()
        else:
            df.where(rule.predicate).count()
    return len(rules)


def _jobs_in(spark, group, fn):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def _scan_files_read(df) -> int | None:
    """``number of files read`` of the file scans in the executed plan of ``df``."""
    try:
        plan = df._jdf.queryExecution().executedPlan()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plan = plan.executedPlan()
        total, stack = 0, [plan]
        while stack:
            node = stack.pop()
            if node.getClass().getSimpleName() == "FileSourceScanExec":
                total += int(node.metrics().apply("numFiles").value())
            children = node.children()
            stack.extend(children.apply(i) for i in range(children.size()))
        return total
    except Exception:  # noqa: BLE001 - informational
        return None


def _layout_checks(spark, sf_dir):
    """Day replacement touches only that day; the snapshot input reads one day's files."""
    root = S.scratch_path(spark, "bench_layout")
    silver = orders.to_silver(_orders_as_text(spark, sf_dir), _run())
    gold = f"{root}/gold"
    for day, run_id in (("2026-04-02", "a"), ("2026-04-03", "b")):
        r = _run(day, run_id)
        publish(orders.to_gold(silver, r), orders.gold_spec(gold), r)
    before = set(S.data_files(spark, gold, "parquet"))
    r = _run("2026-04-03", "c")
    publish(orders.to_gold(silver, r), orders.gold_spec(gold), r)
    after = set(S.data_files(spark, gold, "parquet"))
    other_day = [p for p in before if "/day=2/" in p]
    untouched = set(other_day) <= after and len(other_day) > 0  # every write names its files anew
    current_replaced = not any(p in before for p in after if "/day=3/" in p)
    snapshot = orders.to_bi(sources.read_partitioned(spark, gold), _run())
    plan = snapshot._jdf.queryExecution().executedPlan().toString()
    # Run this query execution JVM-side (no rows to the driver) so its scan metrics fill in.
    snapshot._jdf.queryExecution().toRdd().count()
    return {
        "day_replacement_only_that_day": bool(untouched and current_replaced),
        "snapshot_partition_filters": "PartitionFilters: [" in plan and "(day#" in plan.split("PartitionFilters: [", 1)[1],
        "snapshot_files_read": _scan_files_read(snapshot),
        "gold_files_total": len(after),
    }


def _landing_rate(spark, sf_dir):
    root = S.scratch_path(spark, "bench_landing")
    _land_events(spark, sf_dir, f"{root}/landing")
    n_files = len(S.data_files(spark, f"{root}/landing", "csv"))
    start = time.perf_counter()
    runs = events.ingest_landing(spark, f"{root}/landing", f"{root}/silver", f"{root}/_checkpoint")
    seconds = time.perf_counter() - start
    return {"landing_files": n_files, "landing_runs": runs, "landing_files_per_sec": round(n_files / seconds, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # The bench writes to the local disk. Without the native Hadoop library
    # every file the checksumming local file system creates (data + .crc
    # sidecar) spawns a chmod process; the raw local file system skips the
    # sidecar. Cluster file systems are not affected. Set BENCH_LOCAL_FS=checksum
    # to measure with the default.
    conf = {"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2)), "spark.driver.memory": "8g"}
    local_fs = os.environ.get("BENCH_LOCAL_FS", "raw")
    if local_fs == "raw":
        conf["spark.hadoop.fs.file.impl"] = "org.apache.hadoop.fs.RawLocalFileSystem"
    spark = build_session(f"local[{cpus}]", app_name="terrace-bench", conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    match = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(match.group(1)) if match else None

    # Warm-up on the smallest tables (JIT, code paths); the timed runs use sf_dir.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in ("flag_yes_no", "bi_snapshot", "quality_report"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)

    # Gate comparison on the same silver orders (persisted once, as a job would).
    run = _run()
    silver = orders.to_silver(_orders_as_text(spark, sf_dir), run).persist(StorageLevel.MEMORY_AND_DISK)
    silver.count()
    fused, per_rule = [], []
    fused_jobs = per_rule_jobs = 0
    for i in range(3):
        start = time.perf_counter()
        fused_jobs = _jobs_in(spark, f"fused-{i}", lambda: Q.enforce(silver, orders.SILVER, None))
        fused.append(time.perf_counter() - start)
        start = time.perf_counter()
        per_rule_jobs = _jobs_in(spark, f"per-rule-{i}", lambda: _per_rule_gate(silver, orders.SILVER, None))
        per_rule.append(time.perf_counter() - start)
    silver.unpersist()
    timings["gate_fused"] = round(statistics.median(fused), 3)
    timings["gate_per_rule"] = round(statistics.median(per_rule), 3)

    checks = _layout_checks(spark, sf_dir)
    checks.update(_landing_rate(spark, sf_dir))

    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").agg(F.count(F.lit(1))).first()[0] for t in ("orders", "lineitem", "events")}
    total = round(sum(v for k, v in timings.items() if k in HEADLINE), 3)
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": sf,
                "cpus": int(cpus),
                "local_fs": local_fs,
                "gate": {
                    "rules": len(Q.compile_rules(orders.SILVER, orders.SILVER.names)),
                    "fused_actions": 2,
                    "fused_jobs": fused_jobs,
                    "per_rule_actions": len(Q.compile_rules(orders.SILVER, orders.SILVER.names)),
                    "per_rule_jobs": per_rule_jobs,
                },
                "checks": checks,
                "rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
