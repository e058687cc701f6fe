"""Benchmark: headline queries at $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS]; prints one JSON line.

Besides per-query seconds it reports
* monitored values per second of the flagship pass (window rows x 4 features),
* the growth of the flagship time from sf0.01 to the bench scale,
* every single-partition shuffle in the executed headline plans, with the most
  rows one of them actually carried (read from the plan's shuffle metrics)."""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driftline.plans import fixture as fixture_mod  # noqa: E402
from driftline.plans.queries import registry  # noqa: E402
from driftline.session import get_spark  # noqa: E402

HEADLINE = ["monitor_batch", "psi_levels", "ks_pvalue", "prediction_drift", "threshold_metrics",
            "pr_auc", "threshold_sweep", "gate_result", "policy_backtest", "time_split",
            "training_window", "drift_report_rows"]


def single_partition_shuffles(node, out: list) -> list:
    """Rows written by each SinglePartition shuffle of an executed plan."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return single_partition_shuffles(node.executedPlan(), out)
    if name.endswith("QueryStageExec"):
        return single_partition_shuffles(node.plan(), out)
    if name == "ReusedExchangeExec":
        return single_partition_shuffles(node.child(), out)
    if name == "ShuffleExchangeExec" and node.outputPartitioning().toString().startswith("SinglePartition"):
        m = node.metrics().get("shuffleRecordsWritten")
        out.append(int(m.get().value()) if m.isDefined() else -1)
    for seq in (node.subqueries(), node.children()):
        for i in range(seq.size()):
            single_partition_shuffles(seq.apply(i), out)
    return out


def run(df) -> list:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return single_partition_shuffles(qe.executedPlan(), [])


def shuffled_rows(df) -> list[int]:
    """Rows written by every shuffle of the executed plan."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ReusedExchangeExec":
            return walk(node.child())
        if name == "ShuffleExchangeExec":
            m = node.metrics().get("shuffleRecordsWritten")
            found.append(int(m.get().value()) if m.isDefined() else -1)
        for seq in (node.subqueries(), node.children()):
            for i in range(seq.size()):
                walk(seq.apply(i))
    walk(qe.executedPlan())
    return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    q = registry()
    times: dict[str, float] = {}

    t0 = time.time()
    fx = fixture_mod.txn_fixture(spark, sf_dir)      # builds and freezes the reference profile
    times["build_profile"] = round(time.time() - t0, 3)
    n_ref, n_win = fx.reference.count(), fx.windows.count()

    shuffles: list[int] = []
    for name in HEADLINE:
        t0 = time.time()
        shuffles += run(q[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)

    growth = None
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    if os.path.isdir(small) and os.path.abspath(small) != os.path.abspath(sf_dir):
        fixture_mod.txn_fixture(spark, small)
        t0 = time.time()
        run(q["monitor_batch"](spark, small))
        growth = round(times["monitor_batch"] / (time.time() - t0), 2)

    total = round(sum(times.values()), 3)
    out = {
        "metric": "total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows": n_ref + n_win,
        "monitor_values_per_sec": round(n_win * 4 / times["monitor_batch"], 1),
        "profile_values_per_sec": round(n_ref * 4 / times["build_profile"], 1),
        "monitor_growth_sf0.01_to_bench": growth,
        "single_partition_shuffles": len(shuffles),
        "single_partition_max_rows": max(shuffles) if shuffles else 0,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
