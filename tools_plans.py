"""Summarise the executed (final AQE) plans of the headline queries: every
shuffle with its partitioning and the rows it carried, every join with its
strategy. Usage: python tools_plans.py [sf_dir] > PLANS.md"""
from __future__ import annotations

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bench import HEADLINE  # noqa: E402
from driftline.plans.queries import registry  # noqa: E402
from driftline.session import get_spark  # noqa: E402

JOINS = ("BroadcastHashJoinExec", "SortMergeJoinExec", "ShuffledHashJoinExec",
         "BroadcastNestedLoopJoinExec", "CartesianProductExec")


def walk(node, shuffles, joins, seen):
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return walk(node.executedPlan(), shuffles, joins, seen)
    if name.endswith("QueryStageExec"):
        return walk(node.plan(), shuffles, joins, seen)
    if name == "ReusedExchangeExec":
        shuffles.append(("reused", "", 0))
        return None
    if name == "ShuffleExchangeExec":
        key = node.id() if hasattr(node, "id") else id(node)
        if key not in seen:
            seen.add(key)
            m = node.metrics().get("shuffleRecordsWritten")
            part = node.outputPartitioning().toString()
            part = part.split("#")[0] if "SinglePartition" in part else \
                "hash(" + ", ".join(e.split("#")[0] for e in part[part.find("(") + 1:].split(", ")[:-1]) + ")"
            shuffles.append(("shuffle", part, int(m.get().value()) if m.isDefined() else -1))
    if name in JOINS:
        joins[name] += 1
    for seq in (node.subqueries(), node.children()):
        for i in range(seq.size()):
            walk(seq.apply(i), shuffles, joins, seen)
    return None


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark(shuffle_partitions=16)
    q = registry()
    print(f"# Executed plans of the headline queries ({os.path.basename(sf)})\n")
    print("Generated by `tools_plans.py` from the final adaptive plans after execution. Each shuffle "
          "is listed with its partitioning and the rows it wrote.\n")
    for name in HEADLINE:
        df = q[name](spark, sf)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()
        shuffles, joins = [], Counter()
        walk(qe.executedPlan(), shuffles, joins, set())
        real = [s for s in shuffles if s[0] == "shuffle"]
        single = [s for s in real if s[1].startswith("SinglePartition")]
        print(f"## {name}\n")
        print(f"- shuffles: {len(real)} (+{len(shuffles) - len(real)} reused); "
              f"single-partition: {len(single)}"
              + (f", rows carried {[s[2] for s in single]}" if single else ""))
        print(f"- joins: {dict(joins) if joins else 'none'}")
        print(f"- largest shuffles (rows): "
              f"{sorted(((s[2], s[1]) for s in real), reverse=True)[:4]}\n")


if __name__ == "__main__":
    main()
