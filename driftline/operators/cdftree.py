"""The reference CDF as a search tree of bounded nodes, and the KS statistic by descent.

``cdf_tree`` groups the sorted distinct values of a feature by rank: a node has at most
``FANOUT`` children, a child of the lowest level is one value, and the depth follows from
the number of values alone. A node is a row (feature, level, node) with the first value of
each child and the reference rows below it; no row has more than FANOUT values, whatever
the reference's size and the session's partitions.

``ks_statistics`` counts a batch's rows in the children of the root, where they are read
(map tasks send one row for each child that they met). At the start and end of a child both
CDFs are known, which gives a D that is attained, and a bound for its inside: as both CDFs
rise, the gap there is at most the one's value at the end less the other's at the start.
(Between two children with batch rows the batch's CDF is flat, so children without rows
add nothing.) Only children whose bound is over the attained D are opened, and the rows
that fall into them counted in their children, level by level; a child that is one value
is exact. So the price is a scan of the batch for each level and the few nodes opened; no
value of the batch is sorted or shuffled, no reference row moves, equal and clustered
values are counts like any others, and what stands beside a batch value is one node."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.columns import is_finite
from driftline.session import freeze

#: Children of a node (a power of two less one: a child is found in ten halving steps).
FANOUT = 1023
#: Levels that the build allows for: FANOUT ** 6, about 10 ** 18, distinct values.
MAX_DEPTH = 6
TREE_SCHEMA = ("model_version string, feature string, level int, node bigint, depth int, n_ref bigint, "
               "lows array<double>, below array<bigint>, rows_end bigint")


def _depth(n_values: Column, fanout: int) -> Column:
    out = F.when(n_values <= fanout, 1)
    for h in range(2, MAX_DEPTH):
        out = out.when(n_values <= fanout ** h, h)
    return out.otherwise(MAX_DEPTH)


def cdf_tree(cdf: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(feature, level, node, depth, n_ref, lows, below, rows_end) of a CDF by feature
    (quantile.value_cdf). Level 1 is the root, one row for each feature."""
    rows = cdf.select("feature", F.col("value").cast("double").alias("value"), "rank", "n", "n_values", "cum_lt",
                      "cum_le", _depth(F.col("n_values"), fanout).alias("depth"))
    # get: a filter on the level may be tried before the levels are laid out, past a feature's depth
    size = F.get(F.array(*[F.lit(fanout ** i) for i in range(MAX_DEPTH + 1)]), F.col("depth") - F.col("level"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), "depth")).alias("level")).select("*", size.alias("size"))
    first = F.col("rank") % F.col("size") == 0                        # opens a child
    node_size = F.col("size") * fanout
    last = ((F.col("rank") + 1) % node_size == 0) | (F.col("rank") + 1 == F.col("n_values"))   # ends a node
    kept = rows.where(first | last).select(
        "feature", "level", F.expr(f"rank div (size * {fanout})").alias("node"), "depth", "n",
        F.when(first, F.struct("value", "cum_lt")).alias("child"), F.when(last, F.col("cum_le")).alias("ends"))
    nodes = kept.groupBy("feature", "level", "node").agg(
        F.first("depth").alias("depth"), F.first("n").alias("n_ref"),
        F.array_sort(F.collect_list("child")).alias("children"), F.max("ends").alias("rows_end"))
    return nodes.select("feature", "level", "node", "depth", "n_ref", F.col("children.value").alias("lows"),
                        F.col("children.cum_lt").alias("below"), "rows_end")


KEY = ["batch_id", "feature"]


def _place(rows: DataFrame, keep: list[str], fanout: int = FANOUT) -> DataFrame:
    """``rows`` (columns of ``keep``, value, lows, below, rows_end) with ``child``, the number of
    ``lows`` at or below ``value`` less one (-1: below all), and both counts of that child. Two
    halving steps at a time are a projection of their own, so the search stays in generated
    code and each step reads the one before as a column."""
    rows = rows.select(*keep, "value", "lows", "below", "rows_end", F.lit(-1).alias("child"))
    steps = [1 << i for i in range(fanout.bit_length() - 1, -1, -1)]
    for i in range(0, len(steps), 2):
        def at(tail: list[int], base: str) -> str:
            if not tail:
                return base
            up = f"{base} + {tail[0]}"
            return f"CASE WHEN get(lows, {up}) <= value THEN {at(tail[1:], up)} ELSE {at(tail[1:], base)} END"
        rows = rows.selectExpr(*keep, "value", "lows", "below", "rows_end", f"{at(steps[i:i + 2], 'child')} AS child")
    return rows.selectExpr(*keep, "value", "child", "get(lows, child) = value AS is_low",
                           "CASE WHEN child < 0 THEN 0 ELSE get(below, child) END AS r_lt",
                           "CASE WHEN child < 0 THEN 0 ELSE coalesce(get(below, child + 1), rows_end) END AS r_le")


def _measured(placed: DataFrame, level: int, fanout: int = FANOUT) -> DataFrame:
    """The children with rows that can hold a gap larger than any attained (``open``), and
    those where the largest is attained."""
    same = ["r_lt", "r_le", "depth", "n_ref"] + ["start", "n_cur", "attained"] * (level > 1)
    cells = placed.groupBy(*KEY, "node", "child").agg(
        F.sum("nb").alias("rows"), F.sum(F.when(F.col("is_low"), F.col("nb")).otherwise(0)).alias("equal"),
        *[F.first(c).alias(c) for c in same])
    by = Window.partitionBy(*KEY)
    run = F.sum("rows").over(Window.partitionBy(*KEY, "node").orderBy("child")
                             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    start = F.col("start") if level > 1 else F.lit(0)
    cells = cells.select("*", (start + run).alias("b_le"))
    if level == 1:
        cells = cells.select("*", F.sum("rows").over(by).alias("n_cur"), F.lit(0.0).alias("attained"))
    cells = cells.select("*", (F.col("b_le") - F.col("rows")).alias("b_lt"))
    nr, nb = F.col("n_ref"), F.col("n_cur")
    at = F.when(F.col("depth") == level, F.abs(F.col("r_le") / nr - (F.col("b_lt") + F.col("equal")) / nb))
    gap = F.greatest(F.abs(F.col("r_lt") / nr - F.col("b_lt") / nb), F.abs(F.col("r_le") / nr - F.col("b_le") / nb),
                     F.when(F.col("child") >= 0, at))
    most = F.greatest(F.col("r_le") / nr - F.col("b_lt") / nb, F.col("b_le") / nb - F.col("r_lt") / nr)
    cells = cells.select("*", gap.alias("gap"), most.alias("most"))
    cells = cells.select("*", F.max("gap").over(by).alias("_g")).select("*", F.greatest("_g", "attained").alias("best"))
    more = (F.col("depth") > level) & (F.col("child") >= 0) & (F.col("most") > F.col("best"))
    return cells.where(more | (F.col("gap") == F.col("_g"))).select(
        *KEY, (F.col("node") * fanout + F.col("child")).alias("node"), "depth", "n_ref", "n_cur",
        F.col("b_lt").alias("start"), "best", more.alias("open"))


def ks_statistics(rows: DataFrame, tree: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Two-sample KS D per (batch_id, feature) of ``rows`` (batch_id, feature, value, nb:
    how often; non-finite values are left out), with n_ref and n_cur. Every level but the
    last writes its children that stay open (a small table), so plans don't nest."""
    node = ["feature", "node", "lows", "below", "rows_end"]
    roots = F.broadcast(tree.where("level = 1").select(*node, "depth", "n_ref"))   # one row of a feature
    carried = [*KEY, "node", "nb", "depth", "n_ref"]
    placed = _place(rows.where(is_finite("value")).select(*KEY, "value", "nb").join(roots, "feature"), carried, fanout)
    levels, best = tree.agg(F.max("depth")).first()[0] or 1, None
    for level in range(1, levels + 1):
        found = _measured(placed, level, fanout)
        if level < levels:
            found = freeze(found, f"ks-level{level}")
        here = found.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in ("best", "n_ref", "n_cur")])
        best = here if best is None else best.unionByName(here)
        if level < levels:
            opened = found.where("open").select(*KEY, "node", "depth", "n_ref", "n_cur", "start",
                                                F.col("best").alias("attained"))
            # never null, so that no null test is pushed down through the steps of the search
            into = F.coalesce(F.col("node") * fanout + F.col("child"), F.lit(-1).cast("long"))
            # only rows in an opened child are dealt out; the rest end where they are read
            inside = placed.select(*KEY, "value", "nb", into.alias("node")) \
                .join(opened.select(*KEY, "node"), [*KEY, "node"])
            nodes = opened.join(tree.where(F.col("level") == level + 1).select(*node), ["feature", "node"])
            placed = _place(inside.join(nodes, [*KEY, "node"]), [*carried, "start", "n_cur", "attained"], fanout)
    return best.groupBy(*KEY).agg(F.max("best").alias("ks_statistic"), F.max("n_ref").alias("n_ref"),
                                  F.max("n_cur").alias("n_cur"))
