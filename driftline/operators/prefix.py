"""Two-level prefix sums: exact running totals without a single-partition window.

A window ordered over a whole group puts the group in one task. Here the sort
key is cut into monotone buckets: rows are summed inside ``(group, bucket)``
window partitions, and each bucket gets the total of the buckets before it from
a small per-bucket table (one row per group and bucket) windowed on its own.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def prefix_sums(df: DataFrame, groups: Sequence[str], bucket: str, order: Sequence[str],
                weights: Mapping[str, str], descending: bool = False,
                with_total: bool = False) -> DataFrame:
    """Add inclusive running sums ``out = sum(weight)`` ordered by ``order``
    within ``groups``. ``bucket`` must be monotone in ``order`` (same direction)
    and rows must be unique per (groups, order), e.g. grouped by value first.
    With ``with_total`` also add ``<out>_total``, the group total."""
    def _o(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    local_w = (Window.partitionBy(*groups, bucket).orderBy(*[_o(c) for c in order])
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = df.select("*", *[F.sum(w).over(local_w).alias(f"__loc_{o}") for o, w in weights.items()])

    totals = df.groupBy(*groups, bucket).agg(*[F.sum(w).alias(f"__tot_{o}") for o, w in weights.items()])
    off_w = (Window.partitionBy(*groups).orderBy(_o(bucket))
             .rowsBetween(Window.unboundedPreceding, -1))
    all_w = Window.partitionBy(*groups)
    offsets = totals.select(*groups, bucket, *[
        F.coalesce(F.sum(f"__tot_{o}").over(off_w), F.lit(0)).alias(f"__off_{o}") for o in weights],
        *[F.sum(f"__tot_{o}").over(all_w).alias(f"{o}_total") for o in weights if with_total])

    joined = local.join(offsets, [*groups, bucket], "inner")
    keep = [c for c in df.columns]
    return joined.select(*keep, *[(F.col(f"__loc_{o}") + F.col(f"__off_{o}")).alias(o) for o in weights],
                         *[f"{o}_total" for o in weights if with_total])

