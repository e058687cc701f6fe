"""Seeded sampling without replacement (S7, R2) and class rebalancing.

Row order comes from md5 over a row key, the group and a seed, so results depend
neither on partitioning nor on the values. The first digits of the hash cut every
group into even buckets; from the bucket sizes alone it is known which buckets a
sample reaches into, so only those rows are ranked, each bucket by itself."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.operators.prefix import prefix_sums

#: Hex digits of the bucket (4,096 buckets per group).
DIGITS = 3


def _hash(key: str, seed: int) -> Column:
    return F.xxhash64(F.lit(int(seed)), F.col(key))


def _unit(h: Column) -> Column:
    """Map a 64-bit hash to [0, 1)."""
    return (h.cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)


def order_hash(key: str, seed: int, groups: Sequence[str] = ()) -> Column:
    """md5 of the row key, the group columns and the seed."""
    return F.md5(F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, *groups)],
                          F.lit(str(int(seed)))))


def hash_sample(df: DataFrame, groups: Sequence[str], k: int, seed: int = 42,
                key: str = "row_id") -> DataFrame:
    """R2: ``min(k, n_g)`` rows of each group, the first by md5 (ties by key)."""
    if key not in df.columns:
        raise ValueError(f"sampling needs a row key; there is no column '{key}'")
    groups = list(groups)
    h = order_hash(key, seed, groups)
    tagged = df.select("*", h.alias("_h")).withColumn(
        "_b", F.conv(F.substring("_h", 1, DIGITS), 16, 10).cast("int"))
    sizes = tagged.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    reached = (sizes.select(*groups, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
               .where(F.col("_before") < int(k)))
    w = Window.partitionBy(*groups, "_b").orderBy("_h", key)
    picked = (tagged.join(reached, [*groups, "_b"])
              .select("*", (F.row_number().over(w) + F.col("_before")).alias("_rn")).where(F.col("_rn") <= int(k)))
    return picked.select(*df.columns)


def sample_rows(df: DataFrame, n: int, seed: int = 42, key: str = "row_id") -> DataFrame:
    """``min(n, rows)`` rows without replacement, the first by md5 of ``key``."""
    return hash_sample(df, [], n, seed, key)


def rebalance_positives(df: DataFrame, factor: float, label: str = "label", seed: int = 42,
                        key: str = "row_id") -> DataFrame:
    """Scale the positive count to ``int(P * factor)``. Down: keep the
    first positives in seeded hash order. Up: every positive is repeated
    ``extra // P`` more times and the first ``extra % P`` once more."""
    pos = df.where(F.col(label) == 1)
    neg = df.where(F.col(label).isNull() | (F.col(label) != 1))
    h = _hash(key, seed)
    ranked = prefix_sums(
        pos.select("*", h.alias("_h"), F.floor(_unit(h) * 1024).cast("int").alias("_b"),
                   F.lit(1).alias("_one")),
        [], "_b", ["_h", key], {"_rank": "_one"}, with_total=True)
    P = F.col("_rank_total")
    target = F.floor(P * F.lit(float(factor)))
    extra = target - P
    copies = F.when(target <= P, F.when(F.col("_rank") <= target, 1).otherwise(0)).otherwise(
        1 + F.floor(extra / P) + F.when(F.col("_rank") <= extra % P, 1).otherwise(0))
    out = ranked.select(*df.columns, copies.cast("int").alias("_copies")).where(F.col("_copies") > 0)
    rep = out.select("*", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("replica"))
    return rep.drop("_copies").unionByName(neg.select("*", F.lit(1).alias("replica")))
