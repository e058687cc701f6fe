"""Exact, distributed quantiles and empirical CDFs.

Linear interpolation between order statistics (position p * (n - 1)), the same
definition as NumPy's default and SQL ``quantile_cont``. Nothing holds a whole
group in one task: values are counted per (group, value), cut into buckets at
approximate quantiles of the distinct values (a bounded sketch), ranked with a
two-level prefix sum, and the few ranks each quantile needs are matched in a
broadcast join against the (group, value) ranges.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.columns import is_finite
from driftline.operators.prefix import prefix_sums
from driftline.session import freeze

DEFAULT_BUCKETS = 128
SKETCH_ACCURACY = 10000

# 11 probabilities of 10 quantile bins, computed the stepwise way
# (i * 0.1), plus the 1st, 50th and 99th percentiles of the profile.
def bin_probabilities(bins: int) -> list[float]:
    step = 1.0 / bins
    return [i * step for i in range(bins + 1)]


def n_buckets_for(df: DataFrame) -> int:
    """Buckets of a two-level running sum: as many as the session deals shuffles to,
    so that the work spreads as far as the cluster is told to spread it."""
    conf = df.sparkSession.conf.get("spark.sql.shuffle.partitions", str(DEFAULT_BUCKETS))
    return max(DEFAULT_BUCKETS, int(conf))


def bucket_cuts(values: DataFrame, groups: Sequence[str], value: str,
                n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Approximate cut points per group (bounded size: < n_buckets doubles)."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    return values.groupBy(*groups).agg(
        F.array_distinct(F.percentile_approx(value, probs, SKETCH_ACCURACY)).alias("cuts"))


def bucket_of(value, cuts, n_cuts: int = DEFAULT_BUCKETS - 1) -> F.Column:
    """Number of cut points <= value, by binary search over the sorted cuts: a
    nested CASE of depth log2(n_cuts) for up to 255 cuts (codegen friendly), a fold
    over the halving steps for more. Cuts past the array end read as NULL and
    count as above every value."""
    v = F.col(value) if isinstance(value, str) else value
    c = F.col(cuts) if isinstance(cuts, str) else cuts

    if n_cuts > 255:
        steps = [1 << i for i in range(n_cuts.bit_length() - 1, -1, -1)]
        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                           lambda at, s: F.when(F.get(c, at + s - 1) <= v, at + s).otherwise(at))

    def search(lo: int, hi: int) -> F.Column:
        if lo >= hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.get(c, mid) <= v, search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, n_cuts)


def with_bucket(rows: DataFrame, keep: Sequence[str], value: str, n_cuts: int) -> DataFrame:
    """``keep``, the value and ``bucket``, the number of its row's sorted ``cuts`` at or below
    it. Two halving steps at a time are a projection of their own, so the search stays in
    short generated code whatever the number of cuts. Cuts past the array end read as NULL
    and count as above every value."""
    rows = rows.select(*keep, value, "cuts", F.lit(-1).alias("bucket"))
    steps = [1 << i for i in range(n_cuts.bit_length() - 1, -1, -1)]
    for i in range(0, len(steps), 2):
        def at(tail: list[int], base: str) -> str:
            if not tail:
                return base
            up = f"{base} + {tail[0]}"
            return f"CASE WHEN get(cuts, {up}) <= `{value}` THEN {at(tail[1:], up)} ELSE {at(tail[1:], base)} END"
        rows = rows.select(*keep, value, "cuts", F.expr(at(steps[i:i + 2], "bucket")).alias("bucket"))
    return rows.select(*keep, value, (F.col("bucket") + 1).alias("bucket"))


def value_cdf(long: DataFrame, groups: Sequence[str], value: str = "value",
              n_buckets: int | None = None, tag: str | None = None) -> DataFrame:
    """(groups, value, w, cum_lt, cum_le, n, bucket, rank, n_values) for every distinct
    finite value: ``w`` rows equal to it, ``cum_lt``/``cum_le`` rows below / at or below
    it, ``n`` rows in its group, ``rank`` distinct values below it of ``n_values``. With
    ``tag`` the distinct values are written once; without it the rows are read for the
    cuts and again for the counts."""
    groups = list(groups)
    n_buckets = n_buckets or n_buckets_for(long)
    counts = (long.where(is_finite(value))
              .groupBy(*groups, value).agg(F.count(F.lit(1)).alias("w"), F.lit(1).cast("long").alias("one")))
    if tag:
        counts = freeze(counts, tag)
    if groups:
        # one row of < n_buckets cut points per group (groups are features: the table is
        # bounded by the schema). Joined by a shuffle, all values of a group would meet in
        # one task, and stay there: rows dealt out by group are dealt out for the windows too
        cuts = F.broadcast(bucket_cuts(counts, groups, value, n_buckets))
        tagged = with_bucket(counts.join(cuts, groups, "inner"), [*groups, "w", "one"], value, n_buckets - 1)
    else:
        # a single group: its < n_buckets cut points are read once (a bounded row)
        probs = [i / n_buckets for i in range(1, n_buckets)]
        row = counts.agg(F.array_distinct(F.percentile_approx(value, probs, SKETCH_ACCURACY))).first()
        cut_arr = F.array(*[F.lit(float(c)) for c in (row[0] or [])]).cast("array<double>")
        tagged = with_bucket(counts.select("*", cut_arr.alias("cuts")), ["w", "one"], value, n_buckets - 1)
    ranked = prefix_sums(tagged, groups, "bucket", [value], {"cum_le": "w", "rank": "one"}, with_total=True)
    return ranked.select(*groups, value, "w", (F.col("cum_le") - F.col("w")).alias("cum_lt"),
                         "cum_le", F.col("cum_le_total").alias("n"), "bucket",
                         (F.col("rank") - 1).alias("rank"), F.col("rank_total").alias("n_values"))


def quantiles_from_cdf(cdf: DataFrame, groups: Sequence[str], probs: Sequence[float],
                       value: str = "value") -> DataFrame:
    """(groups, n, q array<double>) with q[i] the interpolated quantile at probs[i].

    Each CDF row knows its group size ``n``, so it can tell by itself whether
    it holds one of the two ranks a quantile interpolates between: no join,
    only the <= 2 * len(probs) matching rows per group are kept, and only for them the
    ranks are laid out."""
    groups = list(groups)
    hits, holds = [], F.lit(False)
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        in_lo = (F.col("cum_lt") <= lo) & (lo < F.col("cum_le"))
        in_hi = (F.col("cum_lt") <= hi) & (hi < F.col("cum_le"))
        # either rank lies in cum_lt..cum_le - 1 (short terms, for the code of one filter)
        holds = holds | ((pos > F.col("cum_lt") - 1) & (pos < F.col("cum_le")))
        hits.append(F.when(in_lo | in_hi, F.struct(
            F.lit(i).alias("pi"), pos.alias("pos"), lo.alias("r_lo"), in_lo.alias("is_lo"),
            in_hi.alias("is_hi"), F.col(value).cast("double").alias("v"))))
    matched = cdf.where(holds).select(*groups, "n", F.explode(F.array_compact(F.array(*hits))).alias("h"))
    per_target = matched.groupBy(*groups, "n", F.col("h.pi").alias("pi"), F.col("h.pos").alias("pos"),
                                 F.col("h.r_lo").alias("r_lo")).agg(
        F.max(F.when(F.col("h.is_lo"), F.col("h.v"))).alias("v_lo"),
        F.max(F.when(F.col("h.is_hi"), F.col("h.v"))).alias("v_hi"))
    q = F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("pos") - F.col("r_lo"))
    return (per_target.groupBy(*groups, "n")
            .agg(F.array_sort(F.collect_list(F.struct("pi", q.alias("q")))).alias("qs"))
            .select(*groups, "n", F.transform("qs", lambda s: s["q"]).alias("q")))


def exact_quantiles(long: DataFrame, groups: Sequence[str], probs: Sequence[float],
                    value: str = "value") -> DataFrame:
    return quantiles_from_cdf(value_cdf(long, groups, value), groups, probs, value)
