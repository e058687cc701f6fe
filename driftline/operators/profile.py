"""Reference profile (R1-R6, D1, D13, D14): the frozen snapshot every window is
compared to, as three tables:

* ``features``: one row per monitored feature: inner quantile edges, bin counts
  and proportions, mean, population std, p01/p50/p99, n, KS sample size;
* ``ks``: the reference empirical CDF as a search tree, nodes of a bounded size
  (cdftree);
* ``model``: score summary, fixed-band proportions (floored), fraud rate and
  the baseline quality measured on the reference scores.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.columns import (EPSILON, SCORE_BAND_INNER_EDGES, bin_index, flagged,
                                         is_finite, score_band)
from driftline.operators import quality
from driftline.operators.cdftree import TREE_SCHEMA, cdf_tree
from driftline.operators.quantile import bin_probabilities, quantiles_from_cdf, value_cdf
from driftline.operators.reshape import unpivot_features
from driftline.session import freeze

N_SCORE_BANDS = len(SCORE_BAND_INNER_EDGES) + 1
FEATURES_SCHEMA = ("model_version string, feature string, feature_index int, inner_edges array<double>, "
                   "n_bins int, bin_counts array<bigint>, mean double, std double, p01 double, "
                   "p50 double, p99 double, n bigint, proportions array<double>")


@dataclass
class Profile:
    model_version: str
    feature_names: list[str]
    bins: int
    features: DataFrame
    ks: DataFrame
    model: DataFrame

    def model_values(self) -> dict:
        """The model row of this profile (one bounded row: scalars and the
        10 band shares), read once and kept on the object."""
        cached = getattr(self, "_model_values", None)
        if cached is None:
            row = self.model.where(F.col("model_version") == self.model_version).first()
            cached = row.asDict() if row is not None else {}
            object.__setattr__(self, "_model_values", cached)
        return cached

    def least_rows(self) -> int:
        """Finite reference values of the feature that has fewest (read once)."""
        cached = getattr(self, "_least_rows", None)
        if cached is None:
            cached = self.features.agg(F.min("n")).first()[0] or 0
            object.__setattr__(self, "_least_rows", cached)
        return cached

    def frozen(self, tag: str = "profile") -> "Profile":
        """The three tables written once under the checkpoint folder and read
        back, so every job that compares against the profile reads a table
        instead of recomputing it."""
        return Profile(self.model_version, self.feature_names, self.bins, freeze(self.features, f"{tag}-features"),
                       freeze(self.ks, f"{tag}-ks"), freeze(self.model, f"{tag}-model"))


def feature_index(features: Sequence[str]) -> F.Column:
    return (F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")) - 1).cast("int")


def quantile_edges(cdf: DataFrame, groups: Sequence[str], bins: int = 10) -> DataFrame:
    """D1 (+ p01/p50/p99): inner edges of the quantile bins per group.

    Quantiles at i/bins, de-duplicated; fewer than two distinct edges means a
    single bin; the outer edges are open, so only inner edges are kept and
    ``bin = count(inner edges <= x)``."""
    probs = bin_probabilities(bins) + [0.01, 0.50, 0.99]
    q = quantiles_from_cdf(cdf, groups, probs)
    u = F.array_sort(F.array_distinct(F.slice("q", 1, bins + 1)))
    inner = F.when(F.size(u) < 2, F.array().cast("array<double>")).otherwise(
        F.slice(u, 2, F.greatest(F.size(u) - 2, F.lit(0))))
    return q.select(*groups, "n", inner.alias("inner_edges"),
                    F.get("q", bins + 1).alias("p01"), F.get("q", bins + 2).alias("p50"),
                    F.get("q", bins + 3).alias("p99"), F.slice("q", 1, bins + 1).alias("quantiles"))


def counts_array(df: DataFrame, keys: Sequence[str], bin_col: str, weight: str, n_bins) -> DataFrame:
    """Per keys, an array of length n_bins with the weight summed per bin (0 if absent)."""
    per_bin = df.groupBy(*keys, bin_col).agg(F.sum(weight).alias("_c"))
    m = per_bin.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(bin_col, "_c"))).alias("_m"))
    return m, (lambda nb: F.transform(F.sequence(F.lit(0), nb - 1),
                                      lambda k: F.coalesce(F.element_at("_m", k), F.lit(0)).cast("long")))


def build_profile(reference: DataFrame, features: Sequence[str], threshold: float,
                  model_version: str = "unknown", bins: int = 10,
                  scores: DataFrame | None = None, score_col: str = "score",
                  label_col: str | None = "label", baseline: bool = True,
                  materialize: bool = False) -> Profile:
    """Profile of ``reference`` features and of ``scores`` (default: the same
    rows), plus the baseline quality on ``scores`` at ``threshold``.

    With ``materialize`` the distinct values and the reference CDF (the largest
    intermediate, read by the edges, the bin counts and the KS table) are written once
    under the checkpoint folder instead of being recomputed by each of them."""
    features = [f for f in features if f in reference.columns]
    sc = scores if scores is not None else reference
    if score_col in sc.columns:
        model = _model_row(sc, reference, threshold, model_version, score_col, label_col, baseline)
    else:  # a drift-only profile (no model scores)
        model = reference.agg(F.count(F.lit(1)).alias("n_reference_rows")).select(
            F.lit(model_version).alias("model_version"), "n_reference_rows")
    if not features:
        spark = reference.sparkSession
        return Profile(model_version, [], bins, spark.createDataFrame([], FEATURES_SCHEMA),
                       spark.createDataFrame([], TREE_SCHEMA), model)
    long = unpivot_features(reference, [], features)
    cdf = value_cdf(long, ["feature"], tag="profile-values" if materialize else None)
    if materialize:
        cdf = freeze(cdf, "profile-cdf")
    known = {r["feature"] for r in cdf.select("feature").distinct().collect()}   # at most one row per feature
    empty = [f for f in features if f not in known]
    if empty:
        raise ValueError(f"no finite reference value for: {', '.join(empty)}")
    edges = quantile_edges(cdf, ["feature"], bins)

    binned = cdf.join(F.broadcast(edges.select("feature", "inner_edges")), "feature").select(
        "feature", "w", bin_index("value", "inner_edges", bins - 1).alias("bin"))
    m, arr = counts_array(binned, ["feature"], "bin", "w", None)
    moments = long.where(is_finite("value")).groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))

    feats = (edges.join(m, "feature").join(moments, "feature")
             .select("feature", "inner_edges", (F.size("inner_edges") + 1).alias("n_bins"), "_m",
                     "mean", "std", "p01", "p50", "p99", "n"))
    feats = feats.select(
        F.lit(model_version).alias("model_version"), "feature",
        feature_index(features).alias("feature_index"), "inner_edges", "n_bins",
        arr(F.col("n_bins")).alias("bin_counts"), "mean", "std", "p01", "p50", "p99", "n")
    feats = feats.select("*", F.transform("bin_counts", lambda c: c / F.col("n")).alias("proportions"))

    ks_table = cdf_tree(cdf).select(F.lit(model_version).alias("model_version"), "*")
    return Profile(model_version, list(features), bins, feats, ks_table, model)


def _model_row(sc: DataFrame, reference: DataFrame, threshold: float, model_version: str,
               score_col: str, label_col: str | None, baseline: bool) -> DataFrame:
    s = F.col(score_col)
    sc = sc.select("*", score_band(s).alias("_band"))
    band = F.col("_band")
    summary = sc.agg(
        F.count(F.lit(1)).alias("n_scores"), F.avg(s).alias("mean_score"),
        F.avg(flagged(s, threshold).cast("double")).alias("flag_rate"),
        F.sum(is_finite(s).cast("long")).alias("n_finite_scores"),
        *[F.sum(F.when(is_finite(s) & (band == k), 1).otherwise(0)).alias(f"_b{k}")
          for k in range(N_SCORE_BANDS)])
    floor = F.lit(0.5) / F.greatest(F.col("n_scores"), F.lit(1))
    props = F.array(*[F.greatest(F.col(f"_b{k}") / F.col("n_finite_scores"), floor)
                      for k in range(N_SCORE_BANDS)])
    has_label = label_col is not None and label_col in reference.columns
    # one-row inputs enter as scalar subqueries: no join between single rows
    ref_stats = reference.select(F.struct(
        F.count(F.lit(1)).alias("n"),
        (F.avg(F.col(label_col).cast("double")) if has_label else F.lit(None).cast("double")).alias("rate"))
        .alias("r")).scalar()
    cols = [F.lit(model_version).alias("model_version"),
            F.lit(float(threshold)).alias("operating_threshold"),
            "n_scores", "mean_score", "flag_rate", props.alias("band_proportions"),
            ref_stats["n"].alias("n_reference_rows"), ref_stats["rate"].alias("reference_fraud_rate")]
    if baseline and label_col is not None and label_col in sc.columns:
        rows = sc.select(F.lit(model_version).alias("model_version"), score_col, label_col)
        tm = quality.threshold_metrics(rows, ["model_version"], float(threshold), score_col, label_col).select(
            F.struct("recall", "precision", "f1", "n_rows").alias("t")).scalar()
        g = quality.score_groups(rows, ["model_version"], score_col, label_col)
        rk = quality.ranking_metrics(g, ["model_version"]).select("pr_auc").scalar()
        cols += [rk.alias("base_pr_auc"), tm["recall"].alias("base_recall"),
                 tm["precision"].alias("base_precision"), tm["f1"].alias("base_f1"),
                 tm["n_rows"].alias("base_rows")]
    else:
        cols += [F.lit(None).cast("double").alias(c) for c in
                 ("base_pr_auc", "base_recall", "base_precision", "base_f1")]
        cols.append(F.lit(None).cast("long").alias("base_rows"))
    return summary.select(*cols)


def psi_two_tables(reference: DataFrame, current: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """PSI of one column of ``current`` against quantile bins cut from
    ``reference`` (one row). The <= bins - 1 inner edges are read once."""
    ref_long = reference.select(F.col(value).cast("double").alias("value"))
    cur_long = current.select(F.col(value).cast("double").alias("value"))
    q = quantiles_from_cdf(value_cdf(ref_long, []), [], bin_probabilities(bins)).first()
    if q is None:
        raise ValueError(f"no finite reference value for: {value}")
    u = sorted(set(q["q"]))
    inner = [] if len(u) < 2 else u[1:-1]
    edges = F.array(*[F.lit(float(e)) for e in inner]).cast("array<double>")
    n_bins = len(inner) + 1

    def shares(long: DataFrame) -> F.Column:
        b = bin_index("value", edges, bins - 1)
        fin = is_finite("value")
        agg = long.agg(F.sum(fin.cast("long")).alias("_n"),
                       *[F.sum(F.when(fin & (b == k), 1).otherwise(0)).alias(f"_k{k}") for k in range(n_bins)])
        return agg.select(F.when(F.col("_n") > 0, F.array(*[F.col(f"_k{k}") / F.col("_n")
                                                           for k in range(n_bins)])).alias("s")).scalar()

    a, e = shares(cur_long), shares(ref_long)
    terms = []
    for k in range(n_bins):
        ak = F.greatest(F.get(a, k), F.lit(EPSILON))
        ek = F.greatest(F.get(e, k), F.lit(EPSILON))
        terms.append((ak - ek) * F.ln(ak / ek))
    psi = terms[0]
    for t in terms[1:]:
        psi = psi + t
    return current.sparkSession.range(1).select(F.when(a.isNotNull(), psi).alias("psi"),
                                                F.lit(n_bins).alias("n_bins"))


__all__ = ["Profile", "build_profile", "quantile_edges", "psi_two_tables", "EPSILON"]
