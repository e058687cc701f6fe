"""Drift of features and scores against a reference profile (D2-D12, D15-D17,
J1, J2).

Bins, PSI, means and score measures are direct aggregations: rows are binned where
they are read, and map tasks send one row per batch and feature; the KS statistic counts
rows in the children of the reference's CDF tree (cdftree). The profile side is one row
per feature (broadcast)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.columns import (EPSILON, bin_index, classify_level, drop_nan, flagged,
                                         is_finite, ks_pvalue, nan_to_null, psi_sum, score_band)
from driftline.operators import cdftree
from driftline.operators.ksexact import EXACT_ROWS, exact_pvalue
from driftline.operators.profile import N_SCORE_BANDS, Profile
from driftline.operators.reshape import unpivot_features
from driftline.plans.policy import Policy


def value_rows(scored: DataFrame, features: Sequence[str], batch: str = "batch_id") -> DataFrame:
    """(batch_id, feature, value, nb): a row for each value as it is read (KS only)."""
    long = unpivot_features(scored, [batch], features)
    return long.select(F.col(batch).alias("batch_id"), "feature", "value", F.lit(1).cast("long").alias("nb"))


def value_counts(scored: DataFrame, features: Sequence[str], batch: str = "batch_id") -> DataFrame:
    """(batch_id, feature, value, nb): rows per distinct value, non-finite kept (KS only)."""
    return value_rows(scored, features, batch).groupBy("batch_id", "feature", "value").agg(F.sum("nb").alias("nb"))


def binned(long: DataFrame, keys: Sequence[str], prof_feats: DataFrame, bins: int) -> DataFrame:
    """Unpivoted rows (keys, feature, value) with ``_fin`` and ``_bin``; rows find their bin where
    they are read (the edges are broadcast, one row per feature)."""
    pf = F.broadcast(prof_feats.select("feature", "inner_edges"))
    return long.join(pf, "feature").select(
        *keys, "feature", "value", is_finite("value").alias("_fin"),
        bin_index("value", "inner_edges", bins - 1).alias("_bin"))


def bin_sums(bins: int) -> list[F.Column]:
    """Finite rows in each bin: ``_k0``, ``_k1``, ..."""
    fin, b = F.col("_fin"), F.col("_bin")
    return [F.sum(F.when(fin & (b == k), 1).otherwise(0)).alias(f"_k{k}") for k in range(bins)]


def bin_stats(scored: DataFrame, features: Sequence[str], prof_feats: DataFrame, bins: int,
              batch: str = "batch_id") -> DataFrame:
    """Per (batch, feature): finite count, per-bin shares, NaN-dropping mean. A map task
    sends one row per batch and feature."""
    long = unpivot_features(scored, [batch], features).withColumnRenamed(batch, "batch_id")
    agg = binned(long, ["batch_id"], prof_feats, bins).groupBy("batch_id", "feature").agg(
        F.sum(F.col("_fin").cast("long")).alias("n_finite"), F.avg(drop_nan("value")).alias("current_mean"),
        *bin_sums(bins))
    shares = F.when(F.col("n_finite") > 0,
                    F.array(*[F.col(f"_k{k}") / F.col("n_finite") for k in range(bins)]))
    return agg.select("batch_id", "feature", "n_finite", shares.alias("actual"), "current_mean")


def ks_statistics(counts: DataFrame, prof_feats: DataFrame, tree: DataFrame) -> DataFrame:
    """D5 for the features of ``prof_feats``, by descent through the reference's CDF tree."""
    return cdftree.ks_statistics(counts, tree.join(F.broadcast(prof_feats.select("feature")), "feature", "left_semi"))


def feature_drift(scored: DataFrame, profile: Profile, policy: Policy,
                  monitored: Sequence[str] | None = None, batch: str = "batch_id",
                  with_ks: bool = True) -> DataFrame:
    """Per (batch, feature) drift rows: psi, psi_level, ks_statistic, ks_pvalue,
    ks_significant, reference_mean, current_mean, mean_shift_in_ref_sds,
    missing_from_batch (plus feature_index, n_bins, ks_alpha_corrected)."""
    names = [f for f in (monitored or profile.feature_names) if f in profile.feature_names]
    present = [f for f in names if f in scored.columns]
    missing = [f for f in names if f not in scored.columns]
    n_tests = max(len(names), 1)
    alpha = policy.ks_alpha / n_tests if policy.ks_correction == "bonferroni" else policy.ks_alpha
    pf = profile.features.where(F.col("feature").isin(*names))

    rows = None
    if present:
        stats = bin_stats(scored, present, pf, profile.bins, batch)
        if with_ks:
            ks = ks_statistics(value_rows(scored, present, batch), pf, profile.ks)
            stats = stats.join(ks, ["batch_id", "feature"], "left")
        else:
            stats = stats.select("*", *[F.lit(None).cast(t).alias(c) for c, t in
                                        (("ks_statistic", "double"), ("n_ref", "long"), ("n_cur", "long"))])
        j = stats.join(F.broadcast(pf.select("feature", "feature_index", "n_bins", "proportions",
                                             "mean", "std")), "feature")
        psi = psi_sum("actual", "proportions", "n_bins")
        p = ks_pvalue("ks_statistic", "n_ref", "n_cur")
        if with_ks and profile.least_rows() <= EXACT_ROWS:     # one reference size decides for all windows
            # dealt out anew: a window's exact p-value is work, however few rows it is
            j = j.repartition(int(j.sparkSession.conf.get("spark.sql.shuffle.partitions")), "batch_id", "feature")
            p = F.coalesce(exact_pvalue("ks_statistic", "n_ref", "n_cur"), p)
        std = F.when(F.col("std") == 0, F.lit(EPSILON)).otherwise(F.col("std"))
        rows = j.select(
            "batch_id", "feature", "feature_index", "n_bins", psi.alias("psi"),
            F.col("ks_statistic"), p.alias("ks_pvalue"),
            F.col("mean").alias("reference_mean"), "current_mean",
            ((F.col("current_mean") - F.col("mean")) / std).alias("mean_shift_in_ref_sds"),
            F.lit(False).alias("missing_from_batch"))
    if missing:
        batches = scored.select(F.col(batch).alias("batch_id")).distinct()
        miss = (batches.select("batch_id", F.explode(F.array(*[F.lit(m) for m in missing])).alias("feature"))
                .join(F.broadcast(pf.select("feature", "feature_index", "n_bins", "mean")), "feature")
                .select("batch_id", "feature", "feature_index", "n_bins",
                        F.lit(None).cast("double").alias("psi"),
                        F.lit(None).cast("double").alias("ks_statistic"),
                        F.lit(None).cast("double").alias("ks_pvalue"),
                        F.col("mean").alias("reference_mean"),
                        F.lit(None).cast("double").alias("current_mean"),
                        F.lit(None).cast("double").alias("mean_shift_in_ref_sds"),
                        F.lit(True).alias("missing_from_batch")))
        rows = miss if rows is None else rows.unionByName(miss)
    sig = F.coalesce(is_finite("ks_pvalue") & (F.col("ks_pvalue") < F.lit(alpha)), F.lit(False))
    return rows.select(
        "*", classify_level("psi", policy.psi_warn, policy.psi_alert).alias("psi_level"),
        sig.alias("ks_significant"), F.lit(float(alpha)).alias("ks_alpha_corrected"),
        F.lit(len(names)).alias("n_monitored"))


def drift_summary(drift_rows: DataFrame, top_k: int = 5, keys: Sequence[str] = ()) -> DataFrame:
    """D11 + D12 per batch: tested / alert / warn counts, drifted fraction,
    max PSI (non-finite ignored) and the top-k features by PSI (non-finite
    PSI sorts as 0; ties keep feature order)."""
    key = F.when(is_finite("psi"), -F.col("psi")).otherwise(F.lit(0.0))
    w = Window.partitionBy(*keys, "batch_id").orderBy(key.asc(), F.col("feature_index").asc())
    ranked = drift_rows.select("*", F.row_number().over(w).alias("_rank"))
    top = F.transform(
        F.array_sort(F.collect_list(F.when(F.col("_rank") <= top_k, F.struct("_rank", "feature")))),
        lambda s: s["feature"])
    return ranked.groupBy(*keys, "batch_id").agg(
        F.count(F.lit(1)).alias("n_features_tested"),
        F.sum((F.col("psi_level") == "ALERT").cast("int")).alias("n_features_alert"),
        F.sum((F.col("psi_level") == "WARN").cast("int")).alias("n_features_warn"),
        F.sum(F.col("missing_from_batch").cast("int")).alias("n_features_missing"),
        F.sum(F.col("ks_significant").cast("int")).alias("n_ks_significant"),
        F.max(nan_to_null("psi")).alias("max_psi"),
        F.first("n_monitored").alias("n_monitored"),
        F.first("ks_alpha_corrected").alias("ks_alpha_corrected"),
        top.alias("top_drifted"),
        F.array_sort(F.collect_list(F.when(F.col("missing_from_batch"),
                                           F.struct("feature_index", "feature"))))
        .alias("_missing")).select(
        *keys, "batch_id", "n_features_tested", "n_features_alert", "n_features_warn", "n_features_missing",
        "n_ks_significant", (F.col("n_features_alert") / F.greatest(F.col("n_monitored"), F.lit(1))).alias("drifted_fraction"),
        "max_psi", "top_drifted", F.transform("_missing", lambda s: s["feature"]).alias("missing_features"),
        "ks_alpha_corrected")


def prediction_drift(scored: DataFrame, profile: Profile, threshold: float, batch: str = "batch_id",
                     score: str = "score") -> DataFrame:
    """D13-D17 per batch, one direct aggregation: score PSI over the fixed bands, mean
    score (NaN ignored), flag rate (NaN scores count as not flagged), reference flag
    rate and the relative flag-rate change (NULL when the reference rate is 0)."""
    s = F.col(score)
    rows = scored.select(F.col(batch).alias("batch_id"), s.alias("_s"), score_band(s).alias("_band"),
                         is_finite(s).alias("_fin"), flagged(s, threshold).alias("_flg"))
    band, fin = F.col("_band"), F.col("_fin")
    agg = rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(fin.cast("long")).alias("_nf"),
        F.sum(F.col("_flg").cast("long")).alias("_flag"), F.avg(drop_nan("_s")).alias("mean_score"),
        *[F.sum(F.when(fin & (band == k), 1).otherwise(0)).alias(f"_b{k}") for k in range(N_SCORE_BANDS)])
    actual = F.when(F.col("_nf") > 0, F.array(*[F.col(f"_b{k}") / F.col("_nf")
                                                for k in range(N_SCORE_BANDS)]))
    # the profile's one model row enters as literals (no join, no subquery)
    mv = profile.model_values()
    bands = F.array(*[F.lit(float(b)) for b in mv["band_proportions"]]).cast("array<double>")
    j = agg.select("batch_id", "n_rows", actual.alias("actual"),
                   (F.col("_flag") / F.col("n_rows")).alias("flag_rate"),
                   "mean_score", bands.alias("band_proportions"),
                   F.lit(mv["flag_rate"]).cast("double").alias("reference_flag_rate"),
                   F.lit(mv["mean_score"]).cast("double").alias("reference_mean_score"))
    ref = F.col("reference_flag_rate")
    rel = F.when(is_finite(ref) & (ref > 0), F.abs(F.col("flag_rate") - ref) / ref)
    return j.select("batch_id", "n_rows",
                    psi_sum("actual", "band_proportions", F.lit(N_SCORE_BANDS)).alias("score_psi"),
                    "mean_score", "reference_mean_score", "flag_rate", "reference_flag_rate",
                    rel.alias("flag_rate_relative_change"), F.lit(float(threshold)).alias("threshold"))
