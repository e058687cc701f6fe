"""One monitoring pass over many windows (L8) and the replay of windows under
several policies (L9): score -> feature drift -> score drift -> quality ->
signals -> decision, keyed by ``batch_id``. Only summary rows (one per
window, or per window and feature) reach the signal and decision steps."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.columns import classify_level, nan_to_null
from driftline.operators import quality
from driftline.operators.decision import decide
from driftline.operators.drift import drift_summary, feature_drift, prediction_drift
from driftline.operators.gate import time_split
from driftline.operators.profile import Profile, build_profile
from driftline.operators.reshape import monitored_features
from driftline.operators.scoring import score
from driftline.operators.signals import all_signals, window_flags
from driftline.plans.policy import Policy, policy_struct


def literal_policy(policy: Policy):
    def p(name: str) -> Column:
        v = getattr(policy, name)
        return F.lit(v) if v is not None else F.lit(None).cast("double")
    return p


def struct_policy(col: str = "policy"):
    def p(name: str) -> Column:
        return F.col(col)[f"p_{name}"]
    return p


def month_start(batch_col: str = "batch_id") -> Column:
    """``now`` of a monthly window: its first day (UTC)."""
    return F.to_timestamp(F.concat(F.col(batch_col), F.lit("-01")))


def grade(measured: DataFrame, profile: Profile, p, has_label: bool = True,
          label_name: str = "label") -> DataFrame:
    """M5-M7 on rows that hold the window's measures (``n_labeled`` and the columns of
    quality.performance, NULL where a window has no labelled row). With too few
    labelled rows only their count is reported; with too few positives the metrics
    are, but they are not compared. Baseline precedence M6: policy over profile."""
    mv = profile.model_values()          # the profile's one model row enters as literals
    n_lab = F.coalesce(F.col("n_labeled"), F.lit(0))
    n_fr = F.coalesce(F.col("n_frauds"), F.lit(0))
    need = p("min_labeled_rows"), p("min_labeled_frauds")
    base = {k: F.coalesce(p(k).cast("double"), F.lit(mv.get(k)).cast("double"))
            for k in ("base_pr_auc", "base_recall", "base_precision")}
    enough = n_lab >= need[0]
    metrics = ["n_frauds", *METRICS]
    j = measured.select(
        *[c for c in measured.columns if c not in (*metrics, "n_labeled")],
        quality.status(n_lab, n_fr, *need, has_label).alias("perf_status"),
        quality.status_reason(n_lab, n_fr, *need, label_name, has_label).alias("perf_reason"),
        n_lab.alias("n_labeled"), *[F.when(enough, F.col(c)).alias(c) for c in metrics],
        *[c.alias(k) for k, c in base.items()])
    drops = quality.baseline_comparison("pr_auc", "recall", "precision", F.col("base_pr_auc"),
                                        F.col("base_recall"), F.col("base_precision"))
    ok = F.col("perf_status") == "OK"
    return j.select("*", *[F.when(ok, c).alias(name) for name, c in drops.items()])


METRICS = ["fraud_rate", "precision", "recall", "f1", "pr_auc", "roc_auc", "alert_volume", "true_positives",
           "false_positives", "false_negatives", "true_negatives", "false_discovery_rate", "missed_fraud_count"]


def measure(scored: DataFrame, threshold: float, label: str = "label") -> DataFrame:
    """M1-M4 per window with labelled rows: batch_id, n_labeled, n_frauds and METRICS."""
    if label not in scored.columns:
        kinds = {c: "double" for c in METRICS} | {c: "long" for c in METRICS if c.endswith(("s", "_volume", "_count"))}
        scored = scored.select("batch_id").where(F.lit(False))
        return scored.select("batch_id", F.lit(None).cast("long").alias("n_labeled"),
                             F.lit(None).cast("long").alias("n_frauds"),
                             *[F.lit(None).cast(kinds[c]).alias(c) for c in METRICS])
    perf = quality.performance(scored, ["batch_id"], float(threshold), "score", label)
    return perf.select("batch_id", F.col("n_rows").alias("n_labeled"), "n_frauds", *METRICS)


def performance_block(scored: DataFrame, profile: Profile, p, threshold: float,
                      has_label: bool = True, label_name: str = "label") -> DataFrame:
    """M1-M7 per batch."""
    batches = scored.select("batch_id").distinct()
    return grade(batches.join(measure(scored, threshold, label_name), "batch_id", "left"), profile, p,
                 has_label, label_name)


def window_measures(scored: DataFrame, profile: Profile, policy: Policy, threshold: float,
                    label: str = "label") -> DataFrame:
    """Score drift and quality measures of every window, before any grading."""
    pred = prediction_drift(scored, profile, threshold)
    return pred.join(measure(scored, threshold, label), "batch_id", "left")


def window_report(scored: DataFrame, profile: Profile, policy: Policy, threshold: float,
                  monitored: Sequence[str] | None = None, label: str = "label",
                  model_version: str | None = None, drift_rows: DataFrame | None = None,
                  exclude: Sequence[str] = ("Time",)) -> DataFrame:
    """One row per window: drift roll-up, score drift and quality. Monitored are the
    profile's features (or ``monitored``) but for ``exclude`` (P2)."""
    p = literal_policy(policy)
    names = monitored_features(monitored or profile.feature_names, exclude)
    drift_rows = drift_rows if drift_rows is not None else feature_drift(scored, profile, policy, names)
    measured = window_measures(scored, profile, policy, threshold, label)
    mv = model_version or profile.model_version
    return (grade(measured.join(drift_summary(drift_rows), "batch_id", "left"), profile, p,
                  label in scored.columns, label)
            .select(F.lit(mv).alias("model_version"),
                    F.lit(profile.model_version).alias("reference_model_version"),
                    F.lit(mv != profile.model_version).alias("reference_mismatch"), "*"))


def with_signals(report: DataFrame, p) -> DataFrame:
    sig = all_signals(p)
    df = report.select("*", sig.alias("signals"))
    return df.select("*", *window_flags(F.col("signals")))


def decided(report: DataFrame, keys: Sequence[str], p, now: Column | None,
            state: dict | DataFrame | None = None) -> DataFrame:
    """Signals and decisions of report rows in the order of ``now``. ``seq`` carries on
    from the stored state, if that is a table with ``last_seq``."""
    flagged = with_signals(report, p).select(
        "*", (now if now is not None else F.current_timestamp()).alias("now"))
    seq = F.row_number().over(Window.partitionBy(*keys).orderBy("now", "batch_id")).cast("long")
    if isinstance(state, DataFrame) and "last_seq" in state.columns:
        flagged = flagged.join(state.select(*keys, F.col("last_seq").alias("_seq0")), list(keys), "left")
        flagged = flagged.select("*", (seq + F.coalesce("_seq0", F.lit(0))).alias("seq")).drop("_seq0")
    else:
        flagged = flagged.select("*", seq.alias("seq"))
    return decide(flagged, keys, p, state=state)


def monitor(scored: DataFrame, profile: Profile, policy: Policy, threshold: float,
            now: Column | None = None, monitored: Sequence[str] | None = None,
            label: str = "label", model_version: str | None = None,
            state: dict | DataFrame | None = None, drift_rows: DataFrame | None = None) -> DataFrame:
    """L8 over every window in ``scored``: the window report, its signals and
    the decision, one row per window. ``state`` is what earlier runs left
    (sources.sinks.read_state)."""
    report = window_report(scored, profile, policy, threshold, monitored, label, model_version, drift_rows)
    return decided(report, ["model_version"], literal_policy(policy), now, state)


def score_and_monitor(batch: DataFrame, model, features: Sequence[str], profile: Profile, policy: Policy,
                      threshold: float, **kw) -> DataFrame:
    """L8 from unscored rows: the model scores them, then monitor()."""
    return monitor(score(batch, model, features), profile, policy, threshold, **kw)


def nested_report(decisions: DataFrame, drift_rows: DataFrame) -> DataFrame:
    """One row per window as it is reported: batch, feature rows (with KS, in order of
    PSI), prediction, performance and decision as nested values."""
    key = F.coalesce(nan_to_null("psi"), F.lit(0.0))
    cols = ["feature", "psi", "psi_level", "ks_statistic", "ks_pvalue", "ks_significant", "reference_mean",
            "current_mean", "mean_shift_in_ref_sds", "missing_from_batch"]
    rows = drift_rows.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct(
        (-key).alias("_k"), F.col("feature_index").alias("_i"), *cols))).alias("_rows"))
    rows = rows.select("batch_id", F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in cols]))
                       .alias("features"))
    part = lambda names: F.struct(*names)
    return decisions.join(rows, "batch_id", "left").select(
        "model_version", "reference_model_version", "reference_mismatch", "batch_id", "now", "n_rows", "features",
        part(["n_features_tested", "n_features_alert", "n_features_warn", "drifted_fraction", "max_psi",
              "n_ks_significant", "top_drifted", "missing_features", "ks_alpha_corrected"]).alias("drift"),
        part(["score_psi", "mean_score", "reference_mean_score", "flag_rate", "reference_flag_rate",
              "flag_rate_relative_change", "threshold"]).alias("prediction"),
        part(["perf_status", "perf_reason", "n_labeled", "n_frauds", *METRICS, "base_pr_auc", "base_recall",
              "base_precision", "pr_auc_relative_drop", "recall_absolute_drop", "precision_absolute_drop"])
        .alias("performance"),
        part(["action", "severity", "confirmed_streak", "cooldown_active", "reasons", "signals",
              "last_retrain_at"]).alias("decision"))


def build_reference(df: DataFrame, features: Sequence[str], threshold: float, model_version: str,
                    time_col: str, key: str = "row_id", fraction: float = 0.8, policy: Policy | None = None,
                    score_col: str = "score", label: str = "label", materialize: bool = True) -> Profile:
    """The build-reference job: rows in order of time, features profiled on the earlier
    ``fraction``, scores and baseline quality on the rest."""
    split = time_split(df, time_col, key, fraction)
    return build_profile(split.where("split = 'train'").drop("split"), features, threshold, model_version,
                         (policy or Policy()).psi_bins, split.where("split = 'eval'").drop("split"), score_col,
                         label, materialize=materialize)


def backtest(scored: DataFrame, profile: Profile, policies: Sequence[Policy], threshold: float,
             now: Column | None = None, monitored: Sequence[str] | None = None,
             label: str = "label") -> DataFrame:
    """Replay all windows under several policies in one job. Row-level work (drift
    statistics, scores, quality) is done once; the policies (a short list of
    configuration rows) fan out over the per-window summaries only."""
    drift_rows = feature_drift(scored, profile, policies[0], monitored)
    pol = F.explode(F.array(*[policy_struct(x) for x in policies])).alias("policy")
    p = struct_policy("policy")
    alpha = F.when(p("ks_correction") == "bonferroni", p("ks_alpha") / F.col("n_monitored")).otherwise(p("ks_alpha"))
    fanned = drift_rows.drop("psi_level", "ks_significant", "ks_alpha_corrected").select("*", pol).select(
        "*", F.col("policy.p_env").alias("env"), alpha.alias("ks_alpha_corrected"),
        classify_level("psi", p("psi_warn"), p("psi_alert")).alias("psi_level"))
    fanned = fanned.select("*", F.coalesce(F.col("ks_pvalue") < F.col("ks_alpha_corrected"), F.lit(False))
                           .alias("ks_significant"))
    measured = window_measures(scored, profile, policies[0], threshold, label).select("*", pol) \
        .select("*", F.col("policy.p_env").alias("env"))
    report = grade(measured.join(drift_summary(fanned, keys=["env"]), ["env", "batch_id"], "left"), profile, p,
                   label in scored.columns, label)
    return decided(report.select(F.lit(profile.model_version).alias("model_version"), "*"),
                   ["model_version", "env"], p, now)
