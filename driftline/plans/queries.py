"""Registered queries: one per operator of the inventory, each a function
(spark, sf_dir) -> DataFrame over the driver tables. Outputs use plain column
types (bigint, double rounded to 6 places, string, boolean) so they can be
compared with the SQL oracle."""
from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.columns import SCORE_BAND_INNER_EDGES, flagged, is_finite, nan_to_null
from driftline.operators import gate, quality, recalibrate, sampling, scoring
from driftline.operators.drift import (bin_stats, drift_summary, feature_drift, ks_statistics,
                                       prediction_drift, value_counts)
from driftline.operators.profile import build_profile, psi_two_tables
from driftline.operators.reshape import (finite_filter, labeled_filter, project_features,
                                         unpivot_features)
from driftline.plans.fixture import MODEL_VERSION, txn_fixture
from driftline.plans.monitor import (backtest, literal_policy, month_start, monitor, nested_report,
                                     performance_block, score_and_monitor, window_report)
from driftline.plans import monitor as monitor_plan
from driftline.plans.policy import FIXTURE_POLICY, Policy, for_env, policy_table
from driftline.plans.views import (EVENTS_REFERENCE_END, TXN_FEATURES, TXN_THRESHOLD, documents_scored, events_scored, events_stream, txn, txn_windows)
from driftline.session import ensure_checkpoint_dir, freeze
from driftline.sources.sinks import (append_decisions, history_tail, nonfinite_to_null, read_profile, read_runs,
                                    write_profile, write_promotion_record)
from driftline.sources.tables import load_batch, read_table
from driftline.streaming import stream

Q = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Q] = {}

RECALL_TARGET = 0.95
SAMPLE_N = 1000
SEED = 42
DOC_POLICY = Policy(env="documents", min_labeled_rows=50, min_labeled_frauds=10)
EVENTS_NOW = "2024-02-15 00:00:00"


def query(fn: Q) -> Q:
    """Register ``fn``; every query runs with the session zone pinned to UTC
    (the driver tables hold zone-less timestamps) and a checkpoint folder."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_checkpoint_dir(spark)
        return fn(spark, sf)
    REGISTRY[fn.__name__] = run
    return run


def finalize(df: DataFrame) -> DataFrame:
    """int -> bigint, float -> double rounded to 6 places."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        out.append(c.alias(f.name))
    return df.select(*out)


def _fx(spark, sf):
    return txn_fixture(spark, sf)


def _monitor(spark, sf) -> DataFrame:
    fx = _fx(spark, sf)
    return monitor(fx.windows, fx.profile, fx.policy, fx.threshold, now=month_start())


def _report(spark, sf) -> DataFrame:
    fx = _fx(spark, sf)
    return window_report(fx.windows, fx.profile, fx.policy, fx.threshold)


def _drift(spark, sf) -> DataFrame:
    fx = _fx(spark, sf)
    return feature_drift(fx.windows, fx.profile, fx.policy)


# ---------------------------------------------------------------- sources / sinks
@query
def scan_batch(spark, sf):
    df = load_batch(spark, os.path.join(sf, "lineitem.parquet"))
    return finalize(df.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                              F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date")))


@query
def report_nonfinite_to_null(spark, sf):
    rep = _report(spark, sf)
    cols = ["max_psi", "score_psi", "flag_rate", "flag_rate_relative_change", "pr_auc", "roc_auc",
            "precision", "recall", "pr_auc_relative_drop"]
    # missing figures as NaN or infinity, the way a report in floats carries them
    odd = F.when(F.substring("batch_id", 7, 1).cast("int") % 2 == 0, float("nan")).otherwise(float("inf"))
    return finalize(nonfinite_to_null(rep.select("batch_id", *[F.coalesce(c, odd).alias(c) for c in cols])))


@query
def state_history_tail(spark, sf):
    tail = history_tail(_monitor(spark, sf), n=50)
    return finalize(tail.select("batch_id", "action", "severity",
                                F.col("confirmed_streak").alias("streak"), "pos"))


def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), "sinks", f"{name}-{uuid.uuid4().hex[:12]}")


@query
def decision_runs(spark, sf):
    """Decisions written by runs (a year each), one of them repeated and one that ends
    before its entry is written; what is read back."""
    path, made = _scratch(spark, "decisions"), freeze(_monitor(spark, sf), "decisions")
    for year in ("2000", "2001", "2000"):
        append_decisions(made.where(F.substring("batch_id", 1, 4) == year), path, f"run {year}")
    lost = made.withColumns({"run_id": F.lit("run 2001"), "attempt": F.lit("lost")})
    lost.write.parquet(os.path.join(path, "data", "part=lost"))
    return finalize(read_runs(spark, path).select("run_id", "batch_id", "action", "confirmed_streak", "severity"))


@query
def promotion_audit(spark, sf):
    """The audit rows of one gate run that was repeated, read back."""
    path = _scratch(spark, "promotions")
    checks, metrics = freeze(_gate_checks(spark, sf), "gate-checks"), freeze(_gate_metrics(spark, sf), "gate-metrics")
    for _ in range(2):
        write_promotion_record(gate.gate_result(checks, ["challenger"]), checks, metrics, path, MODEL_VERSION,
                               "challenger-1", run_id="gate 1")
    back = read_runs(spark, path, "json")
    return finalize(back.select("run_id", "challenger", "champion_version", "challenger_version", "promote",
                                F.size("checks").alias("n_checks"), F.size("metrics").alias("n_metrics"), "summary"))


@query
def profile_round_trip(spark, sf):
    """The profile written twice and read back."""
    fx, path = _fx(spark, sf), _scratch(spark, "profiles")
    for _ in range(2):
        write_profile(fx.profile, path)
    back = read_profile(spark, path, MODEL_VERSION)
    values = back.ks.where("level = depth").groupBy("feature").agg(F.sum(F.size("lows")).alias("n_values"))
    return finalize(back.features.join(values, "feature").select("feature", "mean", "p50", "n", "n_bins", "n_values"))


@query
def sample_rows(spark, sf):
    return finalize(sampling.sample_rows(txn(spark, sf), SAMPLE_N, SEED, "row_id")
                    .select("row_id", "score", "label"))


# ---------------------------------------------------------------- projections
@query
def project_features_q(spark, sf):
    fx = _fx(spark, sf)
    return finalize(project_features(fx.windows, TXN_FEATURES, keep=["row_id", "batch_id"]))


@query
def unpivot_features_q(spark, sf):
    return finalize(unpivot_features(txn(spark, sf), ["row_id", "batch_id"], TXN_FEATURES))


@query
def finite_filter_q(spark, sf):
    ev = events_scored(spark, sf)
    i = F.col("row_id").cast("long")
    ev = ev.withColumn("value", F.when(i % 7 == 0, float("nan")).when(i % 11 == 0, float("inf"))
                       .when(i % 13 == 0, float("-inf")).when(i % 17 == 0, None).otherwise(F.col("value")))
    return finalize(finite_filter(unpivot_features(ev, ["row_id", "batch_id"], ["value", "score"])))


@query
def labeled_filter_q(spark, sf):
    docs = documents_scored(spark, sf)
    docs = docs.withColumn("label", F.when(F.col("n_chars") % 5 == 0, float("nan")).otherwise(F.col("label")))
    return finalize(labeled_filter(docs).select("row_id", "score", F.col("label").cast("int").alias("label")))


@query
def scale_amount(spark, sf):
    fx = _fx(spark, sf)
    mean, std = scoring.fit_scaler(fx.reference, "l_extendedprice")
    scaled = scoring.apply_scaler(fx.windows, "l_extendedprice", mean, std, "amount_scaled")
    return finalize(scaled.select("row_id", "amount_scaled"))


def linear_model():
    """The fixture's model as a foreign object."""
    class Linear:
        def predict(self, x):
            return x["l_quantity"] / 50 * 0.5 + x["l_discount"] / 0.10 * 0.3 + x["l_tax"] / 0.08 * 0.2
    return Linear()


@query
def score_batch(spark, sf):
    rows = txn(spark, sf, distort=False).select("row_id", *TXN_FEATURES)
    scored = scoring.score(rows, linear_model(), TXN_FEATURES)
    return finalize(scored.select("row_id", F.round("score", 4).alias("score")))


@query
def flag_scores(spark, sf):
    t = txn(spark, sf)
    return finalize(t.select("row_id", "score", flagged("score", TXN_THRESHOLD).alias("flagged")))


# ---------------------------------------------------------------- drift
@query
def quantile_edges(spark, sf):
    fx = _fx(spark, sf)
    return finalize(fx.profile.features.select(
        "feature", F.posexplode("inner_edges").alias("edge_index", "edge")))


@query
def bin_proportions(spark, sf):
    fx = _fx(spark, sf)
    st = bin_stats(fx.windows, TXN_FEATURES, fx.profile.features, fx.profile.bins).join(
        F.broadcast(fx.profile.features.select("feature", "n_bins")), "feature")
    out = st.select("batch_id", "feature", F.posexplode(F.slice("actual", 1, F.col("n_bins")))
                    .alias("bin", "share"))
    return finalize(out)


@query
def psi_features(spark, sf):
    return finalize(_drift(spark, sf).select("batch_id", "feature", "psi"))


@query
def psi_levels(spark, sf):
    return finalize(_drift(spark, sf).select("batch_id", "feature", "psi", "psi_level"))


@query
def psi_two_tables_q(spark, sf):
    orders = read_table(spark, sf, "orders")
    ref = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp"))
    cur = orders.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp"))
    return finalize(psi_two_tables(ref, cur, "o_totalprice").select("psi"))


@query
def ks_statistic(spark, sf):
    fx = _fx(spark, sf)
    counts = value_counts(fx.windows, TXN_FEATURES)
    return finalize(ks_statistics(counts, fx.profile.features, fx.profile.ks).select(
        "batch_id", "feature", "ks_statistic"))


@query
def ks_pvalue(spark, sf):
    return finalize(_drift(spark, sf).select("batch_id", "feature", "ks_statistic", "ks_pvalue",
                                             "ks_significant"))


@query
def mean_shift(spark, sf):
    return finalize(_drift(spark, sf).select("batch_id", "feature", "reference_mean", "current_mean",
                                             "mean_shift_in_ref_sds"))


@query
def missing_feature_rows(spark, sf):
    fx = _fx(spark, sf)
    d = feature_drift(fx.windows.drop("l_tax"), fx.profile, fx.policy)
    return finalize(d.select("batch_id", "feature", "psi", "psi_level", "ks_significant",
                             "reference_mean", "missing_from_batch"))


@query
def drift_summary_q(spark, sf):
    s = drift_summary(_drift(spark, sf))
    return finalize(s.select("batch_id", "n_features_tested", "n_features_alert", "n_features_warn",
                             "drifted_fraction", "max_psi"))


@query
def top_drifted(spark, sf):
    s = drift_summary(_drift(spark, sf))
    return finalize(s.select("batch_id", F.posexplode("top_drifted").alias("rank", "feature")))


@query
def score_bands(spark, sf):
    fx = _fx(spark, sf)
    edges = [float("-inf"), *SCORE_BAND_INNER_EDGES, float("inf")]
    m = fx.profile.model.select(F.posexplode("band_proportions").alias("band", "expected"))
    lo = F.array(*[F.lit(e) for e in edges[:-1]])
    hi = F.array(*[F.lit(e) for e in edges[1:]])
    return finalize(m.select("band", nan_to_null(F.get(lo, F.col("band"))).alias("lo"),
                             nan_to_null(F.get(hi, F.col("band"))).alias("hi"), "expected"))


@query
def prediction_drift_q(spark, sf):
    fx = _fx(spark, sf)
    p = prediction_drift(fx.windows, fx.profile, fx.threshold)
    return finalize(p.select("batch_id", "n_rows", "score_psi", "mean_score", "flag_rate",
                             "reference_flag_rate", "flag_rate_relative_change"))


# ---------------------------------------------------------------- profile
@query
def profile_stats(spark, sf):
    fx = _fx(spark, sf)
    return finalize(fx.profile.features.select("feature", "mean", "std", "p01", "p50", "p99", "n",
                                               "n_bins"))


@query
def profile_ks_sample(spark, sf):
    fx = _fx(spark, sf)
    long = finite_filter(unpivot_features(fx.reference, ["row_id"], TXN_FEATURES))
    return finalize(sampling.hash_sample(long, ["feature"], 5000, SEED).select("feature", "row_id", "value"))


@query
def build_reference(spark, sf):
    """The profile of a time-ordered reference: features from the early slice, scores
    and baseline quality from the late one."""
    fx = _fx(spark, sf)
    ref = fx.reference.withColumn("Time", F.unix_timestamp("event_time"))
    prof = monitor_plan.build_reference(ref, TXN_FEATURES, TXN_THRESHOLD, MODEL_VERSION, "Time")
    model = F.broadcast(prof.model.select("model_version", "n_scores", "mean_score", "flag_rate", "base_pr_auc",
                                          "base_recall", "base_precision"))
    return finalize(prof.features.join(model, "model_version").select(
        "feature", "n", "mean", "p50", "n_scores", "mean_score", "flag_rate", "base_pr_auc", "base_recall",
        "base_precision"))


@query
def profile_model(spark, sf):
    fx = _fx(spark, sf)
    return finalize(fx.profile.model.select(
        "n_reference_rows", "reference_fraud_rate", "operating_threshold", "mean_score", "flag_rate",
        "n_scores", "base_pr_auc", "base_recall", "base_precision", "base_f1"))


@query
def time_split(spark, sf):
    fx = _fx(spark, sf)
    ref = fx.reference.select("row_id", F.unix_timestamp("event_time").alias("Time"))
    s = gate.time_split(ref, "Time", "row_id", 0.8)
    return finalize(s.groupBy("split", F.from_unixtime("Time", "yyyy-MM-dd").alias("day"))
                    .agg(F.count(F.lit(1)).alias("n_rows")))


# ---------------------------------------------------------------- quality
def _perf(spark, sf):
    fx = _fx(spark, sf)
    return quality.performance(fx.windows, ["batch_id"], fx.threshold)


def _at_threshold(spark, sf):
    fx = _fx(spark, sf)
    return quality.threshold_metrics(fx.windows, ["batch_id"], fx.threshold)


@query
def confusion_matrix(spark, sf):
    return finalize(_at_threshold(spark, sf).select("batch_id", "true_negatives", "false_positives",
                                            "false_negatives", "true_positives"))


@query
def threshold_metrics(spark, sf):
    return finalize(_at_threshold(spark, sf).select(
        "batch_id", "n_rows", "n_frauds", "fraud_rate", "precision", "recall", "f1", "alert_volume",
        "false_discovery_rate", "missed_fraud_count"))


@query
def pr_auc(spark, sf):
    return finalize(_perf(spark, sf).select("batch_id", "pr_auc"))


@query
def roc_auc(spark, sf):
    return finalize(_perf(spark, sf).select("batch_id", "roc_auc"))


@query
def baseline_comparison(spark, sf):
    return finalize(_report(spark, sf).select("batch_id", "perf_status", "pr_auc_relative_drop",
                                              "recall_absolute_drop", "precision_absolute_drop"))


@query
def performance_status(spark, sf):
    docs = documents_scored(spark, sf).withColumnRenamed("lang", "batch_id")
    perf = performance_block(docs, _doc_profile(spark, sf), literal_policy(DOC_POLICY), 0.5)
    return finalize(perf.select("batch_id", "perf_status", "n_labeled", "n_frauds", "pr_auc"))


def _doc_profile(spark, sf):
    docs = documents_scored(spark, sf)
    return build_profile(docs, ["n_chars"], 0.5, "doc-model")


@query
def label_maturity(spark, sf):
    ev = events_scored(spark, sf)
    m = quality.label_maturity(ev, ["batch_id"], "event_time", F.lit(EVENTS_NOW), Policy().label_delay_days)
    return finalize(m.select("batch_id", "mature"))


# ---------------------------------------------------------------- signals / ladder
def _signals_long(spark, sf, categories=None):
    m = _monitor(spark, sf)
    s = m.select("batch_id", F.posexplode("signals").alias("signal_order", "s")).select(
        "batch_id", "signal_order", "s.name", "s.level", "s.value", "s.threshold", "s.category")
    if categories:
        s = s.where(F.col("category").isin(*categories))
    return finalize(s)


@query
def signals_quality(spark, sf):
    return _signals_long(spark, sf, ["data_quality"]).drop("signal_order")


@query
def signals_drift(spark, sf):
    return _signals_long(spark, sf, ["drift"]).drop("signal_order")


@query
def signals_prediction(spark, sf):
    return _signals_long(spark, sf, ["prediction"]).drop("signal_order")


@query
def signals_performance(spark, sf):
    return _signals_long(spark, sf, ["performance"]).drop("signal_order")


@query
def signals_all(spark, sf):
    return _signals_long(spark, sf)


@query
def signals_missing_feature(spark, sf):
    """A feature of the profile that the batch does not have."""
    fx = _fx(spark, sf)
    m = monitor(fx.windows.drop("l_tax"), fx.profile, fx.policy, fx.threshold, now=month_start())
    s = m.select("batch_id", "halt", F.explode("signals").alias("s")).where("s.name = 'missing_features'")
    return finalize(s.select("batch_id", "halt", "s.name", "s.level", "s.value", "s.threshold", "s.category"))


@query
def severity(spark, sf):
    return finalize(_monitor(spark, sf).select("batch_id", "severity"))


@query
def window_flags(spark, sf):
    return finalize(_monitor(spark, sf).select("batch_id", "halt", "triggering", "perf_alert",
                                               "drift_alert", "any_warn"))


@query
def alert_streak(spark, sf):
    return finalize(_monitor(spark, sf).select("batch_id", "streak"))


@query
def decision_timeline(spark, sf):
    return finalize(_monitor(spark, sf).select("batch_id", "action", "confirmed_streak",
                                               "cooldown_active", "severity"))


@query
def decision_reasons(spark, sf):
    m = _monitor(spark, sf)
    lead = F.when(~F.col("halt") & F.col("triggering"), F.get("reasons", 0))
    return finalize(m.select("batch_id", F.size("reasons").alias("n_reasons"), lead.alias("lead_reason")))


@query
def monitor_batch(spark, sf):
    return finalize(_monitor(spark, sf).select(*MONITOR_COLUMNS))


MONITOR_COLUMNS = ["batch_id", "n_rows", "n_features_alert", "n_ks_significant", "max_psi", "score_psi",
                   "flag_rate", "perf_status", "pr_auc", "recall", "precision", "action", "confirmed_streak",
                   "severity"]


@query
def monitor_scored(spark, sf):
    """L8 from unscored windows: the model scores them inside the pass."""
    fx = _fx(spark, sf)
    batch = fx.windows.select("row_id", "batch_id", "event_time", "label", *TXN_FEATURES)
    m = score_and_monitor(batch, linear_model(), TXN_FEATURES, fx.profile, fx.policy, fx.threshold,
                          now=month_start())
    return finalize(m.select(*MONITOR_COLUMNS))


@query
def monitor_report(spark, sf):
    """The nested report of every window, its parts read back."""
    fx = _fx(spark, sf)
    drift_rows = feature_drift(fx.windows, fx.profile, fx.policy)
    made = monitor(fx.windows, fx.profile, fx.policy, fx.threshold, now=month_start(), drift_rows=drift_rows)
    rep = nested_report(made, drift_rows)
    told = F.array_join(F.transform("features", lambda f: F.concat_ws(
        ":", f["feature"], f["psi_level"], f["ks_significant"].cast("string"))), ",")
    return finalize(rep.select("batch_id", "n_rows", told.alias("features"), "drift.max_psi", "prediction.score_psi",
                               "performance.perf_status", "performance.recall", "decision.action"))


@query
def policy_backtest(spark, sf):
    fx = _fx(spark, sf)
    pols = [FIXTURE_POLICY, for_env("dev"), for_env("staging"), for_env("prod")]
    b = backtest(fx.windows, fx.profile, pols, fx.threshold, now=month_start())
    return finalize(b.select("env", "batch_id", "action", "confirmed_streak", "severity"))


@query
def policy_table_q(spark, sf):
    """L10 policy rows per environment, each applied to the fixture windows:
    how many windows it sees and how many it would HALT for size."""
    fx = _fx(spark, sf)
    sizes = fx.windows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    pol = policy_table(spark)
    per_env = F.explode(F.array(*[F.struct(F.lit(e).alias("env"), F.lit(getattr(for_env(e), "min_batch_rows"))
                                           .cast("bigint").alias("mbr")) for e in ("dev", "staging", "prod")]))
    counts = (sizes.select("n", per_env.alias("p"))
              .groupBy(F.col("p.env").alias("env"))
              .agg(F.count(F.lit(1)).alias("n_windows"),
                   F.sum((F.col("n") < F.col("p.mbr")).cast("long")).alias("n_small_windows")))
    return finalize(pol.join(counts, "env"))


# ---------------------------------------------------------------- recalibration / gate
def _sweep(spark, sf):
    fx = _fx(spark, sf)
    rows = fx.windows.select(F.lit("all").alias("grp"), "score", "label")
    return recalibrate.threshold_sweep(rows, ["grp"])


@query
def threshold_sweep(spark, sf):
    return finalize(_sweep(spark, sf).drop("grp"))


@query
def recalibrate_f1(spark, sf):
    best = recalibrate.pick_max_f1(_sweep(spark, sf), ["grp"])
    return finalize(recalibrate.proposal(best, TXN_THRESHOLD, recalibrate.f1_rule(), MODEL_VERSION))


@query
def recalibrate_recall(spark, sf):
    best = recalibrate.pick_recall_target(_sweep(spark, sf), RECALL_TARGET, ["grp"])
    return finalize(recalibrate.proposal(best, TXN_THRESHOLD, recalibrate.recall_rule(RECALL_TARGET),
                                         MODEL_VERSION))


def _gate_metrics(spark, sf):
    # the gate compares models on the windows; it has no part in the reference profile
    m = gate.gate_metrics(txn_windows(spark, sf), {"champion": ("score", TXN_THRESHOLD), "score2": ("score2", TXN_THRESHOLD),
                                       "score3": ("score3", TXN_THRESHOLD)})
    return gate.pair_challengers(m, ["score2", "score3"])


#: Training minimums that the fixture's smallest tables reach.
GATE_POLICY = Policy(min_training_rows=100, min_training_frauds=1)


def _preflight(spark, sf, policy):
    t = txn(spark, sf).select("row_id", "label", F.unix_timestamp("event_time").alias("Time"))
    w = gate.training_window(t, "Time", policy.holdout_days, policy.rolling_window_days)
    return gate.preflight_checks(w.where(F.col("split") == "train"), policy)


@query
def gate_metrics(spark, sf):
    return finalize(_gate_metrics(spark, sf).select("challenger", "role", "n_rows", "pr_auc", "recall",
                                                    "precision", "alert_volume"))


def _gate_checks(spark, sf):
    both = F.explode(F.array(F.lit("score2"), F.lit("score3"))).alias("challenger")
    extra = _preflight(spark, sf, GATE_POLICY).select(both, "*")
    return gate.gate_checks(_gate_metrics(spark, sf), GATE_POLICY, keys=["challenger"], extra=extra)


@query
def gate_checks(spark, sf):
    return finalize(_gate_checks(spark, sf).select("challenger", "phase", "check_order", "name", "passed",
                                                   "value", "threshold"))


@query
def gate_result(spark, sf):
    return finalize(gate.gate_result(_gate_checks(spark, sf), ["challenger"]).select(
        "challenger", "promote", "n_checks", "failed_checks", "summary"))


@query
def training_window(spark, sf):
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("Time"))
    w = gate.training_window(orders, "Time", Policy().holdout_days, Policy().rolling_window_days)
    return finalize(w.select("o_orderkey", "split"))


@query
def training_preflight(spark, sf):
    checks = _preflight(spark, sf, Policy())
    return finalize(checks.select("check_order", "name", "passed", "value", "threshold"))


@query
def rebalance_positives(spark, sf):
    t = txn(spark, sf).select("row_id", "label")
    parts = [sampling.rebalance_positives(t, f, "label", SEED).select(F.lit(f).alias("factor"), "label")
             for f in (0.5, 2.5)]
    u = parts[0].unionByName(parts[1])
    return finalize(u.groupBy("factor", "label").agg(F.count(F.lit(1)).alias("n_rows")))


# ---------------------------------------------------------------- reports / streams / wide
@query
def drift_report_rows(spark, sf):
    d = _drift(spark, sf)
    key = F.coalesce(nan_to_null("psi"), F.lit(0.0))
    w = Window.partitionBy("batch_id").orderBy(key.desc(), F.col("feature_index"))
    return finalize(d.select("batch_id", F.row_number().over(w).alias("row_order"), "feature", "psi",
                             "psi_level", "ks_statistic", "ks_pvalue", "mean_shift_in_ref_sds"))


@query
def report_headline(spark, sf):
    m = _monitor(spark, sf)
    return finalize(m.select("batch_id", "model_version", "n_rows", "action", "severity",
                             "n_features_alert", "n_features_tested", "max_psi", "score_psi",
                             "flag_rate", "reference_flag_rate", "pr_auc", "base_pr_auc", "recall",
                             "base_recall", "precision", "base_precision"))


@query
def daily_windows(spark, sf):
    return finalize(stream.daily_windows(events_scored(spark, sf), "event_time", "value", "score", "label", 0.2))


def _events_profile(spark, sf):
    ref = events_scored(spark, sf).where(F.col("event_time") < F.lit(EVENTS_REFERENCE_END).cast("timestamp"))
    return build_profile(ref, ["value", "score"], 0.2, "events-model", label_col=None, baseline=False,
                         materialize=True).frozen("events-profile")


@query
def daily_bin_psi(spark, sf):
    """W2 as a stream over the events: the days that the watermark has closed."""
    days = stream.run_available(stream.daily_bins(events_stream(spark, sf), "event_time", ["value", "score"],
                                                  _events_profile(spark, sf), Policy()), "daily-bins")
    return finalize(days.select("day", "feature", "n_rows", "n_finite", F.posexplode("bin_counts").alias("bin", "n"),
                                "psi", "psi_level"))


@query
def ks_pvalue_small(spark, sf):
    """D6 on windows and a reference of a few thousand rows: the exact form."""
    ev = events_scored(spark, sf).where(F.col("event_time") >= F.lit(EVENTS_REFERENCE_END).cast("timestamp"))
    d = feature_drift(ev, _events_profile(spark, sf), Policy(), ["value"])
    return finalize(d.select("batch_id", "feature", "ks_statistic", "ks_pvalue", "ks_significant"))


@query
def ladder_stream(spark, sf):
    """W4 as a stream over the windows' flags, which come in no order."""
    flags = stream.ladder_inputs(_monitor(spark, sf), FIXTURE_POLICY)
    path = _scratch(spark, "flags")
    flags.repartition(4, F.xxhash64("batch_id")).write.parquet(path)
    source = spark.readStream.schema(flags.schema).parquet(path)
    made = stream.run_available(stream.stateful_ladder(source), "ladder")
    return finalize(made.select("batch_id", "action", "confirmed_streak", "cooldown_active"))


@query
def late_labels_join(spark, sf):
    docs = documents_scored(spark, sf)
    newest = read_table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("row_id"),
                                                    F.col("toxic").alias("label"), F.lit(2).alias("arrived"))
    earlier = newest.select("row_id", (1 - F.col("label")).alias("label"), F.lit(1).alias("arrived"))
    joined = stream.late_labels(docs, newest.unionByName(earlier), "row_id", None, F.lit(EVENTS_NOW),
                                DOC_POLICY.label_delay_days,
                                batch="lang", arrived="arrived")
    perf = quality.performance(joined, ["lang"], 0.5)
    totals = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n_scored"))
    return finalize(totals.join(perf, "lang", "left").select(
        "lang", "n_scored", F.col("n_rows").alias("n_labeled"), "n_frauds", "pr_auc", "roc_auc"))


def _arriving_labels(ev):
    """Labels of the events: a seventh never come, the others after 0 to 4 days, and a third of
    all a second time an hour later, turned round."""
    i = F.col("row_id").cast("long")
    at = F.col("event_time") + F.make_dt_interval(days=(i % 5).cast("int"))
    first = F.struct(F.col("label").alias("label"), at.alias("arrived"))
    again = F.struct((1 - F.col("label")).alias("label"), (at + F.expr("INTERVAL 1 HOUR")).alias("arrived"))
    made = F.explode(F.when(i % 3 == 0, F.array(first, again)).otherwise(F.array(first))).alias("l")
    return ev.where(i % 7 != 0).select("row_id", made).select("row_id", "l.label", "l.arrived")


@query
def late_labels_stream(spark, sf):
    """W3 as a stream-stream join: labels within two days of their event, on days that are
    closed by both watermarks for certain."""
    made = stream.late_labels_stream(events_stream(spark, sf), _arriving_labels(events_stream(spark, sf)), "row_id",
                                     "event_time", "arrived", "2 days")
    rows = stream.newest_labels(stream.run_available(made, "late-labels"), "row_id")
    last = events_scored(spark, sf).agg(F.date_format(F.max("event_time") - F.expr("INTERVAL 4 DAYS"), "yyyy-MM-dd")
                                        .alias("d")).scalar()
    return finalize(rows.where(F.col("batch_id") < last).groupBy(F.col("batch_id").alias("day")).agg(
        F.count(F.lit(1)).alias("n_scored"), F.count("label").alias("n_labeled"), F.sum("label").alias("n_errors")))


@query
def late_labels_days(spark, sf):
    """W3 with a time column: only days whose newest event is old enough are graded."""
    ev = events_scored(spark, sf)
    joined = stream.late_labels(ev, _arriving_labels(ev), "row_id", "event_time", F.lit(EVENTS_NOW),
                                Policy().label_delay_days, arrived="arrived")
    return finalize(joined.groupBy(F.col("batch_id").alias("day")).agg(
        F.count(F.lit(1)).alias("n_scored"), F.count("label").alias("n_labeled"), F.sum("label").alias("n_errors")))


def _wide(spark, sf):
    """64 embedding dimensions as features (element access, no reshaping
    shuffle); even vec_id rows are the reference, odd rows the batch."""
    feats = [f"d{i:02d}" for i in range(64)]
    emb = read_table(spark, sf, "embeddings")
    base = emb.select(
        F.col("vec_id").cast("string").alias("row_id"),
        F.when(F.col("vec_id") % 2 == 0, "reference").otherwise("current").alias("batch_id"),
        *[F.get("embedding", i).cast("double").alias(f) for i, f in enumerate(feats)])
    ref = base.where(F.col("batch_id") == "reference")
    cur = base.where(F.col("batch_id") == "current")
    prof = build_profile(ref, feats, 0.5, "embed-model", label_col=None, baseline=False,
                         materialize=True).frozen("embed-profile")
    return feature_drift(cur, prof, Policy(env="wide")), prof


@query
def wide_feature_drift(spark, sf):
    d, _ = _wide(spark, sf)
    return finalize(d.select("batch_id", "feature", "psi", "psi_level", "ks_statistic", "ks_significant",
                             "ks_alpha_corrected"))


@query
def wide_top_drifted(spark, sf):
    d, _ = _wide(spark, sf)
    s = drift_summary(d)
    return finalize(s.select("batch_id", F.posexplode("top_drifted").alias("rank", "feature")))


def registry() -> dict[str, Q]:
    names = {}
    for k, v in REGISTRY.items():
        names[k[:-2] if k.endswith("_q") else k] = v
    return names
