"""Model plug-in point, scaler, CSV/parquet reader and signal messages."""
import os
import tempfile

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftline.operators import scoring
from driftline.operators.reshape import MissingFeaturesError
from driftline.operators.signals import all_signals
from driftline.plans.monitor import literal_policy
from driftline.plans.policy import Policy
from driftline.sources.tables import batch_schema, load_batch


class LogisticStub:
    """A foreign model object: anything with predict_proba."""

    def __init__(self, w):
        self.w = np.asarray(w, float)

    def predict_proba(self, x):
        p = 1.0 / (1.0 + np.exp(-(np.asarray(x, float) @ self.w)))
        return np.c_[1 - p, p]


def test_foreign_model_scores_via_arrow_batches(spark):
    pdf = pd.DataFrame({"a": np.linspace(-2, 2, 101), "b": np.linspace(1, 0, 101)})
    df = spark.createDataFrame(pdf)
    out = scoring.score(df, LogisticStub([1.0, -0.5]), ["a", "b"]).toPandas().sort_values("a")
    want = LogisticStub([1.0, -0.5]).predict_proba(pdf.sort_values("a")[["a", "b"]])[:, 1]
    assert np.allclose(out["score"].to_numpy(), want)


class CountedLoads(LogisticStub):
    """Leaves a line in a file of the process that unpickles it."""

    def __init__(self, w, folder):
        super().__init__(w)
        self.folder = folder

    def __setstate__(self, state):
        self.__dict__.update(state)
        with open(os.path.join(self.folder, str(os.getpid())), "a") as f:
            f.write("loaded\n")


def test_large_model_as_a_file_is_loaded_once_per_worker(spark, tmp_path):
    pdf = pd.DataFrame({"a": np.linspace(-2, 2, 400), "b": np.linspace(1, 0, 400)})
    df = spark.createDataFrame(pdf).repartition(40)
    scored = lambda model, limit: scoring.score_python_model(
        df, model, ["a", "b"], broadcast_bytes=limit).toPandas().sort_values("a")["score"].to_numpy()
    as_file = scored(CountedLoads([1.0, -0.5], str(tmp_path)), 0)
    assert np.array_equal(as_file, scored(LogisticStub([1.0, -0.5]), 1 << 20))
    loads = [open(tmp_path / x).read().count("loaded") for x in os.listdir(tmp_path)]
    assert loads and set(loads) == {1}
    # the next model takes the place of the one before
    assert np.array_equal(scored(LogisticStub([2.0, 0.5]), 0), scored(LogisticStub([2.0, 0.5]), 1 << 20))


def test_input_columns_named_like_a_models_own_stay(spark):
    rows = [(float(i), i % 2, f"f{i}", i, -1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "x double, label int, features string, prediction long, probability double")
    model = scoring.train_weighted_gbt(df.select("x", "label"), ["x"], "label", max_iter=2)
    out = scoring.score(df, model, ["x"])
    assert out.columns == df.columns + ["score"]
    assert sorted(r[:5] for r in map(tuple, out.collect())) == sorted(rows)
    plain = scoring.score(df.select("x", "label"), model, ["x"])
    assert plain.columns == ["x", "label", "score"]
    assert sorted(r.score for r in plain.collect()) == sorted(r.score for r in out.collect())


def test_missing_model_feature_raises(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0]}))
    with pytest.raises(MissingFeaturesError, match="b"):
        scoring.score(df, LogisticStub([1.0, 1.0]), ["a", "b"])


def test_scaler_is_fit_on_train_only(spark):
    train = spark.createDataFrame(pd.DataFrame({"amount": [1.0, 2.0, 3.0]}))
    batch = spark.createDataFrame(pd.DataFrame({"amount": [100.0]}))
    m, s = scoring.fit_scaler(train, "amount")
    out = scoring.apply_scaler(batch, "amount", m, s).first()[0]
    assert out == pytest.approx((100.0 - 2.0) / np.std([1.0, 2.0, 3.0]))


def test_weighted_gbt_learns(spark):
    rng = np.random.default_rng(0)
    n = 3000
    y = rng.binomial(1, 0.05, size=n)
    pdf = pd.DataFrame({"x1": rng.normal(size=n) + 2.5 * y, "x2": rng.normal(size=n), "label": y})
    df = spark.createDataFrame(pdf)
    model = scoring.train_weighted_gbt(df, ["x1", "x2"], "label", max_iter=5)
    scored = scoring.score(df, model, ["x1", "x2"])
    from driftline.operators import quality
    g = quality.score_groups(scored.select(F.lit("g1").alias("grp"), "score", "label"), ["grp"])
    assert quality.ranking_metrics(g, ["grp"]).first().roc_auc > 0.9


def test_load_batch_by_suffix(spark):
    d = tempfile.mkdtemp(prefix="dl-load-")
    pdf = pd.DataFrame({"V1": [1.5, 2.5], "Class": [0, 1]})
    pdf.to_csv(os.path.join(d, "b.csv"), index=False)
    pdf.to_parquet(os.path.join(d, "b.parquet"))
    a = load_batch(spark, os.path.join(d, "b.csv")).orderBy("V1").collect()
    b = load_batch(spark, os.path.join(d, "b.parquet")).orderBy("V1").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b] == [(1.5, 0), (2.5, 1)]
    schema = batch_schema(["V1"], time=None)
    typed = load_batch(spark, os.path.join(d, "b.csv"), schema)
    assert typed.schema == schema and [tuple(r) for r in typed.orderBy("V1").collect()] == [(1.5, 0), (2.5, 1)]


def test_signal_messages(spark):
    row = spark.createDataFrame([{
        "n_rows": 300, "n_features_missing": 1, "missing_features": ["V5"], "drifted_fraction": 8 / 29,
        "n_features_alert": 8, "n_features_tested": 29, "top_drifted": ["V3", "V1", "V2", "V7"],
        "max_psi": 1.2913, "score_psi": float("nan"), "mean_score": 0.0012, "reference_mean_score": 0.0011,
        "flag_rate_relative_change": 0.25, "flag_rate": 0.0025, "reference_flag_rate": 0.002,
        "perf_status": "OK", "perf_reason": "", "pr_auc_relative_drop": 0.0341, "pr_auc": 0.93,
        "base_pr_auc": 0.9629, "recall_absolute_drop": -0.02, "recall": 0.97, "base_recall": 0.95,
        "missed_fraud_count": 1, "precision_absolute_drop": 0.2, "precision": 0.7, "base_precision": 0.9,
        "false_positives": 12}])
    sigs = row.select(all_signals(literal_policy(Policy(min_batch_rows=1000)))).first()[0]
    msg = {s.name: s.message for s in sigs}
    assert [s.name for s in sigs] == ["batch_size", "missing_features", "dataset_drift_breadth",
                                      "max_feature_psi", "score_distribution_psi", "flag_rate_shift",
                                      "pr_auc_degradation", "recall_degradation", "precision_collapse"]
    assert msg["batch_size"] == "only 300 rows, 1000 are needed for drift figures"
    assert msg["missing_features"] == "not in the batch: V5"
    assert msg["dataset_drift_breadth"] == "8 of 29 features in the PSI alert range (27.6%); most moved: V3, V1, V2"
    assert msg["max_feature_psi"] == "V3 moved most, PSI 1.291"
    assert msg["score_distribution_psi"] == "score PSI n/a, mean score 0.0012, reference mean 0.0011"
    assert msg["flag_rate_shift"] == "0.2500% of rows flagged, reference 0.2000%, change +25%"
    assert msg["pr_auc_degradation"] == "average precision 0.9300, baseline 0.9629, drop +3.4%"
    assert msg["recall_degradation"] == "recall 0.9700, baseline 0.9500, drop -0.020, 1 positives missed"
    levels = {s.name: s.level for s in sigs}
    assert levels["score_distribution_psi"] == "OK" and levels["dataset_drift_breadth"] == "ALERT"
