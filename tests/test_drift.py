"""Drift maths: PSI, quantile edges, KS, levels, roll-up, score drift."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.operators.drift import drift_summary, feature_drift, prediction_drift
from driftline.operators.profile import build_profile, psi_two_tables
from driftline.plans.policy import Policy
from tests.helpers import inner_edges, ks_distance, shares, stability_index


def _df(spark, cols: dict, batch="b1"):
    import pandas as pd
    pdf = pd.DataFrame(cols)
    pdf["batch_id"] = batch
    pdf["row_id"] = [f"{batch}-{i}" for i in range(len(pdf))]
    return spark.createDataFrame(pdf).cache()


def _psi2(spark, a, b):
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    return psi_two_tables(ref, cur, "x").first()["psi"]


def test_psi_zero_for_identical(spark):
    rng = np.random.default_rng(0)
    s = rng.normal(size=5000)
    assert _psi2(spark, s, s) == pytest.approx(0.0, abs=1e-9)


@pytest.mark.parametrize("spread", [0.5, 1.0, 3.0])
def test_psi_matches_the_definition(spark, spread):
    rng = np.random.default_rng(int(spread * 10))
    ref, cur = rng.gamma(2.0, size=3000), rng.gamma(2.0, scale=spread, size=1200)
    edges = inner_edges(ref)
    want = stability_index(shares(ref, edges), shares(cur, edges))
    assert _psi2(spark, ref, cur) == pytest.approx(want, rel=1e-9, abs=1e-12)


def test_a_reference_without_finite_values_is_an_error(spark):
    with pytest.raises(ValueError, match="x"):
        _psi2(spark, [float("nan"), float("inf")], [1.0])
    df = _df(spark, {"A": [1.0, 2.0], "B": [float("nan")] * 2})
    with pytest.raises(ValueError, match="B"):
        build_profile(df, ["A", "B"], 0.5, "m", label_col=None, baseline=False)


def test_emptied_bin_stays_finite(spark):
    ref = [0.0] * 50 + [1.0] * 50 + list(np.linspace(0, 1, 100))
    got = _psi2(spark, ref, [0.0] * 100)
    assert np.isfinite(got) and got > 0


def test_constant_feature_one_bin_psi_zero(spark):
    got = _psi2(spark, [0.0] * 500, [5.0] * 100)
    assert got == 0.0


def test_open_edges_capture_new_extremes(spark):
    ref = list(range(100))
    got = _psi2(spark, ref, [1e9] * 10)
    assert got > 1.0


def test_levels_and_feature_drift_only_moved_feature(spark):
    rng = np.random.default_rng(2)
    ref = _df(spark, {"A": rng.normal(size=4000), "B": rng.normal(size=4000)}, "ref")
    cur = _df(spark, {"A": rng.normal(size=4000), "B": rng.normal(loc=1.5, size=4000)})
    prof = build_profile(ref, ["A", "B"], 0.5, "m", label_col=None, baseline=False).frozen()
    rows = {r.feature: r for r in feature_drift(cur, prof, Policy()).collect()}
    assert rows["A"].psi_level == "OK" and rows["B"].psi_level == "ALERT"
    assert rows["B"].ks_significant and not rows["A"].ks_significant
    assert rows["A"].ks_alpha_corrected == pytest.approx(0.01 / 2)


def test_ks_statistic_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    ref_v = np.round(rng.normal(size=3000), 1)
    cur_v = np.round(rng.normal(loc=0.2, size=2000), 1)
    ref = _df(spark, {"A": ref_v}, "ref")
    cur = _df(spark, {"A": np.r_[cur_v, [np.nan, np.inf]]})
    prof = build_profile(ref, ["A"], 0.5, "m", label_col=None, baseline=False).frozen()
    r = feature_drift(cur, prof, Policy()).first()
    assert r.ks_statistic == pytest.approx(ks_distance(ref_v, cur_v), abs=1e-12)
    # NaN dropped from the mean, +inf kept (NaN-ignoring mean semantics)
    assert r.current_mean == float("inf")


def test_missing_column_reported_not_raised(spark):
    rng = np.random.default_rng(4)
    ref = _df(spark, {"A": rng.normal(size=500), "B": rng.normal(size=500)}, "ref")
    cur = _df(spark, {"A": rng.normal(size=500)})
    prof = build_profile(ref, ["A", "B"], 0.5, "m", label_col=None, baseline=False).frozen()
    d = feature_drift(cur, prof, Policy())
    rows = {r.feature: r for r in d.collect()}
    assert rows["B"].missing_from_batch and rows["B"].psi_level == "UNKNOWN"
    assert rows["B"].psi is None and not rows["B"].ks_significant
    s = drift_summary(d).first()
    assert s.n_features_missing == 1 and s.missing_features == ["B"]


def test_top_drifted_sorted_by_psi_then_feature_order(spark):
    rng = np.random.default_rng(5)
    cols = {f"f{i}": rng.normal(size=2000) for i in range(7)}
    ref = _df(spark, cols, "ref")
    cur_cols = {f"f{i}": rng.normal(loc=0.3 * i, size=2000) for i in range(7)}
    cur = _df(spark, cur_cols)
    prof = build_profile(ref, list(cols), 0.5, "m", label_col=None, baseline=False).frozen()
    s = drift_summary(feature_drift(cur, prof, Policy(), with_ks=False)).first()
    assert s.top_drifted == ["f6", "f5", "f4", "f3", "f2"]


def test_repartition_invariance(spark):
    rng = np.random.default_rng(6)
    ref = _df(spark, {"A": rng.exponential(size=3000)}, "ref")
    cur = _df(spark, {"A": rng.exponential(scale=1.3, size=3000)})
    prof = build_profile(ref, ["A"], 0.5, "m", label_col=None, baseline=False).frozen()
    base = feature_drift(cur, prof, Policy()).first()
    for n in (1, 7, 50):
        r = feature_drift(cur.repartition(n), prof, Policy()).first()
        assert r.psi == pytest.approx(base.psi, abs=1e-12)
        assert r.ks_statistic == pytest.approx(base.ks_statistic, abs=1e-15)


def test_prediction_drift_flag_rate_and_fixed_bands(spark):
    rng = np.random.default_rng(7)
    ref_s = rng.beta(1, 40, size=5000)
    cur_s = np.r_[rng.beta(1, 40, size=4000), np.full(1000, 0.9), [np.nan]]
    ref = _df(spark, {"score": ref_s, "label": np.zeros(5000, dtype=int)}, "ref")
    cur = _df(spark, {"score": cur_s})
    prof = build_profile(ref, [], 0.05, "m").frozen()
    p = prediction_drift(cur, prof, 0.05).first()
    exp_fr = float(np.sum(cur_s[np.isfinite(cur_s)] >= 0.05) / cur_s.size)  # NaN counts, not flagged
    assert p.flag_rate == pytest.approx(exp_fr)
    assert p.reference_flag_rate == pytest.approx(float(np.mean(ref_s >= 0.05)))
    assert p.score_psi > 0.2
    bands = prof.model.first().band_proportions
    assert len(bands) == 10 and min(bands) >= 0.5 / 5000


def test_ks_of_continuous_values_below_within_and_above_the_reference(spark):
    rng = np.random.default_rng(8)
    ref_v, cur_v = rng.normal(size=4000), np.r_[rng.normal(loc=0.1, size=900), [-50.0, 50.0]]
    ref, cur = _df(spark, {"A": ref_v}, "ref"), _df(spark, {"A": cur_v})
    for prof in (build_profile(ref, ["A"], 0.5, "m", label_col=None, baseline=False),
                 build_profile(ref, ["A"], 0.5, "m", label_col=None, baseline=False).frozen()):
        r = feature_drift(cur, prof, Policy()).first()
        assert r.ks_statistic == pytest.approx(ks_distance(ref_v, cur_v), abs=1e-12)
