"""Every branch of the decision ladder, on literal signal rows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftline.operators.decision import decide
from driftline.operators.signals import SIGNAL_TYPE, window_flags
from driftline.plans.monitor import literal_policy
from driftline.plans.policy import Policy

BASE = Policy(consecutive_windows_to_confirm=2, cooldown_days=7)


def sig(name, level, category, message=None):
    return (name, level, 1.0, 0.5, message or f"{name} {level}", category)


PERF_ALERT = sig("recall_degradation", "ALERT", "performance")
PR_ALERT = sig("pr_auc_degradation", "ALERT", "performance")
DRIFT_ALERT = sig("dataset_drift_breadth", "ALERT", "drift")
WARN = sig("score_distribution_psi", "WARN", "prediction")
OK = sig("score_distribution_psi", "OK", "prediction")
HALT = sig("batch_size", "ALERT", "data_quality", "Batch has 3 rows")


def run(spark, windows, policy=BASE, days=None, state=None):
    start = dt.datetime(2026, 1, 1)
    rows = []
    for i, sigs in enumerate(windows):
        now = start + dt.timedelta(days=(days[i] if days else i))
        rows.append(("m", i + 1, f"w{i + 1}", now, sigs))
    df = spark.createDataFrame(rows, f"model_version string, seq int, batch_id string, now timestamp, "
                                     f"signals array<{SIGNAL_TYPE}>")
    df = df.select("*", *window_flags(F.col("signals")))
    out = decide(df, ["model_version"], literal_policy(policy), state=state)
    return [r for r in out.orderBy("seq").collect()]


def test_clean_window_no_action(spark):
    r = run(spark, [[OK]])[0]
    assert (r.action, r.severity, r.confirmed_streak) == ("NO_ACTION", "OK", 0)


def test_warn_only_watches_without_streak(spark):
    r = run(spark, [[WARN]])[0]
    assert (r.action, r.severity, r.confirmed_streak) == ("WATCH", "WARN", 0)


def test_single_alert_is_held(spark):
    r = run(spark, [[PERF_ALERT]])[0]
    assert r.action == "WATCH" and r.confirmed_streak == 1
    assert r.reasons[0].startswith("alert in 1 of 2 windows")


def test_two_performance_alerts_retrain(spark):
    r = run(spark, [[PERF_ALERT], [PERF_ALERT]])
    assert [x.action for x in r] == ["WATCH", "RETRAIN"]
    assert r[1].reasons[0] == "confirmed over 2 windows in a row"
    assert r[1].last_retrain_at is not None


def test_clean_window_resets_streak(spark):
    r = run(spark, [[PERF_ALERT], [OK], [PERF_ALERT]])
    assert [x.action for x in r] == ["WATCH", "NO_ACTION", "WATCH"]
    assert [x.confirmed_streak for x in r] == [1, 0, 1]


def test_distribution_only_prefers_recalibration(spark):
    r = run(spark, [[DRIFT_ALERT], [DRIFT_ALERT]])
    assert r[1].action == "RECALIBRATE_THRESHOLD"
    no_pref = run(spark, [[DRIFT_ALERT], [DRIFT_ALERT]], BASE.with_(prefer_recalibration=False))
    assert no_pref[1].action == "RETRAIN"


def test_drift_plus_ranking_collapse_retrains(spark):
    r = run(spark, [[DRIFT_ALERT], [DRIFT_ALERT, PR_ALERT]])
    assert r[1].action == "RETRAIN"


def test_streak_is_shared_across_categories(spark):
    r = run(spark, [[DRIFT_ALERT], [PERF_ALERT]])
    assert r[1].action == "RETRAIN" and r[1].confirmed_streak == 2


def test_cooldown_suppresses_then_expires(spark):
    r = run(spark, [[PERF_ALERT], [PERF_ALERT], [PERF_ALERT], [PERF_ALERT]], days=[0, 1, 3, 10])
    assert [x.action for x in r] == ["WATCH", "RETRAIN", "WATCH", "RETRAIN"]
    assert r[2].cooldown_active and r[2].reasons[0].startswith("no retraining within 7 days")
    assert not r[3].cooldown_active


def test_cooldown_from_initial_state(spark):
    r = run(spark, [[PERF_ALERT]], state={"streak": 1, "last_retrain_at": "2025-12-30T00:00:00"})
    assert r[0].confirmed_streak == 2 and r[0].action == "WATCH" and r[0].cooldown_active


def test_halt_bypasses_confirmation_and_resets(spark):
    r = run(spark, [[PERF_ALERT], [HALT, PERF_ALERT], [PERF_ALERT]])
    assert [x.action for x in r] == ["WATCH", "HALT", "WATCH"]
    assert r[1].severity == "ALERT" and r[1].reasons == ["Batch has 3 rows"]
    assert not r[1].in_history and r[2].confirmed_streak == 1


def test_no_cooldown_with_zero_days_retrains_each_alert(spark):
    r = run(spark, [[PERF_ALERT]] * 3, BASE.with_(cooldown_days=0))
    assert [x.action for x in r] == ["WATCH", "RETRAIN", "RETRAIN"]


def test_a_stamp_that_cannot_be_read_is_no_cooldown(spark):
    r = run(spark, [[PERF_ALERT]], state={"streak": 1, "last_retrain_at": "last tuesday"})
    assert r[0].action == "RETRAIN" and not r[0].cooldown_active


def test_state_by_model_carries_on(spark):
    rows = [(m, "w1", 1, dt.datetime(2026, 1, 5), [PERF_ALERT]) for m in ("a", "b", "c")]
    df = spark.createDataFrame(rows, f"model_version string, batch_id string, seq int, now timestamp, "
                                     f"signals array<{SIGNAL_TYPE}>").select("*", *window_flags(F.col("signals")))
    state = spark.createDataFrame([("a", 1, None), ("b", 1, dt.datetime(2026, 1, 1))],
                                  "model_version string, streak int, last_retrain_at timestamp")
    out = {r.model_version: r for r in decide(df, ["model_version"], literal_policy(BASE), state=state).collect()}
    assert [out[m].action for m in "abc"] == ["RETRAIN", "WATCH", "WATCH"]
    assert [out[m].confirmed_streak for m in "abc"] == [2, 2, 1] and out["b"].cooldown_active
    assert out["b"].last_retrain_at == dt.datetime(2026, 1, 1) and out["a"].last_retrain_at == dt.datetime(2026, 1, 5)


def test_long_history_of_retrains(spark):
    r = run(spark, [[PERF_ALERT]] * 40, BASE.with_(cooldown_days=3))
    done = [i for i, x in enumerate(r) if x.action == "RETRAIN"]
    assert done == list(range(1, 40, 3))
