"""Sinks: profile round trip, JSON nulls, sweep files, audit records."""
import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from driftline.operators import gate
from driftline.plans.fixture import txn_fixture
from driftline.plans.policy import Policy
from driftline.sources.sinks import (nonfinite_to_null, read_profile, write_json_report, write_profile,
                                     write_promotion_record)
from tests.conftest import SF01


def test_profile_round_trip_and_missing(spark):
    fx = txn_fixture(spark, SF01)
    path = tempfile.mkdtemp(prefix="dl-prof-")
    write_profile(fx.profile, path)
    back = read_profile(spark, path, fx.profile.model_version)
    assert back.feature_names == fx.profile.feature_names
    a = sorted(map(tuple, fx.profile.features.drop("model_version").collect()))
    b = sorted(map(tuple, back.features.select(*fx.profile.features.columns).drop("model_version").collect()))
    assert a == b
    assert back.ks.count() == fx.profile.ks.count()
    with pytest.raises(FileNotFoundError):
        read_profile(spark, path, "no-such-model")


def test_json_report_nulls_nonfinite(spark):
    df = spark.createDataFrame([("b", float("nan"), float("inf"), 1.5, [float("nan"), 2.0])],
                               "batch_id string, a double, b double, c double, arr array<double>")
    r = nonfinite_to_null(df).first()
    assert r.a is None and r.b is None and r.c == 1.5 and r.arr == [None, 2.0]
    path = os.path.join(tempfile.mkdtemp(prefix="dl-json-"), "r")
    write_json_report(df, path)
    line = json.loads(spark.read.text(path).first()[0])
    assert line["a"] is None and "b" in line


def test_promotion_record_written_for_reject(spark):
    df = spark.createDataFrame([("x", 0.9, 1, 0.9), ("x", 0.1, 0, 0.1), ("x", 0.8, 1, 0.8),
                                ("x", 0.3, 0, 0.3)], "g string, s double, label int, c double")
    m = gate.gate_metrics(df, {"champion": ("s", 0.5), "challenger": ("c", 0.5)}, keys=["g"])
    checks = gate.gate_checks(m, Policy(), keys=["g"])
    res = gate.gate_result(checks, ["g"])
    assert not res.first().promote
    path = os.path.join(tempfile.mkdtemp(prefix="dl-audit-"), "promotions")
    write_promotion_record(res, checks, m, path, "v1", "v2", keys=["g"])
    rec = json.loads(spark.read.text(path).first()[0])
    assert rec["promote"] is False and len(rec["checks"]) == 3 and rec["challenger_version"] == "v2"


def test_sweep_and_proposal_files(spark):
    from driftline.operators import recalibrate
    df = spark.createDataFrame([("g", i / 100.0, int(i > 70)) for i in range(100)],
                               "grp string, score double, label int")
    sw = recalibrate.threshold_sweep(df, ["grp"])
    best = recalibrate.pick_max_f1(sw, ["grp"])
    prop = recalibrate.proposal(best, 0.8, recalibrate.f1_rule(), "v1")
    out = tempfile.mkdtemp(prefix="dl-sweep-")
    from driftline.sources.sinks import write_sweep
    write_sweep(sw.drop("grp"), prop, out)
    back = spark.read.option("header", "true").csv(os.path.join(out, "threshold_sweep"))
    assert back.count() == 95 and "f1" in back.columns
    p = spark.read.json(os.path.join(out, "threshold")).first()
    assert p.previous_threshold == 0.8 and 0.7 <= p.threshold <= 0.72


def test_decision_history_tail(spark):
    from driftline.sources.sinks import append_decisions, history_tail
    from driftline.sources.sinks import read_state
    start = dt.datetime(2026, 1, 1)
    # the second run numbers its windows from 1 again: order is by window time
    rows = [("m", (i - 1) % 60 + 1, f"w{i}", start + dt.timedelta(i), "NO_ACTION" if i % 7 else "HALT", i % 7 != 0,
             i % 5, start + dt.timedelta(i // 50 * 50)) for i in range(1, 121)]
    df = spark.createDataFrame(rows, "model_version string, seq int, batch_id string, now timestamp, action string, "
                                     "in_history boolean, confirmed_streak int, last_retrain_at timestamp")
    path = os.path.join(tempfile.mkdtemp(prefix="dl-hist-"), "decisions")
    append_decisions(df, path)
    tail = history_tail(spark.read.parquet(path), n=50).collect()
    assert len(tail) == 50 and all(r.in_history for r in tail)
    assert [r.batch_id for r in sorted(tail, key=lambda r: r.pos)][:3] == ["w120", "w118", "w117"]
    state = read_state(spark.read.parquet(path)).first()
    assert (state.streak, state.last_seq, state.last_retrain_at) == (0, 60, start + dt.timedelta(100))


def test_monitor_carries_on_from_stored_decisions(spark):
    from driftline.plans.monitor import monitor, month_start
    from driftline.sources.sinks import append_decisions, history_tail, read_state
    fx = txn_fixture(spark, SF01)
    whole = monitor(fx.windows, fx.profile, fx.policy, fx.threshold, now=month_start()).collect()
    path = os.path.join(tempfile.mkdtemp(prefix="dl-state-"), "decisions")
    for part, first in ((fx.windows.where("batch_id < '2000-12'"), True), (fx.windows.where("batch_id >= '2000-12'"), False)):
        state = None if first else read_state(spark.read.parquet(path))
        made = monitor(part, fx.profile, fx.policy, fx.threshold, now=month_start(), state=state)
        append_decisions(made.select("model_version", "seq", "batch_id", "now", "action", "in_history",
                                     "confirmed_streak", "last_retrain_at"), path)
    got = {r.batch_id: (r.seq, r.action, r.confirmed_streak) for r in spark.read.parquet(path).collect()}
    assert got == {r.batch_id: (r.seq, r.action, r.confirmed_streak) for r in whole}
    last = history_tail(spark.read.parquet(path), n=2).orderBy("pos").collect()
    assert [r.batch_id for r in last] == sorted((r.batch_id for r in whole if r.in_history), reverse=True)[:2]


def test_frozen_tables_are_dropped(spark, monkeypatch):
    from driftline import session
    monkeypatch.setattr(session, "_FROZEN", {})
    df = session.freeze(spark.range(5), "scratch")
    assert df.count() == 5
    path = session._FROZEN[spark.sparkContext.applicationId][0]
    assert session.drop_frozen(spark) == 1 and session.drop_frozen(spark) == 0
    assert not os.path.exists(path.removeprefix("file:"))


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from driftline.session import ensure_checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: None),
                           sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(fake)


def test_a_repeated_run_leaves_one_history(spark, tmpdir_path):
    import os

    from driftline.sources.sinks import append_decisions, read_runs, write_run
    path = os.path.join(tmpdir_path, "history")
    rows = spark.createDataFrame([("m", i, f"b{i}") for i in range(6)], "model_version string, seq long, batch_id string")
    for run in ("2024/01?", "007", "7", "2024/01?"):
        append_decisions(rows.withColumn("batch_id", F.concat("batch_id", F.lit(run))), path, run)
    got = read_runs(spark, path)
    assert sorted((r.run_id, r["count"]) for r in got.groupBy("run_id").count().collect()) == [
        ("007", 6), ("2024/01?", 6), ("7", 6)]
    assert got.columns == ["model_version", "seq", "batch_id", "run_id"]
    # a run that ends half-way leaves nothing to read, its repetition one history
    broken = rows.repartition(3).withColumn("seq", F.when(F.col("seq") == 4, F.raise_error(F.lit("lost")).cast("long"))
                                            .otherwise(F.col("seq")))
    with pytest.raises(Exception, match="lost"):
        write_run(broken, path, "8")
    assert read_runs(spark, path).where("run_id = '8'").count() == 0
    write_run(rows, path, "8")
    assert read_runs(spark, path).where("run_id = '8'").count() == 6
    # a repetition that fails leaves the rows of the run as they were; one that ends well replaces them
    with pytest.raises(Exception, match="lost"):
        write_run(broken, path, "8")
    assert read_runs(spark, path).where("run_id = '8'").count() == 6
    write_run(rows.limit(2), path, "8")
    assert read_runs(spark, path).where("run_id = '8'").count() == 2
