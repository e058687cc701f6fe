"""From training to escalation: a model is trained on early rows, profiled, and watched
over windows that stay the same, drift in their features, and lose the signal."""
from pyspark.sql import functions as F

from driftline.operators.scoring import score, train_weighted_gbt
from driftline.plans.monitor import build_reference, score_and_monitor
from driftline.plans.policy import Policy

FEATURES = ["a", "b"]
POLICY = Policy(min_batch_rows=300, min_labeled_rows=300, min_labeled_frauds=20, cooldown_days=0)


def _rows(spark, n, seed, shift=0.0, signal=2.5):
    """Labelled rows: a carries the signal, b is noise; ``shift`` moves both."""
    y = (F.rand(seed) < 0.12).cast("int")
    base = spark.range(n).select(F.concat(F.lit(f"r{seed}-"), F.col("id").cast("string")).alias("row_id"),
                                 F.col("id").cast("double").alias("Time"), y.alias("label"),
                                 F.randn(seed + 1).alias("na"), F.randn(seed + 2).alias("nb"))
    return base.select("row_id", "Time", "label", (F.col("na") + signal * F.col("label") + shift).alias("a"),
                       (F.col("nb") + shift).alias("b"))


def test_train_profile_watch_and_escalate(spark, tmp_path):
    path = str(tmp_path / "train")
    _rows(spark, 6000, 1).write.parquet(path)
    train = spark.read.parquet(path)
    model = train_weighted_gbt(train, FEATURES, "label", max_iter=5)
    profile = build_reference(score(train, model, FEATURES), FEATURES, 0.5, "m1", "Time", policy=POLICY).frozen("e2e")
    base = profile.model_values()
    assert base["base_pr_auc"] > 0.6 and base["n_reference_rows"] == 4800 and base["n_scores"] == 1200

    def watch(kinds):
        parts = None
        for i, kw in enumerate(kinds):
            part = _rows(spark, 1500, 100 + 10 * i, **kw).withColumn("batch_id", F.lit(f"w{i}")) \
                .withColumn("day", F.lit(i))
            parts = part if parts is None else parts.unionByName(part)
        out = str(tmp_path / f"windows{len(kinds)}-{sum(map(len, kinds))}")
        parts.write.parquet(out)
        now = F.timestamp_seconds(F.lit(1_767_225_600) + F.substring("batch_id", 2, 2).cast("long") * 86_400)
        made = score_and_monitor(spark.read.parquet(out), model, FEATURES, profile, POLICY, 0.5, now=now)
        return made.orderBy("batch_id").collect()

    same, drifted, drifted2 = watch([{}, {"shift": 3.0}, {"shift": 3.0}])
    assert same.action in ("NO_ACTION", "WATCH") and same.perf_status == "OK" and same.n_features_alert == 0
    assert drifted.n_features_alert == 2 and drifted.n_ks_significant == 2 and drifted.action == "WATCH"
    assert drifted2.action in ("RETRAIN", "RECALIBRATE_THRESHOLD") and drifted2.confirmed_streak == 2
    lost, lost2 = watch([{"signal": 0.0}, {"signal": 0.0}])
    assert lost.severity == "ALERT" and lost.action == "WATCH"
    assert lost2.action == "RETRAIN" and lost2.pr_auc_relative_drop > 0.5
    short = watch([{}])
    assert short[0].n_rows == 1500
