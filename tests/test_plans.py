"""Golden KS p-values and plan shape: no single-partition exchange over
row-level data in the ranking, KS and PSI plans."""
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from driftline.functions.columns import ks_pvalue
from tests.conftest import SF001

# Published (D, p) pairs of a monitoring run with 20,000 reference
# and 20,000 batch values per feature.
GOLDEN_KS = [
    (0.005850000000000022, 0.8814432612858475),
    (0.007450000000000068, 0.632793350220073),
    (0.009800000000000031, 0.2901752098048599),
    (0.009700000000000042, 0.30162000901228003),
    (0.00990000000000002, 0.27904204582520264),
    (0.006299999999999972, 0.8198036866515741),
    (0.006350000000000022, 0.8123573009812199),
    (0.005650000000000044, 0.9051240941270082),
    (0.014100000000000001, 0.03715908391436351),
    (0.010000000000000009, 0.2682191277029181),
    (0.008750000000000036, 0.4257468753812823),
    (0.014799999999999924, 0.024781996158042108),
    (0.00495000000000001, 0.9660453636792142),
    (0.012400000000000078, 0.09158823199051669),
    (0.007550000000000057, 0.6159676479968266),
    (0.00495000000000001, 0.9660453636792142),
    (0.013050000000000006, 0.06576339470777692),
    (0.006849999999999912, 0.7333159767966685),
    (0.01050000000000001, 0.21867463645335317),
    (0.0041999999999999815, 0.9942387306878446),
    (0.005349999999999966, 0.9355826254004891),
    (0.008900000000000005, 0.4043450231304503),
    (0.007500000000000007, 0.6243741569816843),
    (0.00655, 0.7816295263399751),
    (0.009050000000000002, 0.38359729921950303),
    (0.007249999999999979, 0.666519467755871),
    (0.008650000000000047, 0.44036593899640386),
    (0.010799999999999976, 0.19248149881260368),
    (0.007199999999999984, 0.6749428955819712),
]


def test_ks_pvalue_reproduces_golden_pairs(spark):
    df = spark.createDataFrame([(d, p) for d, p in GOLDEN_KS], "d double, p double")
    out = df.select("p", ks_pvalue("d", F.lit(20000), F.lit(20000)).alias("got")).collect()
    for r in out:
        assert r.got == pytest.approx(r.p, abs=1e-5)


@pytest.mark.parametrize("name", ["pr_auc", "roc_auc", "ks_statistic", "psi_levels", "threshold_metrics"])
def test_no_single_partition_exchange(spark, name):
    df = E.queries()[name](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange SinglePartition", plan), plan


def test_score_and_drift_measures_move_summaries_only(spark):
    """Continuous features and scores: no shuffle of PSI, threshold metrics, score drift
    or the sweep carries more than windows x features rows per map task."""
    from bench import shuffled_rows
    from driftline.operators import quality, recalibrate
    from driftline.operators.drift import feature_drift, prediction_drift
    from driftline.operators.profile import build_profile
    from driftline.plans.policy import Policy
    df = spark.range(0, 60_000, 1, 6).select(
        F.concat(F.lit("b"), (F.col("id") % 3).cast("string")).alias("batch_id"),
        *[F.randn(i).alias(f"f{i}") for i in range(3)], F.rand(9).alias("score"),
        (F.rand(10) < 0.1).cast("int").alias("label"))
    prof = build_profile(df, ["f0", "f1", "f2"], 0.5, "m").frozen()
    for made, most in ((feature_drift(df, prof, Policy(), with_ks=False), 3 * 3 * 6),
                       (quality.threshold_metrics(df, ["batch_id"], 0.5), 3 * 6),
                       (prediction_drift(df, prof, 0.5), 3 * 6),
                       (recalibrate.threshold_sweep(df, ["batch_id"]), 3 * 96 * 6)):
        assert 0 < max(shuffled_rows(made)) <= most


def test_ks_does_not_move_the_reference(spark):
    from bench import shuffled_rows
    from driftline.operators.drift import ks_statistics, value_counts
    from driftline.operators.profile import build_profile
    ref = spark.range(50_000).select(F.randn(1).alias("a"))
    cur = spark.range(1_000).select(F.lit("b").alias("batch_id"), F.randn(2).alias("a"))
    prof = build_profile(ref, ["a"], 0.5, "m", label_col=None, baseline=False).frozen()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = shuffled_rows(ks_statistics(value_counts(cur, ["a"]), prof.features, prof.ks))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(rows) <= 1_000 * 2
