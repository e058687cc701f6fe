"""The reference CDF as a tree of bounded nodes, and KS by descent through it."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from driftline.operators import cdftree
from driftline.operators.quantile import value_cdf
from driftline.session import freeze
from tests.helpers import ks_distance


def _cases():
    """(feature, reference values, {batch: values}): ties, few values, shifts, batches that lie
    inside one node, outside of the reference, or on its values alone."""
    rng = np.random.default_rng(11)
    wide = rng.normal(size=900)
    near = np.sort(wide)[450:452]
    return {
        "wide": (wide, {"same": wide, "near": rng.normal(0.05, size=400), "above": wide + 100, "below": wide - 100,
                        "inside": rng.uniform(*near, size=300), "one": np.array([near[0]]), "odd": np.r_[wide[:50], np.nan, np.inf]}),
        "ties": (rng.integers(0, 40, 700).astype(float), {"same": rng.integers(0, 40, 500).astype(float),
                                                          "near": rng.integers(5, 90, 300) / 2.0}),
        "few": (np.array([1.0, 1.0, 2.0]), {"same": np.array([1.0, 2.0]), "near": np.array([0.0, 1.5, 9.0])}),
        "constant": (np.zeros(100), {"same": np.zeros(7), "near": np.ones(3)}),
    }


def test_descent_equals_brute_force(spark):
    cases = _cases()
    ref = spark.createDataFrame(pd.DataFrame([(f, v) for f, (r, _) in cases.items() for v in r], columns=["feature", "value"]))
    rows = spark.createDataFrame(pd.DataFrame([(b, f, v) for f, (_, bs) in cases.items() for b, vs in bs.items() for v in vs],
                                              columns=["batch_id", "feature", "value"])).withColumn("nb", F.lit(1))
    want = {(b, f): ks_distance(r, vs) for f, (r, bs) in cases.items() for b, vs in bs.items()}
    for fanout in (7, cdftree.FANOUT):          # four levels, and one
        tree = freeze(cdftree.cdf_tree(value_cdf(ref, ["feature"]), fanout), "tree-test")
        got = cdftree.ks_statistics(rows, tree, fanout).collect()
        assert len(got) == len(want)
        for r in got:
            assert abs(r.ks_statistic - want[r.batch_id, r.feature]) < 1e-12, (r, fanout)
            assert r.n_ref == len(cases[r.feature][0])
            assert r.n_cur == np.isfinite(cases[r.feature][1][r.batch_id]).sum()
    # a count beside each value is worth as many rows
    packed = rows.groupBy("batch_id", "feature", "value").agg(F.sum("nb").alias("nb"))
    assert {(r.batch_id, r.feature): round(r.ks_statistic, 12) for r in cdftree.ks_statistics(packed, tree).collect()} \
        == {k: round(v, 12) for k, v in want.items()}


def test_no_node_grows_with_the_reference(spark):
    for n, partitions, depth in ((3_000, "8", 2), (40_000, "3", 2)):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            ref = spark.range(n).select(F.lit("a").alias("feature"), F.randn(1).alias("value"))
            tree = freeze(cdftree.cdf_tree(value_cdf(ref, ["feature"])), "tree-size")
            r = tree.agg(F.max(F.size("lows")).alias("most"), F.max("depth").alias("depth"),
                         F.sum(F.when(F.col("level") == F.col("depth"), F.size("lows"))).alias("values")).first()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert r.most <= cdftree.FANOUT <= 4096 and (r.depth, r["values"]) == (depth, n)
        assert tree.where("level = 1").count() == 1
