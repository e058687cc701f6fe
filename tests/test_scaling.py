"""Work that has to spread: what a task holds, and how often rows are read or moved."""
import pytest
from pyspark.sql import functions as F

from driftline.operators import cdftree
from driftline.operators.quantile import bucket_of, value_cdf, with_bucket


@pytest.fixture()
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_values_of_one_feature_are_dealt_over_the_tasks(uncoalesced):
    long = uncoalesced.range(40_000).select(F.expr("concat('x', id % 2)").alias("feature"), F.expr("(id div 2) * 1.5D").alias("value"))
    for tag in (None, "cdf-values"):
        cdf = value_cdf(long, ["feature"], tag=tag)
        placed = cdf.where("rank >= 0").select("rank", F.spark_partition_id().alias("p"))
        held = [r.n for r in placed.groupBy("p").agg(F.count("rank").alias("n")).collect()]
        assert len(held) > 4 and max(held) < 15_000
        assert cdf.where("rank <> cum_lt or cum_le <> rank + 1 or n <> 20000 or value <> rank * 1.5").count() == 0


@pytest.mark.parametrize("n_cuts", [1, 6, 127, 300])
def test_buckets_by_steps_equal_the_nested_form(spark, n_cuts):
    cuts = F.array(*[F.lit(float(3 * i)) for i in range(n_cuts - 1)]).cast("array<double>")
    rows = spark.range(-5, 3 * n_cuts + 5).select(F.col("id").cast("double").alias("value"), cuts.alias("cuts"))
    rows = rows.select("*", bucket_of("value", "cuts", n_cuts).alias("want"))
    assert with_bucket(rows, ["want"], "value", n_cuts).where("bucket is null or bucket <> want").count() == 0


def test_ranking_keeps_no_group_in_one_task(uncoalesced):
    from driftline.operators.quality import ranking_metrics

    groups = uncoalesced.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") / 1000).alias("score"),
                                            F.lit(1).cast("long").alias("n"), (F.col("id") % 2).alias("k"))
    plan = ranking_metrics(groups, ["g"])._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.split("\n") if "Window" in line and "score" in line]
    assert sorts
    window = plan[plan.index(sorts[0]):]
    below = next(line for line in window.split("\n") if "Exchange hashpartitioning" in line)
    assert "bucket" in below


def test_only_rows_in_open_children_are_dealt_out(spark, monkeypatch):
    """Two features: the flat one is settled at the root, so none of its rows move."""
    kept = []
    place = cdftree._place
    monkeypatch.setattr(cdftree, "_place", lambda rows, keep, fanout=cdftree.FANOUT: kept.append(rows) or place(rows, keep, fanout))
    ref = spark.range(4000).select(F.explode(F.array(F.struct(F.lit("wide").alias("feature"), F.col("id").cast("double").alias("value")),
                                                     F.struct(F.lit("flat").alias("feature"), (F.col("id") % 5).cast("double").alias("value"))))
                                   .alias("r")).select("r.*")
    tree = cdftree.cdf_tree(value_cdf(ref, ["feature"]), 7)
    batch = ref.where("feature = 'flat' or value < 3000").select(F.expr("concat('w', cast(value % 1 as int))").alias("batch_id"), "feature", "value", F.lit(1).cast("long").alias("nb"))
    got = {r.feature: r.ks_statistic for r in cdftree.ks_statistics(batch, tree, 7).collect()}
    assert got["wide"] == pytest.approx(0.25) and got["flat"] == pytest.approx(0.0)
    assert len(kept) > 1
    for rows in kept[1:]:
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin [batch_id" in plan
        assert rows.where("feature = 'flat'").count() == 0
