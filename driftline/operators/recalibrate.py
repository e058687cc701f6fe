"""Threshold recalibration (T1-T4): the sweep in one aggregation of the labelled rows
(each row is assigned the highest threshold it clears where it is read; counts are
suffix-summed over <= 96 threshold rows), then the two selection rules."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.operators.quantile import bucket_of
from driftline.operators.reshape import labeled_filter


def sweep_thresholds() -> list[float]:
    """The swept thresholds: 0.05 .. 0.99 stepped in doubles (95 values, the
    second is 0.060000000000000005, as a stepped range gives them)."""
    return [float(t) for t in np.arange(0.05, 1.0, 0.01)]


def threshold_sweep(df: DataFrame, keys: Sequence[str] = (), thresholds: Sequence[float] | None = None,
                    score: str = "score", label: str = "label") -> DataFrame:
    """T1 over the labelled rows of ``df``: one row per (keys, threshold) with
    precision, recall, f1, alert_volume, missed_fraud_count."""
    ts = sorted(thresholds or sweep_thresholds())
    arr = F.array(*[F.lit(t) for t in ts])
    s = F.col(score).cast("double")
    idx = F.when(F.isnan(s) | s.isNull(), F.lit(-1)).otherwise(bucket_of(s, arr, len(ts)) - 1)
    per = (labeled_filter(df, label).select(*keys, idx.alias("idx"), F.col(label).cast("long").alias("_y"))
           .groupBy(*keys, "idx").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("k")))
    tot = per.groupBy(*keys).agg(F.sum("k").alias("P"))
    grid = tot.select(*keys, "P", F.posexplode(arr).alias("idx", "threshold"))
    j = grid.join(per, [*keys, "idx"], "left").fillna(0, ["n", "k"])
    # suffix sums over the (<= 96) thresholds of one key: flagged = score clears t
    w = Window.partitionBy(*keys).orderBy(F.col("idx").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    j = j.select(*keys, "idx", "threshold", "P", F.sum("n").over(w).alias("alert_volume"),
                 F.sum("k").over(w).alias("tp"))
    prec = F.when(F.col("alert_volume") > 0, F.col("tp") / F.col("alert_volume")).otherwise(0.0)
    rec = F.when(F.col("P") > 0, F.col("tp") / F.col("P")).otherwise(0.0)
    out = j.select(*keys, "threshold", prec.alias("precision"), rec.alias("recall"),
                   F.col("alert_volume").cast("long").alias("alert_volume"),
                   (F.col("P") - F.col("tp")).cast("long").alias("missed_fraud_count"))
    p, r = F.col("precision"), F.col("recall")
    return out.select(*out.columns[:len(keys) + 3],
                      F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"),
                      "alert_volume", "missed_fraud_count")


def _first(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    """First row per key under ``order`` (<= 95 rows per key)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", F.row_number().over(w).alias("_rn")).where("_rn = 1").drop("_rn")


def pick_max_f1(sweep: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Max F1; ties go to the lowest threshold."""
    return _first(sweep, keys, [F.col("f1").desc(), F.col("threshold").asc()])


def pick_recall_target(sweep: DataFrame, target: float, keys: Sequence[str] = ()) -> DataFrame:
    """Max precision among thresholds with recall >= target; if none
    qualifies, max recall. Ties go to the lowest threshold."""
    elig = F.col("recall") >= F.lit(float(target))
    return _first(sweep, keys, [elig.desc(), F.when(elig, F.col("precision"))
                                .otherwise(F.col("recall")).desc(), F.col("threshold").asc()])


def proposal(best: DataFrame, previous: float, rule: str, model_version: str) -> DataFrame:
    """T4: the proposal row (the live threshold is never touched)."""
    return best.select(F.col("threshold"), F.lit(float(previous)).alias("previous_threshold"),
                       F.lit(rule).alias("selection_rule"), "precision", "recall", "f1",
                       F.lit(model_version).alias("model_version"))


def f1_rule() -> str:
    return "largest F1; of equal ones the lowest threshold"


def recall_rule(target: float) -> str:
    return f"best precision where recall reaches {target}"
