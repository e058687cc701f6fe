"""Scoring (P6-P9, C9): the fitted scaler, the model plug-in point and the
weighted training of a challenger.

A Spark ML ``PipelineModel`` scores inside the JVM; any other model object
with ``predict_proba`` (or ``predict``) is applied with Arrow batches through
``mapInPandas``, the model shipped once per executor as a broadcast or, when large,
as a file."""
from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid
from collections.abc import Sequence

import pandas as pd
from pyspark import SparkFiles, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.columns import flagged
from driftline.operators.reshape import project_features


def fit_scaler(train: DataFrame, column: str) -> tuple[float, float]:
    """Mean and population std of ``column`` on the training slice only."""
    row = train.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s")).first()
    return float(row["m"]), float(row["s"])


def apply_scaler(df: DataFrame, column: str, mean: float, std: float, out: str | None = None) -> DataFrame:
    """Apply a fitted scaler (never re-fit on a batch)."""
    std = std or 1.0
    return df.withColumn(out or column, (F.col(column) - F.lit(mean)) / F.lit(std))


#: A pickled model up to this size is broadcast; a larger one is handed out as a file.
BROADCAST_BYTES = 64 << 20
#: Columns that Spark ML models add.
_ADDED = ("features", "rawPrediction", "probability", "prediction")


def score(df: DataFrame, model, features: Sequence[str], out: str = "score",
          keep: Sequence[str] | None = None) -> DataFrame:
    """Probability of class 1 (or ``predict`` as a fallback) as a column. All columns
    of the input stay, also those named like the ones that a Spark ML model adds."""
    project_features(df, features)  # P1: raises naming any missing feature
    try:
        from pyspark.ml import PipelineModel, Transformer
        from pyspark.ml.functions import vector_to_array
        if isinstance(model, (PipelineModel, Transformer)):
            reads = {*features, getattr(model, "getFeaturesCol", lambda: None)()}
            held = {c: f"__input_{c}" for c in _ADDED if c in df.columns and c not in reads}
            src = df.withColumnsRenamed(held)
            scored = model.transform(src)
            added = [c for c in scored.columns if c not in src.columns]
            return scored.withColumn(out, vector_to_array("probability")[1]).drop(*[c for c in added if c != out]) \
                .withColumnsRenamed({m: c for c, m in held.items()})
    except ImportError:  # pragma: no cover
        pass
    return score_python_model(df, model, features, out)


def score_python_model(df: DataFrame, model, features: Sequence[str], out: str = "score",
                       broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """P8 for a foreign model object: Arrow batches through mapInPandas. The model
    travels by value, so its class need not be installed on the executors: broadcast up
    to ``broadcast_bytes``, else as a file that each executor fetches and each Python
    worker loads once, whatever the number of its tasks."""
    load = _shared_model(df.sparkSession.sparkContext, model, broadcast_bytes)
    feats = list(features)

    def _apply(batches):
        m = load()
        for pdf in batches:
            x = pdf[feats].astype("float64")
            if hasattr(m, "predict_proba"):
                p = m.predict_proba(x)
                s = p[:, 1] if getattr(p, "ndim", 1) == 2 else p
            else:
                s = m.predict(x)
            pdf[out] = pd.Series(s, index=pdf.index).astype("float64")
            yield pdf

    schema = T.StructType(df.schema.fields + [T.StructField(out, T.DoubleType(), True)])
    return df.mapInPandas(_apply, schema=schema)


def _shared_model(sc, model, broadcast_bytes: int):
    """A function that gives the model in a task. The driver writes the model to a file of
    its own, which Spark serves to the executors."""
    name = f"driftline-model-{uuid.uuid4().hex}.pkl"
    path = os.path.join(tempfile.mkdtemp(prefix="driftline-model-"), name)
    with open(path, "wb") as f:
        cloudpickle.dump(model, f)
    if os.path.getsize(path) <= broadcast_bytes:
        with open(path, "rb") as f:
            bc = sc.broadcast(f.read())
        os.unlink(path)
        return lambda: cloudpickle.loads(bc.value)
    sc.addFile(path)

    def load():
        # a module of this process's own keeps the latest model between tasks
        kept = sys.modules.setdefault("_driftline_model", types.ModuleType("_driftline_model"))
        if getattr(kept, "name", None) != name:
            kept.name = kept.model = None
            with open(SparkFiles.get(name), "rb") as f:
                kept.model = cloudpickle.load(f)
            kept.name = name
        return kept.model

    return load


def flag(df: DataFrame, threshold: float, score_col: str = "score", out: str = "flagged") -> DataFrame:
    """Inclusive threshold; NaN scores are never flagged."""
    return df.withColumn(out, flagged(score_col, threshold))


def class_weight(label: str, pos_weight: Column) -> Column:
    return F.when(F.col(label) == 1, pos_weight).otherwise(F.lit(1.0))


def train_weighted_gbt(train: DataFrame, features: Sequence[str], label: str = "label",
                       max_iter: int = 20, seed: int = 42):
    """Positives weighted by neg/pos, gradient-boosted trees in Spark ML."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    counts = train.agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("p"),
                       F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("n")).first()
    w = float(counts["n"]) / max(float(counts["p"]), 1.0)
    data = train.withColumn("_w", class_weight(label, F.lit(w))).withColumn(label, F.col(label).cast("double"))
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"),
                            GBTClassifier(labelCol=label, featuresCol="features", weightCol="_w",
                                          maxIter=max_iter, seed=seed)])
    return pipe.fit(data)
