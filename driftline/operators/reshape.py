"""Feature projection with a schema check, wide -> long, finite and
labelled filters."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.functions.columns import is_finite


class MissingFeaturesError(ValueError):
    pass


def project_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The model's features in order; a missing one is an error naming it."""
    absent = sorted(set(features).difference(df.columns), key=list(features).index)
    if absent:
        raise MissingFeaturesError(f"no column for {len(absent)} of {len(features)} features: {absent}")
    return df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])


def monitored_features(profile_features: Sequence[str], exclude: Sequence[str] = ("Time",)) -> list[str]:
    """Profile features minus the excluded ones (``Time`` by default)."""
    return [f for f in profile_features if f not in set(exclude)]


def unpivot_features(df: DataFrame, ids: Sequence[str], features: Sequence[str],
                     feature_col: str = "feature", value_col: str = "value") -> DataFrame:
    """Wide -> long in one pass (an Expand node), every feature cast to double."""
    wide = df.select(*ids, *[F.col(f).cast("double").alias(f) for f in features])
    return wide.unpivot(list(ids), list(features), feature_col, value_col)


def finite_filter(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Drop NULL, NaN and +/-inf."""
    return df.where(is_finite(value_col))


def labeled_filter(df: DataFrame, label_col: str = "label") -> DataFrame:
    """P5: rows with a label (NULL and NaN are none); the score travels on the same row."""
    y = F.col(label_col).cast("double")
    return df.where(y.isNotNull() & ~F.isnan(y))
