"""The monitoring fixture over the driver tables: a reference profile frozen
from the early slice of the ``txn`` view and the monthly windows after it."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from driftline.operators.profile import Profile, build_profile
from driftline.plans.policy import FIXTURE_POLICY, Policy
from driftline.plans.views import TXN_FEATURES, TXN_THRESHOLD, txn, txn_reference, txn_windows

MODEL_VERSION = "champion-1"


@dataclass
class Fixture:
    reference: DataFrame
    windows: DataFrame
    profile: Profile
    policy: Policy
    threshold: float = TXN_THRESHOLD


_CACHE: dict = {}


def frozen_profile(profile: Profile, tag: str) -> Profile:
    """Materialise the three profile tables once (S2: a written table)."""
    return profile.frozen(tag)


def txn_fixture(spark: SparkSession, sf_dir: str, freeze_profile: bool = True) -> Fixture:
    key = (id(spark), sf_dir, freeze_profile)
    if key in _CACHE and _CACHE[key][0] is spark:
        return _CACHE[key][1]
    ref = txn_reference(spark, sf_dir)
    prof = build_profile(ref, TXN_FEATURES, TXN_THRESHOLD, MODEL_VERSION, FIXTURE_POLICY.psi_bins,
                         materialize=freeze_profile)
    if freeze_profile:
        prof = frozen_profile(prof, "txn-profile")
    fx = Fixture(ref, txn_windows(spark, sf_dir), prof, FIXTURE_POLICY)
    _CACHE[key] = (spark, fx)
    return fx


__all__ = ["Fixture", "txn_fixture", "txn", "MODEL_VERSION"]
