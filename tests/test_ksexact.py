"""Exact two-sample KS p-values against every order of the pooled values."""
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.operators.drift import feature_drift
from driftline.operators.ksexact import EXACT_ROWS, path_pvalue
from driftline.operators.profile import build_profile
from driftline.plans.policy import Policy


def _farthest(n, m):
    """The largest |i m - j n| along every order of n and m values."""
    out = []
    for first in itertools.combinations(range(n + m), n):
        steps = np.full(n + m, -n)
        steps[list(first)] = m
        out.append(np.abs(np.cumsum(steps)).max())
    return np.array(out)


@pytest.mark.parametrize("n", range(1, 9))
def test_all_orders(n):
    for m in range(1, 9):
        far = _farthest(n, m)
        for h in range(n * m + 1):
            assert path_pvalue(h / (n * m), n, m) == pytest.approx((far >= h).mean(), abs=1e-12)


def test_small_values_keep_their_digits():
    # only two of C(60, 30) orders are this far
    assert path_pvalue(1.0, 30, 30) == pytest.approx(2 / 118264581564861424, rel=1e-9)
    assert path_pvalue(1.0, 3000, 7000) == 0.0 or path_pvalue(1.0, 3000, 7000) > 0


def test_small_windows_use_the_exact_form(spark):
    rng = np.random.default_rng(4)
    ref_v, cur_v = rng.normal(size=40), rng.normal(0.4, size=25)
    ref = spark.createDataFrame([(float(x),) for x in ref_v], "a double")
    cur = spark.createDataFrame([("b", float(x)) for x in cur_v] + [("c", float("nan"))], "batch_id string, a double")
    prof = build_profile(ref, ["a"], 0.5, "m", label_col=None, baseline=False).frozen()
    rows = {r.batch_id: r for r in feature_drift(cur, prof, Policy()).collect()}
    assert rows["b"].ks_pvalue == pytest.approx(path_pvalue(rows["b"].ks_statistic, 40, 25), abs=1e-12)
    assert rows["c"].ks_pvalue is None and not rows["c"].ks_significant
    big = build_profile(spark.range(EXACT_ROWS + 1).select(F.col("id").cast("double").alias("a")), ["a"], 0.5, "m",
                        label_col=None, baseline=False).frozen()
    plan = feature_drift(cur, big, Policy())._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan          # a larger reference needs no Python at all
