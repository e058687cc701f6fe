"""Monitoring policy: base values, per-environment overlays, and the policy
table (one row per environment) built with Spark (overlay wins per key)."""
from __future__ import annotations

from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    env: str = "dev"
    # The base policy of the monitored system.
    min_batch_rows: int = 1000
    psi_bins: int = 10
    psi_warn: float = 0.10
    psi_alert: float = 0.25
    ks_alpha: float = 0.01
    ks_correction: str = "bonferroni"
    drifted_fraction_warn: float = 0.10
    drifted_fraction_alert: float = 0.25
    score_psi_warn: float = 0.10
    score_psi_alert: float = 0.20
    flag_rate_rel_warn: float = 0.50
    flag_rate_rel_alert: float = 1.00
    label_delay_days: int = 30
    min_labeled_rows: int = 5000
    min_labeled_frauds: int = 30
    base_pr_auc: float | None = None
    base_recall: float | None = None
    base_precision: float | None = None
    pr_auc_rel_warn: float = 0.05
    pr_auc_rel_alert: float = 0.15
    recall_abs_warn: float = 0.05
    recall_abs_alert: float = 0.10
    precision_abs_alert: float = 0.15
    consecutive_windows_to_confirm: int = 2
    cooldown_days: int = 7
    prefer_recalibration: bool = True
    rolling_window_days: int | None = 180
    min_training_rows: int = 50000
    min_training_frauds: int = 100
    min_pr_auc_improvement: float = 0.005
    max_recall_regression: float = 0.02
    min_precision: float = 0.50
    holdout_days: int = 30

    def with_(self, **kw) -> "Policy":
        return replace(self, **kw)


# Per-environment overlays of the monitored system.
OVERLAYS: dict[str, dict] = {
    "dev": {"min_batch_rows": 500, "min_labeled_rows": 2000, "min_labeled_frauds": 10,
            "consecutive_windows_to_confirm": 2, "cooldown_days": 0},
    "staging": {"cooldown_days": 3, "min_pr_auc_improvement": 0.0},
    "prod": {"min_batch_rows": 5000, "min_labeled_rows": 20000, "min_labeled_frauds": 50,
             "consecutive_windows_to_confirm": 3, "cooldown_days": 14,
             "min_pr_auc_improvement": 0.01, "max_recall_regression": 0.01,
             "min_precision": 0.60},
}

# Policy used by the driver-table fixture (monthly windows of `lineitem`).
FIXTURE_POLICY = Policy(env="fixture", min_batch_rows=500, min_labeled_rows=500,
                        min_labeled_frauds=15, consecutive_windows_to_confirm=2,
                        cooldown_days=60)

_TYPES = {"int": "bigint", "float": "double", "str": "string", "bool": "boolean"}


def _spark_type(f) -> str:
    name = f.type if isinstance(f.type, str) else f.type.__name__
    return _TYPES[name.split("|")[0].strip()]


def policy_fields() -> list[tuple[str, str]]:
    return [(f.name, _spark_type(f)) for f in fields(Policy) if f.name != "env"]


def for_env(env: str) -> Policy:
    return replace(Policy(env=env), **OVERLAYS.get(env, {}))


def policy_columns(policy: Policy, prefix: str = "p_") -> list[Column]:
    """The policy as literal columns (constant-folded by Catalyst)."""
    out = []
    for name, typ in policy_fields():
        out.append(F.lit(getattr(policy, name)).cast(typ).alias(prefix + name))
    out.append(F.lit(policy.env).alias(prefix + "env"))
    return out


def policy_struct(policy: Policy) -> Column:
    return F.struct(*policy_columns(policy))


def policy_table(spark: SparkSession, envs=("dev", "staging", "prod")) -> DataFrame:
    """Base key/value table left-joined to an overlay key/value table; the
    overlay value wins per key; pivoted to one row per environment."""
    base = Policy()
    base_rows = [(k, None if getattr(base, k) is None else str(getattr(base, k)))
                 for k, _ in policy_fields()]
    base_df = spark.createDataFrame(base_rows, "key string, base_value string")
    overlay_rows = [(env, k, str(v)) for env in envs for k, v in OVERLAYS.get(env, {}).items()]
    overlay_df = spark.createDataFrame(overlay_rows or [("dev", "x", None)],
                                       "env string, key string, value string")
    keyed = (base_df.select(F.explode(F.array(*[F.lit(e) for e in envs])).alias("env"),
                            "key", "base_value"))
    merged = (keyed.join(overlay_df, ["env", "key"], "left")
              .select("env", "key", F.coalesce("value", "base_value").alias("value")))
    wide = merged.groupBy("env").pivot("key", [k for k, _ in policy_fields()]).agg(F.first("value"))
    casts = []
    for k, typ in policy_fields():
        c = F.col(k)
        if typ == "boolean":
            c = F.lower(c) == "true"
        casts.append(c.cast(typ).alias(k))
    return wide.select("env", *casts)
