"""The decision ladder (L1-L7) over ordered windows.

* L3 streak: gaps-and-islands with window functions (a window that does not
  trigger, or HALTs, starts a new island); no recursion needed.
* L4-L6 cooldown: depends on earlier RETRAIN decisions, so it is a fold: per
  model (and policy), the windows that are ready to retrain are gathered in order
  and folded with ``aggregate`` inside Catalyst into the retrains that happen. The
  fold sees one small row per such window, never transactions; the retrains are then
  joined to their windows, and all else follows from the last one before each.
"""
from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.columns import rank_level

#: Leading reasons of a decision.
HOLD_MSG = "alert in %d of %d windows in a row; not acted on until confirmed"
RECAL_MSG = "scores have moved but the ranking holds: move the threshold before training anew"
RETRAIN_MSG = "confirmed over %d windows in a row"
COOLDOWN_MSG = "no retraining within %d days of the last one"

DEFAULT_STATE = {"streak": 0, "last_action": "NO_ACTION", "last_retrain_at": None}


def with_streak(flags: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """L3: streak = previous + 1 on a triggering window, else 0 (HALT resets). The
    column ``_streak0`` is the streak before the first window."""
    trig = (F.col("perf_alert") | F.col("drift_alert")) & ~F.col("halt")
    w = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    island = F.sum(F.when(trig, 0).otherwise(1)).over(w)
    df = flags.select("*", trig.alias("triggering"), island.alias("_island"))
    w2 = Window.partitionBy(*keys, "_island").orderBy(seq).rowsBetween(Window.unboundedPreceding,
                                                                       Window.currentRow)
    run = F.sum(F.col("triggering").cast("int")).over(w2)
    first_island = F.when(F.col("_island") == 0, F.col("_streak0")).otherwise(0)
    streak = F.when(F.col("triggering"), run + first_island).otherwise(0).cast("int")
    return df.select("*", streak.alias("streak")).drop("_island")


def with_state(flags: DataFrame, keys: Sequence[str], state: dict | DataFrame | None) -> DataFrame:
    """Add ``_streak0`` and ``_last0`` (microseconds): one state for all groups (dict), or one
    row per group (keys, streak, last_retrain_at). A stamp that cannot be read is none."""
    if isinstance(state, DataFrame):
        at = F.col("last_retrain_at")
        at = F.try_to_timestamp(at) if dict(state.dtypes)["last_retrain_at"] == "string" else at.cast("timestamp")
        rows = state.select(*keys, F.col("streak").cast("int").alias("_streak0"), F.unix_micros(at).alias("_last0"))
        joined = flags.join(rows, list(keys), "left")
        return joined.withColumn("_streak0", F.coalesce("_streak0", F.lit(0)))
    state = {**DEFAULT_STATE, **(state or {})}
    at = state["last_retrain_at"]
    last = F.unix_micros(F.try_to_timestamp(F.lit(str(at)))) if at else F.lit(None).cast("long")
    return flags.select("*", F.lit(int(state["streak"])).alias("_streak0"), last.alias("_last0"))


def decide(flags: DataFrame, keys: Sequence[str], p: Callable[[str], Column],
           seq: str = "seq", now: str = "now", state: dict | DataFrame | None = None) -> DataFrame:
    """One decision per window row of ``flags`` (columns halt,
    perf_alert, drift_alert, pr_auc_alert, any_warn, severity_rank, signals,
    ``now`` timestamp, ``seq`` order), per ``keys`` group.

    Adds action, severity, confirmed_streak, cooldown_active, reasons,
    in_history and last_retrain_at (state after the window)."""
    df = with_streak(with_state(flags, keys, state), keys, seq)
    recal = (p("prefer_recalibration") & F.col("drift_alert") & ~F.col("perf_alert")
             & ~F.col("pr_auc_alert"))
    df = df.select("*", p("consecutive_windows_to_confirm").alias("_required"), recal.alias("_recal"),
                   (p("cooldown_days").cast("long") * 86400 * 1000000).alias("_cool_us"),
                   F.unix_micros(F.col(now).cast("timestamp")).alias("_now_us"))
    # windows that would retrain but for a cooldown; the fold over them finds which do
    ready = F.col("triggering") & (F.col("streak") >= F.col("_required")) & ~F.col("_recal")
    item = F.struct(F.col(seq).cast("long").alias("seq"), F.col("_now_us").alias("now_us"),
                    F.col("_cool_us").alias("cool_us"))
    nothing = F.array().cast("array<struct<seq:bigint,us:bigint>>")
    init = F.struct(F.first("_last0").alias("last"), nothing.alias("done"))

    def step(acc, w):
        cold = acc["last"].isNotNull() & ((w["now_us"] - acc["last"]) < w["cool_us"])
        rec = F.struct(w["seq"].alias("seq"), w["now_us"].alias("us"))
        return F.struct(F.when(cold, acc["last"]).otherwise(w["now_us"]).alias("last"),
                        F.when(cold, acc["done"]).otherwise(F.array_append(acc["done"], rec)).alias("done"))

    folded = df.groupBy(*keys).agg(F.aggregate(
        F.array_sort(F.collect_list(F.when(ready, item))), init, step)["done"].alias("_retrains"))
    # each retrain stands at its window, and every later window sees the last one before it
    marks = folded.select(*keys, F.explode("_retrains").alias("_r")).select(
        *keys, F.col("_r.seq").alias("_seq"), F.col("_r.us").alias("_us"))
    same = [F.col(f"f.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys] + [F.col(f"f.{seq}") == F.col("m._seq")]
    out = df.alias("f").join(marks.alias("m"), functools.reduce(lambda a, b: a & b, same), "left").select("f.*", "m._us")
    earlier = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    out = out.select("*", F.coalesce(F.last("_us", ignorenulls=True).over(earlier), F.col("_last0")).alias("_before"))
    cooldown = F.coalesce(~F.col("halt") & ((F.col("_now_us") - F.col("_before")) < F.col("_cool_us")), F.lit(False))
    out = out.select("*", cooldown.alias("cooldown_active"))
    action = (F.when(F.col("halt"), "HALT")
              .when(~F.col("triggering"), F.when(F.col("any_warn"), "WATCH").otherwise("NO_ACTION"))
              .when((F.col("streak") < F.col("_required")) | F.col("cooldown_active"), "WATCH")
              .when(F.col("_recal"), "RECALIBRATE_THRESHOLD").otherwise("RETRAIN"))
    out = out.select("*", action.alias("action")).select("*", F.timestamp_micros(
        F.when(F.col("action") == "RETRAIN", F.col("_now_us")).otherwise(F.col("_before"))).alias("last_retrain_at"))

    sig = F.col("signals")
    msgs = F.transform(F.filter(sig, lambda s: s["level"].isin("WARN", "ALERT")), lambda s: s["message"])
    quality = F.transform(F.filter(sig, lambda s: (s["category"] == "data_quality")
                                   & (s["level"] == "ALERT")), lambda s: s["message"])
    hold = F.format_string(HOLD_MSG, F.col("streak"), F.col("_required"))
    confirmed = F.when(F.col("_recal"), F.lit(RECAL_MSG)).otherwise(
        F.format_string(RETRAIN_MSG, F.col("streak")))
    lead = (F.when(F.col("halt") | ~F.col("triggering"), F.array().cast("array<string>"))
            .when(F.col("streak") < F.col("_required"), F.array(hold))
            .when(F.col("cooldown_active"),
                  F.array(F.format_string(COOLDOWN_MSG, p("cooldown_days")), confirmed))
            .otherwise(F.array(confirmed)))
    reasons = F.when(F.col("halt"), quality).otherwise(F.concat(lead, msgs))
    severity = F.when(F.col("halt"), "ALERT").otherwise(rank_level("severity_rank"))
    return out.select(
        "*", severity.alias("severity"),
        F.when(F.col("halt"), 0).otherwise(F.col("streak")).alias("confirmed_streak"),
        reasons.alias("reasons"), (~F.col("halt")).alias("in_history")).drop(
        "_required", "_recal", "_cool_us", "_now_us", "_streak0", "_last0", "_us", "_before")
