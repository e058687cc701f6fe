"""Structured Streaming forms.

* W1: new files become windows, each processed once (file source, checkpoint,
  ``availableNow`` trigger, idempotent ``foreachBatch`` writes keyed by epoch);
* W2: event-time daily windows with a watermark (append mode): counts and flags, and each
  feature's bin counts with their PSI when the day closes;
* W3: late labels attached to stored scores with a maturity filter (batch join), or to a
  stream of scores (stream-stream join with watermarks on both sides);
* W4: the streak / cooldown state carried per model in a state processor; rows are
  window summaries, never transactions.
"""
from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from driftline.functions.columns import classify_level, flagged, psi_sum
from driftline.operators import quality
from driftline.operators.profile import Profile
from driftline.operators.drift import bin_sums, binned, feature_drift
from driftline.operators.reshape import unpivot_features
from driftline.plans.monitor import monitor, nested_report, window_report
from driftline.plans.policy import Policy
from driftline.session import ensure_checkpoint_dir
from driftline.sources.sinks import read_state


def file_batches(spark: SparkSession, source_dir: str, schema: StructType, fmt: str = "parquet",
                 max_files: int = 1) -> DataFrame:
    """W1 source: every new file is a window; ``batch_id`` is its file name."""
    stream = (spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files)
              .option("header", "true").load(source_dir))
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return stream.withColumn("batch_id", name)


def monitor_files(spark: SparkSession, source_dir: str, schema: StructType, profile: Profile,
                  policy: Policy, threshold: float, checkpoint_dir: str, reports_dir: str,
                  monitored: Sequence[str] | None = None, label: str = "label",
                  decisions_dir: str | None = None, now=None) -> None:
    """Run the window report over each newly arrived file exactly once. With
    ``decisions_dir`` the ladder runs, too: decisions are stored per epoch, and each
    epoch starts from the state that the earlier ones left. Retried micro-batches
    overwrite their own epoch folder (idempotent)."""
    def _process(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()          # read once for the report and its joins
        try:
            out = os.path.join(reports_dir, f"epoch={epoch_id}")
            if decisions_dir is None:
                window_report(batch, profile, policy, threshold, monitored, label).write.mode("overwrite").parquet(out)
                return
            session = batch.sparkSession
            state = None
            if epoch_id:
                earlier = session.read.parquet(decisions_dir).where(F.col("epoch") < epoch_id)
                state = read_state(earlier)
            drift_rows = feature_drift(batch, profile, policy, monitored)
            made = monitor(batch, profile, policy, threshold, now=now, monitored=monitored, label=label,
                           state=state, drift_rows=drift_rows).persist()
            made.write.mode("overwrite").parquet(os.path.join(decisions_dir, f"epoch={epoch_id}"))
            nested_report(made, drift_rows).write.mode("overwrite").parquet(out)
            made.unpersist()
        finally:
            batch.unpersist()

    q = (file_batches(spark, source_dir, schema).writeStream.foreachBatch(_process)
         .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()


def daily_windows(stream: DataFrame, ts: str, value: str, score: str, label: str,
                  threshold: float, watermark: str = "1 day") -> DataFrame:
    """Per event-time day: events, flagged, positives, mean value. The
    timestamp is cast to TIMESTAMP (watermarks reject TIMESTAMP_NTZ)."""
    s = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    return s.groupBy(F.window("_ts", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(flagged(score, threshold).cast("long")).alias("n_flagged"),
        F.sum(F.col(label).cast("long")).alias("n_errors"),
        F.avg(value).alias("mean_value")).select(
        F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n_events", "n_flagged", "n_errors",
        "mean_value")


def daily_bins(stream: DataFrame, ts: str, features: Sequence[str], profile: Profile, policy: Policy,
               watermark: str = "1 day") -> DataFrame:
    """Per event-time day and feature: rows, finite rows, rows in each bin of the
    reference, and the PSI against it. On a stream the state is one vector of counts for
    each open day and feature, however many rows come; a day's row is emitted when the
    watermark passes its end, with all rows that came before that. Edges and reference
    proportions are broadcast (one row per feature). On a table it gives all days."""
    names = [f for f in features if f in profile.feature_names]
    pf = profile.features.where(F.col("feature").isin(*names))
    rows = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    sums = binned(unpivot_features(rows, ["_ts"], names), ["_ts"], pf, profile.bins).groupBy(
        F.window("_ts", "1 day").alias("w"), "feature").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("_fin").cast("long")).alias("n_finite"), *bin_sums(profile.bins))
    known = F.broadcast(pf.select("feature", "n_bins", "proportions"))
    counts = F.slice(F.array(*[F.col(f"_k{k}") for k in range(profile.bins)]), 1, F.col("n_bins"))
    out = sums.join(known, "feature").select("*", counts.alias("bin_counts"))
    shares = F.when(F.col("n_finite") > 0, F.transform("bin_counts", lambda c: c / F.col("n_finite")))
    out = out.select("*", psi_sum(shares, "proportions", "n_bins").alias("psi"))
    return out.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "feature", "n_rows", "n_finite", "bin_counts",
                      "psi", classify_level("psi", policy.psi_warn, policy.psi_alert).alias("psi_level"))


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all input that is there, in append mode into a table under the
    session's checkpoint folder, and return the rows that it emitted."""
    spark = stream.sparkSession
    root = os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")
    out = os.path.join(root, "rows")
    stream.writeStream.format("parquet").outputMode("append").option("path", out).option(
        "checkpointLocation", os.path.join(root, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def late_labels(scores: DataFrame, labels: DataFrame, key: str, ts: str | None, now, delay_days: int,
                batch: str = "batch_id", label: str = "label", arrived: str | None = None) -> DataFrame:
    """Stored scores left-joined to the labels that have arrived (of several for one
    key the newest by ``arrived``, else the largest); only windows whose newest event
    is at least ``delay_days`` old are graded."""
    newest = F.max_by(label, arrived) if arrived else F.max(label)
    one = labels.groupBy(key).agg(newest.alias(label))
    joined = scores.drop(label).join(one, key, "left")
    mature = quality.label_maturity(scores, [batch], ts, now, delay_days).where("mature").select(batch)
    return joined.join(mature, batch, "left_semi")


def late_labels_stream(scores: DataFrame, labels: DataFrame, key: str, ts: str, arrived: str, delay: str = "30 days",
                       label: str = "label", slack: str = "1 day") -> DataFrame:
    """W3 as a stream: scores left-joined to the labels that arrive within ``delay`` of them.
    A label is emitted when both rows are there; a score without one when the watermarks
    of both sides have passed its delay, with a null label. So state is what is younger
    than delay and slack. A key with several labels has a row for each, with ``arrived``;
    newest_labels() keeps the last. Labels that come before their score don't count."""
    s = scores.drop(label).withColumn("_scored_at", F.col(ts).cast("timestamp")).withWatermark("_scored_at", slack)
    l = labels.select(F.col(key).alias("_key"), F.col(label).alias(label), F.col(arrived).cast("timestamp").alias("_arrived_at")) \
        .withWatermark("_arrived_at", slack)
    within = F.expr(f"_arrived_at >= _scored_at AND _arrived_at <= _scored_at + INTERVAL {delay}")
    return s.join(l, (F.col(key) == F.col("_key")) & within, "left_outer").drop("_key", "_scored_at") \
        .withColumnRenamed("_arrived_at", "arrived")


def newest_labels(rows: DataFrame, key: str, label: str = "label") -> DataFrame:
    """One row for each key of what late_labels_stream() emitted, with its newest label."""
    others = [c for c in rows.columns if c not in (key, label, "arrived")]
    return rows.groupBy(key).agg(F.max_by(label, "arrived").alias(label), *[F.first(c).alias(c) for c in others])


LADDER_IN = ("model_version string, seq long, batch_id string, now_us long, halt boolean, "
             "trig boolean, any_warn boolean, required long, recal boolean, cool_us long")
LADDER_OUT = ("model_version string, seq long, batch_id string, action string, "
              "confirmed_streak long, cooldown_active boolean")
LADDER_DONE = "streak long, last_us long, due long"
LADDER_WAITING = ("batch_id string, now_us long, halt boolean, trig boolean, any_warn boolean, required long, "
                  "recal boolean, cool_us long")
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LadderProcessor(StatefulProcessor):
    """The ladder of one model: windows are decided one by one in the order of ``seq`` (1, 2,
    ...). One that comes before its turn waits in the state store, on disk, so what a
    worker holds is one Arrow batch, however large the backfill and whatever its order. A
    window whose number is done already (a repeated row) is passed over. With ``patience_ms``
    a timer gives a missing window up: the next that waits is decided instead."""

    def __init__(self, patience_ms: int | None = None):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.done = handle.getValueState("done", LADDER_DONE)
        self.waiting = handle.getMapState("waiting", "seq long", LADDER_WAITING)

    def _load(self) -> None:
        self.streak, self.last, self.due = self.done.get() if self.done.exists() else (0, None, 1)
        self.open = self.waiting.exists()

    def _decide(self, model: str, w: tuple) -> tuple:
        batch_id, now_us, halt, trig, any_warn, required, recal, cool_us = w
        seq, self.due = self.due, self.due + 1
        if halt:
            self.streak = 0
            return model, seq, batch_id, "HALT", 0, False
        self.streak = self.streak + 1 if trig else 0
        cold = self.last is not None and now_us - self.last < cool_us
        if not trig:
            action = "WATCH" if any_warn else "NO_ACTION"
        elif self.streak < required or cold:
            action = "WATCH"
        else:
            action = "RECALIBRATE_THRESHOLD" if recal else "RETRAIN"
        if action == "RETRAIN":
            self.last = now_us
        return model, seq, batch_id, action, self.streak, cold

    def _due_ones(self, model: str) -> Iterator[tuple]:
        """Decisions of the windows in the store whose turn it is."""
        while self.open and self.waiting.containsKey((self.due,)):
            w = self.waiting.getValue((self.due,))
            self.waiting.removeKey((self.due,))
            yield self._decide(model, tuple(w))

    def _keep(self, timers) -> None:
        self.done.update((self.streak, self.last, self.due))
        if self.patience_ms is not None and self.waiting.exists():
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.patience_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self._load()
        for pdf in rows:
            out = []
            for r in pdf.sort_values("seq").itertuples(index=False):
                w = (r.batch_id, int(r.now_us), bool(r.halt), bool(r.trig), bool(r.any_warn), int(r.required),
                     bool(r.recal), int(r.cool_us))
                if r.seq > self.due:
                    self.waiting.updateValue((int(r.seq),), w)
                    self.open = True
                elif r.seq == self.due:
                    out.append(self._decide(key[0], w))
                    out.extend(self._due_ones(key[0]))
            yield pd.DataFrame(out, columns=LADDER_NAMES)
        self._keep(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._load()
        out = []
        if self.open:
            self.due = min(k[0] for k in self.waiting.keys())
            out = list(self._due_ones(key[0]))
        self._keep(timerValues)
        yield pd.DataFrame(out, columns=LADDER_NAMES)

    def close(self) -> None:
        pass


LADDER_NAMES = ["model_version", "seq", "batch_id", "action", "confirmed_streak", "cooldown_active"]


def ladder_inputs(flags: DataFrame, policy: Policy) -> DataFrame:
    """Window-flag rows (from ``with_signals``) in the shape the stateful ladder reads."""
    recal = (F.lit(policy.prefer_recalibration) & F.col("drift_alert") & ~F.col("perf_alert")
             & ~F.col("pr_auc_alert"))
    return flags.select(
        "model_version", F.col("seq").cast("long"), "batch_id",
        F.unix_micros(F.col("now").cast("timestamp")).alias("now_us"), "halt",
        ((F.col("perf_alert") | F.col("drift_alert")) & ~F.col("halt")).alias("trig"), "any_warn",
        F.lit(policy.consecutive_windows_to_confirm).cast("long").alias("required"), recal.alias("recal"),
        F.lit(policy.cooldown_days * 86400 * 1_000_000).cast("long").alias("cool_us"))


def stateful_ladder(stream: DataFrame, patience_ms: int | None = None) -> DataFrame:
    """Streak and cooldown carried in a state processor per model version. The session is
    set to the state store that such processors need (running streams keep their own)."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return stream.groupBy("model_version").transformWithStateInPandas(
        statefulProcessor=LadderProcessor(patience_ms), outputStructType=LADDER_OUT, outputMode="append",
        timeMode="None" if patience_ms is None else "ProcessingTime")
