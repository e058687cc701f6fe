"""Sinks (S2-S6): profile tables, JSON reports with non-finite values as
null, decision history, sweep + proposal, promotion audit records."""
from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from driftline.functions.columns import nan_to_null
from driftline.operators.profile import Profile


def write_profile(profile: Profile, path: str, mode: str = "overwrite") -> str:
    """The three profile tables, partitioned by model version."""
    for name, df in (("features", profile.features), ("ks", profile.ks), ("model", profile.model)):
        (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy("model_version").parquet(os.path.join(path, name)))
    meta = profile.features.sparkSession.createDataFrame(
        [(profile.model_version, ",".join(profile.feature_names), profile.bins)],
        "model_version string, features string, bins int")
    meta.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
        "model_version").parquet(os.path.join(path, "meta"))
    return path


def read_profile(spark: SparkSession, path: str, model_version: str) -> Profile:
    """A missing profile is an error, not an empty table."""
    try:
        meta = spark.read.parquet(os.path.join(path, "meta")).where(
            F.col("model_version") == model_version).first()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        meta = None
    if meta is None:
        raise FileNotFoundError(f"{path} holds no profile of model {model_version}")

    def part(name):
        return spark.read.parquet(os.path.join(path, name)).where(F.col("model_version") == model_version)
    return Profile(model_version, meta["features"].split(","), int(meta["bins"]),
                   part("features"), part("ks"), part("model"))


def _null_nonfinite(dt: T.DataType, c):
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return nan_to_null(c)
    if isinstance(dt, T.StructType):
        return F.struct(*[_null_nonfinite(f.dataType, c[f.name]).alias(f.name) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _null_nonfinite(dt.elementType, x))
    return c


def nonfinite_to_null(df: DataFrame) -> DataFrame:
    """S3: NaN and +/-inf become null, recursively through structs and arrays."""
    return df.select(*[_null_nonfinite(f.dataType, F.col(f"`{f.name}`")).alias(f.name)
                       for f in df.schema.fields])


def write_json_report(report: DataFrame, path: str, mode: str = "append") -> str:
    """S3: JSON lines with every key kept (nulls written)."""
    nonfinite_to_null(report).write.mode(mode).option("ignoreNullFields", "false").json(path)
    return path


def write_run(rows: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> str:
    """The rows of one run, in a folder of this attempt. The attempt counts only once its
    entry under ``runs`` is appended, which comes last, and the latest entry of a run is the
    one that is read: a run that ends half-way leaves what was there before, and a
    repetition replaces the run's rows. Replaced attempts stay on disk until removed."""
    attempt = uuid.uuid4().hex
    rows = rows.withColumns({"run_id": F.lit(run_id), "attempt": F.lit(attempt)})
    writer = rows.write.mode("errorifexists")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(fmt).save(os.path.join(path, "data", f"part={attempt}"))
    rows.sparkSession.createDataFrame([(run_id, attempt, time.time_ns())], RUNS_SCHEMA).coalesce(1).write.mode(
        "append").parquet(os.path.join(path, "runs"))
    return path


RUNS_SCHEMA = "run_id string, attempt string, committed_ns long"


def read_runs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The rows of the latest committed attempt of every run, with their ``run_id``."""
    rows = spark.read.format(fmt).load(os.path.join(path, "data"))
    latest = spark.read.schema(RUNS_SCHEMA).parquet(os.path.join(path, "runs")).groupBy("run_id").agg(
        F.max_by("attempt", "committed_ns").alias("attempt"))
    return rows.join(latest, ["run_id", "attempt"], "left_semi").select(
        *[c for c in rows.columns if c not in ("attempt", "part")])


def append_decisions(decisions: DataFrame, path: str, run_id: str | None = None) -> str:
    """Decisions are an append-only table; HALT rows carry in_history=false. With a
    ``run_id`` the run can be repeated (write_run; read with read_runs)."""
    if run_id is not None:
        return write_run(decisions, path, run_id)
    decisions.write.mode("append").parquet(path)
    return path


def read_state(decisions: DataFrame, keys=("model_version",)) -> DataFrame:
    """What stored decisions leave to the next run, one row per model: streak, last
    retrain and last number. Decisions are in order of window time."""
    last = F.max_by(F.struct("confirmed_streak", "last_retrain_at"), F.struct("now", "seq"))
    return decisions.groupBy(*keys).agg(last.alias("_s"), F.max("seq").alias("last_seq")).select(
        *keys, F.col("_s.confirmed_streak").alias("streak"), F.col("_s.last_retrain_at").alias("last_retrain_at"),
        "last_seq")


def history_tail(decisions: DataFrame, keys=("model_version",), n: int = 50) -> DataFrame:
    """The last ``n`` history rows per model by window time (HALT windows excluded)."""
    w = Window.partitionBy(*keys).orderBy(F.col("now").desc(), F.col("seq").desc())
    return (decisions.where("in_history").select("*", F.row_number().over(w).alias("pos"))
            .where(F.col("pos") <= n))


def write_sweep(sweep: DataFrame, proposal: DataFrame, out_dir: str) -> str:
    """The sweep as CSV with a header and the one-row proposal as JSON; the
    live threshold is not touched."""
    sweep.coalesce(1).write.mode("overwrite").option("header", "true").csv(
        os.path.join(out_dir, "threshold_sweep"))
    proposal.select("*", F.current_timestamp().alias("proposed_at")).coalesce(1).write.mode(
        "overwrite").json(os.path.join(out_dir, "threshold"))
    return out_dir


def write_promotion_record(result: DataFrame, checks: DataFrame, metrics: DataFrame, path: str,
                           champion_version: str, challenger_version: str,
                           keys=("challenger",), run_id: str | None = None) -> str:
    """One audit row per gate decision (promote or reject), with the
    checks and both metric rows nested. With a ``run_id`` the run can be repeated
    (write_run; read with read_runs as JSON)."""
    k = list(keys)
    nested_checks = checks.groupBy(*k).agg(F.array_sort(F.collect_list(
        F.struct("check_order", "name", "passed", "value", "threshold", "detail"))).alias("checks"))
    nested_metrics = metrics.groupBy(*k).agg(F.collect_list(F.struct(*[c for c in metrics.columns
                                                                     if c not in k])).alias("metrics"))
    rec = (result.join(nested_checks, k).join(nested_metrics, k)
           .select(F.current_timestamp().alias("decided_at"), F.lit(champion_version).alias("champion_version"),
                   F.lit(challenger_version).alias("challenger_version"), "*"))
    rec = nonfinite_to_null(rec)
    if run_id is not None:
        return write_run(rec, path, run_id, "json")
    rec.write.mode("append").option("ignoreNullFields", "false").json(path)
    return path
