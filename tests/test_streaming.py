"""Structured Streaming forms: file windows (W1), event-time days (W2) and
the stateful ladder (W4) equal to the batch fold."""
import os
import tempfile

from pyspark.sql import functions as F

from driftline.plans.fixture import txn_fixture
from driftline.plans.monitor import literal_policy, month_start, monitor, window_report, with_signals
from driftline.operators.decision import decide
from driftline.plans.views import events_scored
from driftline.streaming.stream import daily_bins, daily_windows, ladder_inputs, late_labels, monitor_files, stateful_ladder
from tests.conftest import SF01


def test_file_windows_processed_once(spark):
    fx = txn_fixture(spark, SF01)
    src = tempfile.mkdtemp(prefix="dl-src-")
    months = ["2000-01", "2000-02", "2000-03"]
    cols = ["row_id", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "score", "label"]
    for m in months:
        fx.windows.where(F.col("batch_id") == m).select(*cols).toPandas().to_parquet(
            os.path.join(src, f"{m}.parquet"))
    schema = fx.windows.select(*cols).schema
    ck, out = tempfile.mkdtemp(prefix="dl-ck-"), tempfile.mkdtemp(prefix="dl-out-")
    monitor_files(spark, src, schema, fx.profile, fx.policy, fx.threshold, ck, out)
    reps = spark.read.parquet(out)
    assert sorted(r.batch_id for r in reps.select("batch_id").collect()) == months
    batch = window_report(fx.windows.where(F.col("batch_id").isin(*months)), fx.profile, fx.policy,
                          fx.threshold)
    want = {r.batch_id: (r.n_rows, round(r.max_psi, 9), r.perf_status) for r in batch.collect()}
    got = {r.batch_id: (r.n_rows, round(r.max_psi, 9), r.perf_status) for r in reps.collect()}
    assert got == want
    # with the ladder: decisions equal the batch pass, state carried from epoch to epoch
    ck2, out2, dec = (tempfile.mkdtemp(prefix=f"dl-{x}-") for x in ("ck2", "out2", "dec"))
    dec = os.path.join(dec, "decisions")
    monitor_files(spark, src, schema, fx.profile, fx.policy, fx.threshold, ck2, out2, decisions_dir=dec, now=month_start())
    want = {r.batch_id: (r.action, r.confirmed_streak) for r in monitor(
        fx.windows.where(F.col("batch_id").isin(*months)), fx.profile, fx.policy, fx.threshold, now=month_start()).collect()}
    assert {r.batch_id: (r.action, r.confirmed_streak) for r in spark.read.parquet(dec).collect()} == want
    nested = spark.read.parquet(out2).first()
    assert len(nested.features) == 4 and nested.decision.action == want[nested.batch_id][0]
    # a second run over the same checkpoint finds no new file
    monitor_files(spark, src, schema, fx.profile, fx.policy, fx.threshold, ck, out)
    assert spark.read.parquet(out).count() == 3


def test_late_labels_keep_the_newest_and_wait(spark):
    scores = spark.createDataFrame([("a", "b1", "2025-01-01", 0.9), ("b", "b1", "2025-01-05", 0.1),
                                    ("c", "b2", "2025-02-20", 0.5)], "k string, batch_id string, ts string, score double")
    labels = spark.createDataFrame([("a", 0, 1), ("a", 1, 2), ("c", 1, 1)], "k string, label int, at int")
    got = late_labels(scores, labels, "k", "ts", F.lit("2025-03-01 00:00:00"), 30, arrived="at").collect()
    assert sorted((r.k, r.label) for r in got) == [("a", 1), ("b", None)]


def test_daily_windows_watermark_holds_back_open_days(spark):
    src = tempfile.mkdtemp(prefix="dl-ev-")
    events_scored(spark, SF01).write.parquet(os.path.join(src, "part"))
    schema = spark.read.parquet(os.path.join(src, "part")).schema
    stream = spark.readStream.schema(schema).parquet(os.path.join(src, "part"))
    q = (daily_windows(stream, "event_time", "value", "score", "label", 0.2)
         .writeStream.outputMode("append").format("memory").queryName("daily_w2").start())
    q.processAllAvailable()
    q.stop()
    out = spark.sql("SELECT * FROM daily_w2")
    assert out.count() == 28
    assert out.agg(F.sum("n_events")).first()[0] == 9326


def test_daily_bins_count_late_rows_and_equal_the_batch(spark):
    from driftline.operators.drift import feature_drift
    from driftline.operators.profile import build_profile
    from driftline.plans.policy import Policy
    ref = spark.range(500).select((F.col("id") % 50).cast("double").alias("a"), F.rand(3).alias("b"))
    prof = build_profile(ref, ["a", "b"], 0.5, "m", label_col=None, baseline=False).frozen()
    rows = spark.range(400).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=(F.col("id") / 4).cast("int"))).alias("ts"),
        F.when(F.col("id") % 9 == 0, float("nan")).otherwise((F.col("id") % 60).cast("double")).alias("a"), F.rand(5).alias("b"))
    rows = rows.select("*", F.date_format("ts", "yyyy-MM-dd").alias("batch_id")).cache()      # 4 days and 4 hours
    src = tempfile.mkdtemp(prefix="dl-bins-")
    late = F.col("batch_id") == "2024-01-02"
    rows.where((F.col("batch_id") < "2024-01-04") & ~(late & (F.col("a") < 10))).coalesce(1).write.parquet(src + "/one")
    stream = spark.readStream.schema(rows.schema).parquet(src + "/*")
    q = (daily_bins(stream, "ts", ["a", "b"], prof, Policy(), "47 hours").writeStream.outputMode("append").format("memory")
         .queryName("bins_w2").option("checkpointLocation", tempfile.mkdtemp()).start())
    q.processAllAvailable()                     # watermark at the first day's end: only that is closed
    assert {r.day for r in spark.table("bins_w2").collect()} == {"2024-01-01"}
    # rows of the second day come late, but within the watermark; one of the first comes after its day
    more = rows.where((F.col("batch_id") >= "2024-01-04") | (late & (F.col("a") < 10)))
    gone = rows.limit(1).withColumn("ts", F.lit("2024-01-01 05:00:00").cast("timestamp"))
    more.unionByName(gone).coalesce(1).write.parquet(src + "/two")
    q.processAllAvailable()
    q.stop()
    got = {(r.day, r.feature): r for r in spark.table("bins_w2").collect()}
    want = {(r.batch_id, r.feature): r for r in feature_drift(rows, prof, Policy(), with_ks=False).collect()}
    assert set(got) == {(d, f) for d in ("2024-01-01", "2024-01-02") for f in "ab"}
    for k, r in got.items():
        assert abs(r.psi - want[k].psi) < 1e-9 and r.psi_level == want[k].psi_level
        assert sum(r.bin_counts) == r.n_finite <= r.n_rows == 96


def test_stateful_ladder_equals_batch_fold(spark):
    fx = txn_fixture(spark, SF01)
    rep = window_report(fx.windows, fx.profile, fx.policy, fx.threshold)
    p = literal_policy(fx.policy)
    flags = with_signals(rep, p).select("*", month_start().alias("now"))
    from pyspark.sql import Window
    flags = flags.select("*", F.row_number().over(Window.partitionBy("model_version")
                                                  .orderBy("now", "batch_id")).alias("seq"))
    want = {r.batch_id: (r.action, r.confirmed_streak, r.cooldown_active)
            for r in decide(flags, ["model_version"], p).collect()}
    src = tempfile.mkdtemp(prefix="dl-flags-")
    inputs = ladder_inputs(flags, fx.policy)
    # two arrivals: the state must carry the streak and the last retrain across them
    inputs.where("seq <= 11").write.parquet(os.path.join(src, "a"))
    stream = spark.readStream.schema(inputs.schema).parquet(src + "/*")
    q = (stateful_ladder(stream).writeStream.outputMode("append").format("memory")
         .queryName("ladder_w4").option("checkpointLocation", tempfile.mkdtemp()).start())
    q.processAllAvailable()
    inputs.where("seq > 11").write.parquet(os.path.join(src, "b"))
    q.processAllAvailable()
    q.stop()
    got = {r.batch_id: (r.action, r.confirmed_streak, r.cooldown_active)
           for r in spark.sql("SELECT * FROM ladder_w4").collect()}
    assert got == want


def test_ladder_takes_windows_in_any_order_and_restarts(spark):
    import random

    from driftline.streaming.stream import LADDER_IN
    rnd, day = random.Random(3), 86_400_000_000
    rows = [("m" if i % 3 else "n", 0, f"w{i}", i * day, rnd.random() < 0.1, rnd.random() < 0.6, rnd.random() < 0.5, 2,
             rnd.random() < 0.2, 7 * day) for i in range(1500)]
    seq = {"m": 0, "n": 0}
    for k, r in enumerate(rows):
        seq[r[0]] += 1
        rows[k] = (r[0], seq[r[0]], *r[2:4], r[4], r[5] and not r[4], *r[6:])
    want, state = {}, {"m": (0, None), "n": (0, None)}
    for model, n, batch, now, halt, trig, warn, need, recal, cool in rows:
        streak, last = state[model]
        streak = streak + 1 if trig else 0
        cold = not halt and last is not None and now - last < cool
        action = ("HALT" if halt else "WATCH" if trig and (streak < need or cold) else "RECALIBRATE_THRESHOLD" if trig and recal
                  else "RETRAIN" if trig else "WATCH" if warn else "NO_ACTION")
        state[model] = (streak, now if action == "RETRAIN" else last)
        want[batch] = (action, streak, cold)
    rnd.shuffle(rows)
    src, out, ck = (tempfile.mkdtemp(prefix=f"dl-{x}-") for x in ("ladder", "out", "ck"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")      # many batches for each model
    try:
        for name, part in (("a", rows[:900]), ("b", rows[900:] + rows[:20])):    # a restart between, and repeated rows
            spark.createDataFrame(part, LADDER_IN).coalesce(1).write.parquet(os.path.join(src, name))
            stream = spark.readStream.schema(LADDER_IN).parquet(src + "/*")
            stateful_ladder(stream).writeStream.format("parquet").option("path", out).option(
                "checkpointLocation", ck).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = spark.read.parquet(out).collect()
    assert len(got) == 1500 and {r.batch_id: (r.action, r.confirmed_streak, r.cooldown_active) for r in got} == want


def test_label_stream_equals_the_batch_join_and_drops_its_state(spark):
    import datetime as dt

    from driftline.streaming.stream import late_labels_stream, newest_labels
    t = lambda day, hour=0: dt.datetime(2024, 3, day, hour)
    scores = [("a", "b1", t(1), 0.9), ("b", "b1", t(1), 0.1), ("c", "b2", t(2), 0.5), ("z", "b9", t(20), 0.5)]
    labels = [("a", 0, t(2)), ("a", 1, t(3)), ("c", 1, t(9)), ("c", 1, t(1)), ("z", 0, t(20, 1))]
    s_schema, l_schema = "k string, batch_id string, ts timestamp, score double", "k string, label int, at timestamp"
    s_dir, l_dir, out = (tempfile.mkdtemp(prefix=f"dl-{x}-") for x in ("scores", "labels", "joined"))
    made = late_labels_stream(spark.readStream.schema(s_schema).parquet(s_dir + "/*"),
                              spark.readStream.schema(l_schema).parquet(l_dir + "/*"), "k", "ts", "at", "5 days", slack="1 day")
    q = (made.writeStream.format("parquet").option("path", out).option("checkpointLocation", tempfile.mkdtemp()).start())
    spark.createDataFrame(scores[:3], s_schema).write.parquet(s_dir + "/one")
    spark.createDataFrame(labels[:1], l_schema).write.parquet(l_dir + "/one")
    q.processAllAvailable()
    spark.createDataFrame(labels[1:4], l_schema).write.parquet(l_dir + "/two")     # the newer label comes in a later batch
    q.processAllAvailable()
    spark.createDataFrame(scores[3:], s_schema).write.parquet(s_dir + "/two")
    spark.createDataFrame(labels[4:], l_schema).write.parquet(l_dir + "/three")
    q.processAllAvailable()
    kept = sum(x.numRowsTotal for x in q.lastProgress.stateOperators) if q.lastProgress else None
    q.stop()
    rows = newest_labels(spark.read.schema(made.schema).parquet(out), "k")
    # c's labels come before its score and after the delay: it has none
    assert {r.k: (r.batch_id, r.label) for r in rows.collect()} == {"a": ("b1", 1), "b": ("b1", None), "c": ("b2", None),
                                                                    "z": ("b9", 0)}
    assert kept is None or kept <= 2          # only z and its label are still held
