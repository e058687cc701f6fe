"""Session helpers: one place that knows the configs the library relies on."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "driftline") -> SparkSession:
    """Local/test session. On a cluster, build the session the cluster way and
    only call :func:`ensure_checkpoint_dir` on it."""
    master = master or os.environ.get("DRIFTLINE_MASTER", "local[*]")
    cpus = os.cpu_count() or 8
    parts = shuffle_partitions or int(os.environ.get("DRIFTLINE_SHUFFLE_PARTITIONS", cpus))
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("DRIFTLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when
    the session has none and everything runs on this machine (tests)."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="driftline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


#: Tables written by freeze(), by Spark application.
_FROZEN: dict[str, list[str]] = {}


def drop_frozen(spark: SparkSession) -> int:
    """Delete the tables that this application froze (their readers must be done) and
    return their number. Each has a name of its own, so nothing else is touched."""
    paths = _FROZEN.pop(spark.sparkContext.applicationId, [])
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the session's checkpoint folder and
    read it back: cuts lineage and survives executor loss (unlike local
    checkpoints)."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    _FROZEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
