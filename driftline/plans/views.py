"""Views of the driver tables that the registered queries monitor: the scored
transactions over ``lineitem`` (with distortions written into some months), events
and documents. Nothing in the operators depends on them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.sources.tables import read_table

# Monitored features of the `txn` fixture view and its model threshold.
TXN_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TXN_THRESHOLD = 0.8
REFERENCE_END = "2000-01-01"          # reference slice: event_time before this
#: Events before this day are the reference of the daily queries.
EVENTS_REFERENCE_END = "2024-01-08"
# Distortions written into the fixture windows.
COVARIATE_MONTHS = ("2000-06", "2000-07", "2000-08", "2001-06")
CONCEPT_MONTHS = ("2000-11", "2000-12", "2001-01", "2001-02", "2001-03")
QUANTITY_SD = 14.43


def _txn_columns(li: DataFrame) -> DataFrame:
    ts = F.col("l_shipdate").cast("timestamp")
    score = F.round((F.col("l_quantity") / 50) * 0.5 + (F.col("l_discount") / 0.10) * 0.3
                    + (F.col("l_tax") / 0.08) * 0.2, 4)
    h = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17 + F.col("l_partkey") * 7) % 1000
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"),
        ts.alias("event_time"),
        F.date_format(ts, "yyyy-MM").alias("batch_id"),
        F.col("l_quantity").cast("double").alias("l_quantity"),
        F.col("l_extendedprice").cast("double").alias("l_extendedprice"),
        F.col("l_discount").cast("double").alias("l_discount"),
        F.col("l_tax").cast("double").alias("l_tax"),
        score.alias("score"),
        h.alias("h"))


def txn(spark: SparkSession, sf_dir: str, distort: bool = True) -> DataFrame:
    """The scored-transactions view over ``lineitem`` (one row per line):
    row_id, event_time, batch_id (yyyy-MM), 4 features, score, label, and the two
    challenger scores score2 (losing) and score3 (winning). Covariate and concept
    drift are written into some months when ``distort``."""
    base = _txn_columns(read_table(spark, sf_dir, "lineitem"))
    label = F.when(F.col("h") < F.when(F.col("score") >= 0.8, 900).otherwise(3), 1).otherwise(0)
    if distort:
        cov = F.col("batch_id").isin(*COVARIATE_MONTHS)
        con = F.col("batch_id").isin(*CONCEPT_MONTHS)
        qty = F.when(cov, F.col("l_quantity") * 1.525 + 1.5 * QUANTITY_SD).otherwise(F.col("l_quantity"))
        price = F.when(cov, F.col("l_extendedprice") * 2).otherwise(F.col("l_extendedprice"))
        label = F.when(con, F.when(F.col("h") < 48, 1).otherwise(0)).otherwise(label)
    else:
        qty, price = F.col("l_quantity"), F.col("l_extendedprice")
    out = base.select(
        "row_id", "event_time", "batch_id", qty.alias("l_quantity"), price.alias("l_extendedprice"),
        "l_discount", "l_tax", "score", label.cast("int").alias("label"), "h")
    score3 = F.round(F.when(F.col("label") == 1, F.least(F.lit(1.0), F.col("score") + 0.05))
                     .otherwise(F.col("score")), 4)
    return out.select("*", F.round(F.col("score") * 0.95, 5).alias("score2"), score3.alias("score3"))


def txn_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn(spark, sf_dir).where(F.col("event_time") < F.lit(REFERENCE_END).cast("timestamp"))


def txn_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn(spark, sf_dir).where(F.col("event_time") >= F.lit(REFERENCE_END).cast("timestamp"))


def events_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a scored stream: feature ``value``, score value/(value+50),
    label ``event_type = 'error'``, daily batch ids."""
    return events_view(read_table(spark, sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a file stream over the table's files."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # a pattern: the table may be one file, and a file stream takes folders or patterns
    return events_view(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


def events_view(ev: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        F.col("event_id").cast("string").alias("row_id"), ts.alias("event_time"),
        F.date_format(ts, "yyyy-MM-dd").alias("batch_id"), F.col("value").cast("double").alias("value"),
        F.round(F.col("value") / (F.col("value") + 50), 4).alias("score"),
        (F.col("event_type") == "error").cast("int").alias("label"))


def documents_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` left join ``labels``: score n_chars/(n_chars+1500), label
    ``toxic`` (NULL where no label arrived)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return (docs.join(labels, "doc_id", "left")
            .select(F.col("doc_id").cast("string").alias("row_id"), "lang", "source",
                    F.col("n_chars").cast("double").alias("n_chars"),
                    F.round(F.col("n_chars") / (F.col("n_chars") + 1500.0), 4).alias("score"),
                    F.col("toxic").cast("int").alias("label")))
