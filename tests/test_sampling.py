"""Seeded sampling: exact sizes, no bias by value, independent of partitioning."""
import hashlib

import pytest
from pyspark.sql import functions as F

from driftline.operators.sampling import hash_sample, sample_rows


def test_sample_is_exact_and_spreads_like_its_input(spark):
    df = spark.range(40_000).select(F.col("id").cast("string").alias("row_id"), (F.col("id") % 10).cast("double").alias("v"),
                                    F.when(F.col("id") < 30_000, "hot").when(F.col("id") < 39_995, "warm")
                                    .otherwise("cold").alias("g"))
    got = hash_sample(df, ["g"], 1000).toPandas()
    assert got.groupby("g").size().to_dict() == {"hot": 1000, "warm": 1000, "cold": 5}
    assert got[got.g == "hot"].v.value_counts().min() > 60
    again = hash_sample(df.repartition(13), ["g"], 1000).toPandas()
    assert set(again.row_id) == set(got.row_id)
    want = sorted((str(i) for i in range(30_000)), key=lambda k: hashlib.md5(f"{k}hot42".encode()).hexdigest())[:1000]
    assert set(got[got.g == "hot"].row_id) == set(want)


def test_sampling_needs_a_row_key(spark):
    with pytest.raises(ValueError, match="row_id"):
        hash_sample(spark.range(5).withColumnRenamed("id", "x"), [], 2)


def test_sample_rows(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("row_id"))
    assert sample_rows(df, 50).count() == 50 and sample_rows(df, 500).count() == 300 and sample_rows(df, 0).count() == 0
