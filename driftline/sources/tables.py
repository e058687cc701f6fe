"""Readers (S1)."""
from __future__ import annotations

import os
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def batch_schema(features: Sequence[str], time: str | None = "Time", label: str | None = "Class") -> StructType:
    """Schema of a batch file: doubles for time and features, an int label. Given to
    load_batch, a CSV is read once; without it, types are inferred in a scan before."""
    names = [*([time] if time else []), *features]
    return StructType([StructField(n, DoubleType()) for n in names]
                      + ([StructField(label, IntegerType())] if label else []))


def load_batch(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """``.parquet``/``.pq`` -> Parquet, any other suffix -> CSV with a header."""
    suffix = Path(path).suffix.lower()
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if suffix in (".parquet", ".pq"):
        return reader.parquet(path)
    if schema is None:
        reader = reader.option("inferSchema", "true")
    return reader.option("header", "true").csv(path)
