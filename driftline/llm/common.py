"""Shared helpers: reading tables, Arrow batches, bounded connected components."""
from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.session import freeze

#: Bytes handed to a Python worker at once. Texts can be 100 kB and more, so Spark's
#: default of 10,000 rows a batch would not bound a worker's memory.
BATCH_BYTES = 2 << 20

#: Every character that separates words in the contracts: space and \t to \r.
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per Spark context: Spark
    serves the archive to them; its place is a folder of the driver's alone."""
    sc = spark.sparkContext
    if getattr(sc, "_driftline_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="driftline-py-"), "driftline_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._driftline_shipped = True


def map_in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                 schema) -> DataFrame:
    """mapInArrow with batches of bounded size and this package on the workers."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def map_columns(df: DataFrame, inputs: list[str], outputs: list[T.StructField], keep: list[str],
                make: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """Append columns computed row by row in Arrow batches.

    ``make()`` runs once per task and returns ``fn(*inputs) -> tuple`` (one value
    per output). Columns in ``keep`` pass through untouched. Rows are read from
    the batch one at a time, so a worker holds one batch, not a partition."""
    src = df.select(*keep, *[F.col(c).alias(f"__in{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([src.schema[c] for c in keep] + outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type
        fn = make()
        kinds = [to_arrow_type(f.dataType) for f in outputs]
        names = keep + [f.name for f in outputs]
        for b in batches:
            cols = [b.column(len(keep) + i) for i in range(len(inputs))]
            made: list[list] = [[] for _ in outputs]
            for i in range(b.num_rows):
                for out, v in zip(made, fn(*[c[i].as_py() for c in cols])):
                    out.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(keep))]
                + [pa.array(v, type=k) for v, k in zip(made, kinds)], names=names)

    return map_in_arrow(src, run, schema)


def masked(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows under column names that nothing added can clash with, and {name: masked name}."""
    names = {c: f"__doc{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def unmasked(names: dict[str, str]) -> list[Column]:
    return [F.col(n).alias(c) for c, n in names.items()]


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n`` (null keys: of the empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, root), root the
    smallest node reachable. Nodes are any orderable type.

    Alternating large-star and small-star steps: every step only re-points an
    edge at a smaller neighbour, computed as a per-node minimum (combined before
    the shuffle), so a node with millions of neighbours is never gathered in one
    task. Each round is written to the shared folder, which cuts the lineage."""
    spark = edges.sparkSession
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = freeze(e.distinct(), f"{name}-edges")
    for i in range(max_rounds):
        # large star: neighbours larger than u point at the smallest of u's neighbourhood
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        big = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: the smaller neighbours of u (and u) point at the smallest of them
        big = big.filter("a <> b").distinct()
        low2 = big.groupBy("a").agg(F.min("b").alias("m"))
        small = big.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low2.select("a", F.col("m").alias("b")))
        nxt = freeze(small.filter("a <> b").distinct(), f"{name}-round{i}")
        # a star forest: every node has one parent and no parent has a parent
        after = nxt.agg(F.count("*").alias("n"), F.count_distinct("a").alias("d")).first()
        if after.n == after.d and nxt.join(nxt.select(F.col("a").alias("b")).distinct(), "b", "left_semi") \
                .limit(1).count() == 0:
            e = nxt
            break
        e = nxt
    else:
        raise RuntimeError(f"components of {name} did not converge in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
