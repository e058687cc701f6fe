"""Integer vectors for the operators on embeddings: which rows are usable, how components
become integers, and sums over batches of rows."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integer components may reach this size; squared distances then fit into 64 bits.
LARGEST = 1 << 26


def usable(vector: Column) -> Column:
    """Not null, and no component null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def integers(vectors, length: int, scale: int, largest: int = LARGEST) -> np.ndarray:
    """floor(scale * component), components as doubles, of usable vectors of one length: a
    matrix of 64-bit integers. ``vectors`` is an Arrow list array or a list of lists."""
    if isinstance(vectors, pa.Array):
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
    else:
        flat = np.array(vectors, dtype="float64")
    made = np.floor(flat.reshape(-1, length) * float(scale))
    if made.size and max(made.max(), -made.min()) > largest:
        raise ValueError(f"a component times {scale} is over {largest}: squared distances would leave 64 bits")
    return made.astype("int64")


def group_sums(batches: Iterator[tuple[np.ndarray, np.ndarray]], groups: int, width: int) -> pa.RecordBatch:
    """(grp, n, sums) of rows (group of each row, integer matrix): one row for each group met."""
    n, sums = np.zeros(groups, "int64"), np.zeros((groups, width), "int64")
    for at, x in batches:
        n += np.bincount(at, minlength=groups)
        order = np.argsort(at, kind="stable")
        here, starts = np.unique(at[order], return_index=True)
        if len(here):
            sums[here] += np.add.reduceat(x[order], starts, axis=0)
    met = np.flatnonzero(n)
    return pa.RecordBatch.from_arrays(
        [pa.array(met.astype("int32")), pa.array(n[met]), pa.array(list(sums[met]), pa.list_(pa.int64()))],
        names=["grp", "n", "sums"])


SUMS = "grp int, n bigint, sums array<bigint>"


def floor_means(parts: DataFrame) -> dict[int, np.ndarray]:
    """{group: componentwise floor(sum / count)} of the rows of group_sums() of all tasks. The
    result has as many rows as there are groups (a parameter), whatever the input's size."""
    total = parts.select("grp", "n", F.posexplode("sums").alias("i", "s")).groupBy("grp", "i").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"))
    made: dict[int, dict[int, int]] = {}
    for r in total.collect():
        made.setdefault(r.grp, {})[r.i] = r.s // r.n
    return {g: np.array([c[i] for i in range(len(c))], "int64") for g, c in made.items()}


def joined_integers(rows: np.ndarray) -> str:
    return ",".join(map(str, rows.ravel().tolist()))
