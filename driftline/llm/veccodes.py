"""Operator 13: vector codes (product quantisation) by slice-and-intersect bitmasks.

A vector is cut into equal parts, and each part is replaced by the number of the nearest
entry of its codebook. To find it without comparing all entries, the entries of a codebook
are sorted along every dimension, and position p of that order carries the set of the first
p entries as a mask of uint64 words. The entries whose coordinate lies within r of a value
are then two binary searches and one ``mask[high] & ~mask[low]``; the AND over the
dimensions is the set of entries in the box of radius r.

The first radius is half the usual gap between entries; where the box is empty it doubles.
The best entry of the box has a distance D, and the box of radius sqrt(D) holds every entry
as near as that: its members are exact candidates, compared in integers, ties to the lower
index. Nothing is lost, whatever the data; isotropic data only make the boxes fuller.

Codebooks are parts x entries x (length / parts) integers (parameters), sent with the tasks.
Each round reads the vectors once, and a task returns one sum and count for each entry, so
nothing is shuffled but those; equal vectors never meet.

Cases: rows whose vector is null or holds a null or non-finite component are dropped; a
vector of another length than most (of equally many, the longer) stays, with a null code
and error; a null id is kept and sorts last among the ids; repeated rows are rows of their
own (equal ids in the order of their vectors); fewer than 256 vectors give fewer entries; an
empty table gives no rows; columns not named are ignored. A usual length that the parts
don't divide is an error, and so are components too large for 64-bit distances."""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm import vectors as V
from driftline.llm.common import map_in_arrow
from driftline.session import freeze

#: Vectors whose candidates are compared at a time.
CHUNK = 512
#: A label with more than this share of the rows is joined by broadcast (so at most 256 are).
HOT_SHARE = 256


class Slices:
    """A codebook with sorted coordinates and prefix masks for every dimension."""

    def __init__(self, book: np.ndarray):
        m, d = book.shape
        self.book, words = book, (m + 63) // 64
        order = np.argsort(book, axis=0, kind="stable")
        self.sorted = [np.ascontiguousarray(book[order[:, j], j]) for j in range(d)]
        one = np.zeros((m, words), "uint64")
        one[np.arange(m), np.arange(m) // 64] = np.uint64(1) << (np.arange(m) % 64).astype("uint64")
        none = np.zeros((1, words), "uint64")
        self.prefix = [np.concatenate([none, np.bitwise_or.accumulate(one[order[:, j]], axis=0)]) for j in range(d)]
        self.radius = max(1, self._gap() // 2)

    def _gap(self) -> int:
        """Median over the entries of the largest coordinate difference to the nearest other entry."""
        nearest = []
        for row in self.book:
            away = np.abs(self.book - row).max(axis=1)
            away = away[away > 0]
            if len(away):
                nearest.append(int(away.min()))
        return int(np.median(nearest)) if nearest else 1

    def box(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks (n, words) of the entries within ``radius`` of each row in every dimension."""
        inside = None
        for j, (values, masks) in enumerate(zip(self.sorted, self.prefix)):
            low = np.searchsorted(values, x[:, j] - radius, "left")
            high = np.searchsorted(values, x[:, j] + radius, "right")
            here = masks[high] & ~masks[low]
            inside = here if inside is None else inside & here
        return inside

    def best(self, x: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of the nearest member of each row's mask (not empty)."""
        m = len(self.book)
        member = np.unpackbits(masks.view("uint8"), axis=1, bitorder="little")[:, :m]
        row, entry = np.nonzero(member)
        away = x[row] - self.book[entry]
        key = np.einsum("nd,nd->n", away, away) * m + entry        # ties: the lower entry
        starts = np.searchsorted(row, np.arange(len(x)))
        low = np.minimum.reduceat(key, starts)
        return low % m, low // m

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        entry, dist = np.empty(len(x), "int64"), np.empty(len(x), "int64")
        for at in range(0, len(x), CHUNK):
            rows = x[at:at + CHUNK]
            radius = np.full(len(rows), self.radius, "int64")
            masks = self.box(rows, radius)
            while len(empty := np.flatnonzero(~masks.any(axis=1))):
                radius[empty] *= 2
                masks[empty] = self.box(rows[empty], radius[empty])
            e, d = self.best(rows, masks)
            wide = np.sqrt(d.astype("float64")).astype("int64") + 1   # at least the root of d
            more = np.flatnonzero(wide > radius)
            if len(more):
                e[more], d[more] = self.best(rows[more], self.box(rows[more], wide[more]))
            entry[at:at + CHUNK], dist[at:at + CHUNK] = e, d
        return entry, dist


def _largest(width: int, entries: int) -> int:
    """The largest component for which width * (2 component)^2 * entries fits into 63 bits."""
    return int(((1 << 62) / max(1, width * entries * 4)) ** 0.5)


def encode(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", keep: list[str] | None = None,
           parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, np.ndarray | None]:
    """(id, columns of ``keep``, code, error) of every row with a usable vector, and the final
    codebooks as integers (parts, entries, width). ``keep`` can't name ``code`` or ``error``."""
    keep = [c for c in keep or [] if c != id_col]
    if {"code", "error"} & {id_col, *keep}:
        raise ValueError("code and error are columns of the result")
    spark = rows.sparkSession
    kept = rows.select(id_col, *keep, vector).where(V.usable(F.col(vector)))
    schema = T.StructType([kept.schema[c] for c in (id_col, *keep)] + [
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    usual = kept.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n")).orderBy(
        F.col("n").desc(), F.col("d").desc()).first()
    if usual is None:
        return spark.createDataFrame([], schema), None
    length = usual.d
    if length % parts or not length:
        raise ValueError(f"vectors of {length} components can't be cut into {parts} equal parts")
    width, largest = length // parts, _largest(length // parts, entries)
    fits = kept.where(F.size(vector) == length)
    first = fits.orderBy(F.col(id_col).asc_nulls_last(), vector).limit(entries).collect()   # at most 256 rows
    books = V.integers([r[vector] for r in first], length, scale, largest).reshape(-1, parts, width).transpose(1, 0, 2)
    m = books.shape[1]

    def summed(books: np.ndarray):
        def run(batches):
            slices = [Slices(b) for b in books]

            def assigned():
                for b in batches:
                    x = V.integers(b.column(0), length, scale, largest).reshape(-1, parts, width)
                    for p, s in enumerate(slices):
                        part = np.ascontiguousarray(x[:, p])
                        yield p * m + s.nearest(part)[0], part

            yield V.group_sums(assigned(), parts * m, width)
        return run

    for _ in range(rounds):
        means = V.floor_means(map_in_arrow(fits.select(vector), summed(books), V.SUMS))
        books = np.array([[means.get(p * m + i, c) for i, c in enumerate(book)] for p, book in enumerate(books)])

    def last(batches):
        slices = [Slices(b) for b in books]
        names = schema.fieldNames()
        for b in batches:
            vectors = b.column(b.num_columns - 1)
            sizes = np.asarray(pa.compute.list_value_length(vectors))
            ok = np.flatnonzero(sizes == length)
            x = V.integers(vectors.take(pa.array(ok)), length, scale, largest).reshape(-1, parts, width)
            found = [s.nearest(np.ascontiguousarray(x[:, p])) for p, s in enumerate(slices)]
            code, error = [None] * b.num_rows, [None] * b.num_rows
            total = sum(d for _, d in found)
            for i, at in enumerate(ok.tolist()):
                code[at] = "".join(f"{int(e[i]):02x}" for e, _ in found)
                error[at] = int(total[i])
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(b.num_columns - 1)]
                + [pa.array(code, pa.string()), pa.array(error, pa.int64())], names=names)

    return map_in_arrow(kept, last, schema), books


def label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` (a written table) with label_error, the sum of ``error`` over the rows of equal
    label. Labels with over 1/256 of the rows (so fewer than 256 of them) are joined by
    broadcast; the rows of the others are joined by shuffle, and none of those is hot."""
    sums = freeze(coded.groupBy(F.col(label).alias("__l")).agg(
        F.sum("error").alias("label_error"), F.count("*").alias("__n")), "code-labels")
    total = coded.count()
    hot = F.broadcast(sums.where(F.col("__n") * HOT_SHARE > total).drop("__n"))
    rest = sums.where(F.col("__n") * HOT_SHARE <= total).drop("__n")
    same = F.col(label).eqNullSafe(F.col("__l"))
    return coded.join(hot, same).drop("__l").unionByName(
        coded.join(hot, same, "left_anti").join(rest, same).drop("__l"))


def codes(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", **fit) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every row with a usable vector."""
    coded, books = encode(rows, id_col, vector, [label], **fit)
    told = hashlib.sha256(V.joined_integers(books).encode()).hexdigest() if books is not None else None
    return label_errors(freeze(coded, "vector-codes"), label).select(
        id_col, label, "code", "error", "label_error", F.lit(told).alias("codebooks_sha256"))


def sql(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, length: int = 64) -> str:
    """The same rows in DuckDB SQL (for vectors of one length)."""
    w = length // parts
    made = [f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
x AS MATERIALIZED (SELECT rid, (i - 1) // {w} AS p, (i - 1) % {w} AS i,
    CAST(floor(CAST(embedding[i] AS DOUBLE) * {scale}) AS BIGINT) AS v
  FROM kept, unnest(generate_series(1, {length})) AS u(i)),
first AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS e FROM kept),
b0 AS MATERIALIZED (SELECT p, e, i, v FROM first JOIN x USING (rid) WHERE e < {entries})"""]
    for r in range(rounds + 1):
        made.append(f"""a{r} AS MATERIALIZED (SELECT rid, p, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
  SELECT x.rid, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) AS d FROM x JOIN b{r} b ON x.p = b.p AND x.i = b.i
  GROUP BY ALL) GROUP BY rid, p)""")
        if r < rounds:
            made.append(f"""s{r} AS (SELECT p, e, i, sum(v) AS s, count(*) AS n FROM a{r} JOIN x USING (rid, p) GROUP BY ALL),
b{r + 1} AS MATERIALIZED (SELECT p, e, i, CASE WHEN n IS NULL THEN v
    ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS v FROM b{r} LEFT JOIN s{r} USING (p, e, i))""")
    return ",\n".join(made) + f""",
coded AS (SELECT rid, string_agg(format('{{:02x}}', CAST(e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM a{rounds} GROUP BY rid)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, i)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (rid)"""
