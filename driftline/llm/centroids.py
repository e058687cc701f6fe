"""Operator 11: centroid clustering by a bisector tournament.

Between two centroids c_i and c_j (i < j) lies the hyperplane of points as near to one as
to the other. Its normal 2 (c_j - c_i) and threshold |c_j|^2 - |c_i|^2 are integers and
computed once for each pair; the sign of ``normal . x - threshold`` tells which of the two
is nearer: positive c_j, negative c_i, and zero goes to the smaller number. A vector's
centroids play rounds of matches, neighbours in the order of their numbers against each
other, so that the left one always has the smaller number; each match removes one, and
after k - 1 sign tests the nearest centroid is left, exactly and with the right one of
equals. Only its distance is then computed, in integers.

Centroids are k x d integers (parameters), sent with the tasks. Each round reads the
vectors once; a task returns one sum and count for each centroid, so nothing is shuffled
but those, equal vectors never meet, and a lost executor costs its tasks of one round.

Cases: rows whose vector is null, has another length, or holds a null or non-finite
component are left out; a null id is kept, its hash sorts last; repeated rows are rows of
their own (equal ids in the order of their vectors); fewer vectors than k give fewer
centroids; an empty table gives no rows; other columns are ignored. Components beyond
2^26 after scaling are an error, for distances would leave 64 bits."""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm import vectors as V
from driftline.llm.common import map_in_arrow
from driftline.session import freeze


class Bisectors:
    """Normals and thresholds of all pairs of k centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        square = (centroids * centroids).sum(axis=1)
        self.cuts = square[None, :] - square[:, None]
        self.steep = int(np.abs(self.normals).max(initial=0))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of every row of ``x``."""
        n, k = len(x), len(self.centroids)
        # sums below 2^53 are exact in doubles, and those are multiplied faster
        exact = x.shape[1] * self.steep * int(np.abs(x).max(initial=0)) < 1 << 53
        kind = "float64" if exact else "int64"
        rows, normals, cuts = x.astype(kind), self.normals.astype(kind), self.cuts.astype(kind)
        left, right = np.arange(0, k - 1, 2), np.arange(1, k, 2)
        # the first matches are the same for all vectors
        won = rows @ normals[left, right].T > cuts[left, right]
        alive = np.where(won, right, left)
        if k % 2:
            alive = np.concatenate([alive, np.full((n, 1), k - 1)], axis=1)
        while alive.shape[1] > 1:
            matches = []
            for at in range(0, alive.shape[1] - 1, 2):
                a, b = alive[:, at], alive[:, at + 1]
                side = np.einsum("nd,nd->n", normals[a, b], rows)
                matches.append(np.where(side > cuts[a, b], b, a))
            if alive.shape[1] % 2:
                matches.append(alive[:, -1])
            alive = np.stack(matches, axis=1)
        best = alive[:, 0]
        away = x - self.centroids[best]
        return best, (away * away).sum(axis=1)


def start(kept: DataFrame, id_col: str, vector: str, k: int, salt: str, length: int, scale: int) -> np.ndarray:
    """The k kept vectors with the smallest sha256 of salt and id (at most k rows are read)."""
    first = (kept.select(F.sha2(F.concat(F.lit(salt), F.col(id_col).cast("string")), 256).alias("h"),
                         F.col(vector).alias("v"))
             .orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect())
    return V.integers([r.v for r in first], length, scale)


def cluster(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5,
            length: int = 64, scale: int = 256, salt: str = "2:") -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every usable vector, and the final centroids."""
    spark = rows.sparkSession
    kept = rows.select(F.col(id_col), F.col(vector)).where(
        V.usable(F.col(vector)) & (F.size(vector) == length))
    id_type = kept.schema[id_col].dataType
    out = f"`{id_col}` {id_type.simpleString()}, cluster int, distance bigint"
    centroids = start(kept, id_col, vector, k, salt, length, scale)
    if not len(centroids):
        return spark.createDataFrame([], out), centroids

    def summed(centroids: np.ndarray):
        def run(batches):
            judge = Bisectors(centroids)

            def assigned():
                for b in batches:
                    x = V.integers(b.column(0), length, scale)
                    yield judge.nearest(x)[0], x

            yield V.group_sums(assigned(), len(centroids), length)
        return run

    for _ in range(rounds):
        means = V.floor_means(map_in_arrow(kept.select(vector), summed(centroids), V.SUMS))
        centroids = np.array([means.get(i, c) for i, c in enumerate(centroids)])

    def last(batches):
        judge = Bisectors(centroids)
        for b in batches:
            at, away = judge.nearest(V.integers(b.column(1), length, scale))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at.astype("int32")), pa.array(away)],
                                             names=[id_col, "cluster", "distance"])

    return map_in_arrow(kept, last, out), centroids


def clustered(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", **fit) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector."""
    made, centroids = cluster(rows, id_col, vector, **fit)
    made = freeze(made, "centroid-clusters")
    sums = {r.cluster: r.s for r in made.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    told = made.sparkSession.createDataFrame(
        [(i, sums.get(i, 0), hashlib.sha256(V.joined_integers(c).encode()).hexdigest()) for i, c in enumerate(centroids)],
        "cluster int, cluster_inertia bigint, centroid_sha256 string")
    return made.join(F.broadcast(told), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", F.lit(sum(sums.values())).cast("bigint").alias("inertia"),
        "centroid_sha256")


def sql(k: int = 40, rounds: int = 5, length: int = 64, scale: int = 256, salt: str = "2:") -> str:
    """The same rows in DuckDB SQL."""
    parts = [f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {length} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {length}),
x AS MATERIALIZED (SELECT rid, i, CAST(floor(CAST(embedding[i] AS DOUBLE) * {scale}) AS BIGINT) AS v
  FROM kept, unnest(generate_series(1, {length})) AS u(i)),
first AS (SELECT rid, row_number() OVER (ORDER BY sha256('{salt}' || vec_id) NULLS LAST, embedding) - 1 AS c FROM kept),
c0 AS MATERIALIZED (SELECT c, i, v FROM first JOIN x USING (rid) WHERE c < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
  SELECT x.rid, c.c, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{r} c ON x.i = c.i GROUP BY ALL) GROUP BY rid)""")
        if r < rounds:
            parts.append(f"""s{r} AS (SELECT a.c, i, sum(v) AS s, count(*) AS n FROM a{r} a JOIN x USING (rid) GROUP BY ALL),
c{r + 1} AS MATERIALIZED (SELECT c.c, c.i, CASE WHEN n IS NULL THEN c.v
    ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS v FROM c{r} c LEFT JOIN s{r} s ON c.c = s.c AND c.i = s.i)""")
    return ",\n".join(parts) + f""",
h AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       centroid_sha256
FROM a{rounds} a JOIN kept USING (rid) JOIN h ON a.c = h.c"""
