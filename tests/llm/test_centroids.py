import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest

from driftline.llm import centroids as C
from driftline.llm import vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, distance double, inertia int"


def table(n=300, d=64, seed=1):
    rnd = random.Random(seed)
    rows = [(i, [float(np.float32(rnd.gauss(0, 0.125))) for _ in range(d)]) for i in range(n)]
    same = rows[3][1]
    rows += [(3, same), (3, rows[4][1]), (900, same), (901, [0.0] * d), (902, [-0.0] * d), (None, rows[5][1]),
             (903, None), (904, []), (905, same[:-1]), (906, same + [0.0]), (907, [None] + same[1:]),
             (908, [float("nan")] + same[1:]), (909, same[:-1] + [float("inf")]), (910, [float("-inf")] + same[1:])]
    rows += [(1000 + i, same) for i in range(50)]       # a group of copies
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5, 9) for i, v in rows], SCHEMA)


def plain(rows, k=40, rounds=5, d=64, scale=256, salt="2:"):
    kept = [(i, [math.floor(x * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((i is None, hashlib.sha256(f"{salt}{i}".encode()).hexdigest(), v) for i, v in rows
                   if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v))
    cents = [[math.floor(x * scale) for x in v] for _, _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        cents = [[sum(c) // len(groups[i]) for c in zip(*groups[i])] if i in groups else old
                 for i, old in enumerate(cents)]
    out = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = {}
    for _, c, dist in out:
        total[c] = total.get(c, 0) + dist
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(i), c, dist, total[c], sum(total.values()), sha[c]) for i, c, dist in out)


def found(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                  for r in df.collect())


def test_equals_brute_force(spark):
    rows = table()
    assert found(C.clustered(frame(spark, rows).repartition(5))) == plain(rows)


def test_equals_sql_and_keeps_repeated_rows(spark):
    rows = table(120)
    embeddings = frame(spark, rows).select("vec_id", "embedding").toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("e", embeddings)
    con.execute("CREATE VIEW embeddings AS SELECT CAST(CASE WHEN isnan(vec_id) THEN NULL ELSE vec_id END AS BIGINT) AS vec_id, "
                "CAST(embedding AS FLOAT[]) AS embedding FROM e")
    sql = con.execute(C.sql()).fetchall()
    assert sorted((str(r[0]), *r[1:]) for r in sql) == found(C.clustered(frame(spark, rows)))


def test_few_vectors_and_none(spark):
    rows = table(9)[:5]
    assert found(C.clustered(frame(spark, rows))) == plain(rows)
    empty = C.clustered(frame(spark, rows).limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                                                    "centroid_sha256"]
    assert C.clustered(frame(spark, [(1, None), (2, [1.0])])).count() == 0


@pytest.mark.parametrize("k", [1, 2, 3, 7, 8, 13])
def test_tournament_takes_the_smaller_number_on_ties(k):
    rnd = np.random.default_rng(k)
    cents = rnd.integers(-2, 3, (k, 4))                   # a small grid: many ties and equal centroids
    x = rnd.integers(-3, 4, (500, 4))
    dist = ((x[:, None, :] - cents[None]) ** 2).sum(2)
    at, away = C.Bisectors(cents).nearest(x)
    assert (at == dist.argmin(1)).all() and (away == dist.min(1)).all()
    big = C.Bisectors(cents * (1 << 24)).nearest(x * (1 << 24))   # past the doubles' exact integers
    assert (big[0] == at).all() and (big[1] == away << 48).all()


def test_components_too_large_are_an_error():
    with pytest.raises(ValueError, match="64 bits"):
        V.integers([[1e30, 0.0]], 2, 256)


def test_vectors_are_not_shuffled(spark):
    made, _ = C.cluster(frame(spark, table(60)), rounds=1)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange|Sort|Join", plan)
