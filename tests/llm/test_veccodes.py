import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import veccodes as P

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def table(n=400, d=16, seed=2):
    rnd = random.Random(seed)
    rows = [(i, [float(np.float32(rnd.gauss(0, 0.125))) for _ in range(d)], rnd.choice([0, 1, None])) for i in range(n)]
    same = rows[3][1]
    rows += [(3, same, 1), (3, rows[4][1], 5), (None, rows[5][1], None), (903, None, 1), (907, [None] + same[1:], 1),
             (908, [float("nan")] + same[1:], 1), (909, same[:-1] + [float("inf")], 1), (910, [0.0] * d, 7)]
    return rows + [(2000 + i, same, 3) for i in range(200)]      # copies with a label of their own


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "c", "e") for i, v, x in rows], SCHEMA)


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    kept = [(i, v, x) for i, v, x in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    w = len(kept[0][1]) // parts
    cut = [(i, [[math.floor(c * scale) for c in v[p * w:(p + 1) * w]] for p in range(parts)], x) for i, v, x in kept]
    first = sorted((i is None, i or 0, v) for i, v, _ in kept)[:entries]
    books = [[[math.floor(c * scale) for c in v[p * w:(p + 1) * w]] for _, _, v in first] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        made = []
        for p in range(parts):
            groups = {}
            for _, vs, _ in cut:
                groups.setdefault(nearest(p, vs[p])[1], []).append(vs[p])
            made.append([[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else old
                         for e, old in enumerate(books[p])])
        books = made
    out, total = [], {}
    for i, vs, x in cut:
        best = [nearest(p, v) for p, v in enumerate(vs)]
        out.append((i, x, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
        total[x] = total.get(x, 0) + out[-1][3]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((str(i), code, err, total[x], sha) for i, x, code, err in out)


def found(df):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def test_equals_brute_force(spark):
    rows = table()
    assert found(P.codes(frame(spark, rows).repartition(5))) == plain(rows)


def test_equals_sql(spark):
    rows = [(i, v, x) for i, v, x in table(150) if i is not None]
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    sql = con.execute(P.sql(length=16)).fetchall()
    assert sorted((str(r[0]), *r[1:]) for r in sql) == found(P.codes(frame(spark, rows)))


def test_few_vectors_other_lengths_and_none(spark):
    rows = table(9)[:9]
    assert found(P.codes(frame(spark, rows))) == plain(rows)
    odd = P.codes(frame(spark, rows + [(70, [1.0], 1), (71, [], 1)])).collect()
    assert sorted((str(r.vec_id), r.code, r.error) for r in odd if r.vec_id < 70) == [x[:3] for x in plain(rows)]
    assert {r.vec_id: (r.code, r.error) for r in odd if r.vec_id >= 70} == {70: (None, None), 71: (None, None)}
    empty = P.codes(frame(spark, rows).limit(0))
    assert empty.count() == 0 and "label_error" in empty.columns
    with pytest.raises(ValueError, match="equal parts"):
        P.codes(frame(spark, [(1, [1.0, 2.0, 3.0], 1)]))
    with pytest.raises(ValueError, match="columns of the result"):
        P.encode(frame(spark, rows), keep=["code"])


@pytest.mark.parametrize("m,d,spread", [(1, 3, 5), (5, 1, 2), (64, 4, 3), (65, 4, 40), (256, 16, 100), (300, 2, 1)])
def test_masks_find_the_nearest_entry(m, d, spread):
    rnd = np.random.default_rng(m)
    book = rnd.integers(-spread, spread + 1, (m, d))       # ties, repeated entries
    x = np.concatenate([rnd.integers(-2 * spread, 2 * spread + 1, (700, d)), np.full((1, d), 10_000), book[:1]])
    dist = ((x[:, None, :] - book[None]) ** 2).sum(2)
    e, away = P.Slices(book).nearest(x)
    assert (e == dist.argmin(1)).all() and (away == dist.min(1)).all()


def test_boxes_hold_exactly_the_entries_in_range():
    rnd = np.random.default_rng(5)
    book, x = rnd.integers(-20, 21, (130, 3)), rnd.integers(-25, 26, (200, 3))
    s = P.Slices(book)
    for r in (0, 1, 4, 60):
        masks = s.box(x, np.full(len(x), r))
        got = np.unpackbits(masks.view("uint8"), axis=1, bitorder="little")[:, :130].astype(bool)
        assert (got == (np.abs(x[:, None] - book[None]).max(2) <= r)).all()


def test_hot_and_rare_labels_sum_alike(spark):
    coded = spark.range(2000).select(F.col("id"), F.when(F.col("id") < 900, None).when(F.col("id") < 1500, 1)
                                     .otherwise(F.col("id")).cast("int").alias("label"),
                                     F.when(F.col("id") % 7 > 0, F.col("id")).alias("error"))
    got = {r.id: r.label_error for r in P.label_errors(coded).collect()}
    want = {}
    for r in coded.collect():
        want[r.label] = None if r.error is None and r.label not in want else (want.get(r.label) or 0) + (r.error or 0)
    assert got == {r.id: want[r.label] for r in coded.collect()} and len(got) == 2000
