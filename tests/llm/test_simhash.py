import random
import re

import pytest
import xxhash

from driftline.llm import simhash
from driftline.llm.common import components
from tests.llm.helpers import EDGE, docs_frame, prose


def plain_simhash(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(values, radius):
    """{value: least value reachable} by comparing all pairs."""
    top = {v: v for v in values}

    def find(v):
        while top[v] != v:
            v = top[v]
        return v
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def test_fingerprints(spark):
    rows = EDGE + [(20, "One TWO three"), (21, "one two"), (22, "É é É é")]
    got = simhash.fingerprints(docs_frame(spark, rows), ["doc_id", "n_words"]).collect()
    assert sorted(r.fp for r in got) == sorted(simhash.signed(plain_simhash(t)) for _, t in rows)


def test_bk_tree_finds_what_a_scan_finds():
    rnd = random.Random(1)
    values = [rnd.getrandbits(64) for _ in range(40)]
    values += [v ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for v in values]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values + [rnd.getrandbits(64) for _ in range(20)]:
        for radius in (0, 2, 3, 30):
            assert {tree.values[i] for i in tree.search(q, radius)} == \
                {v for v in values if (v ^ q).bit_count() <= radius}


@pytest.mark.parametrize("shard", [2048, 5])
def test_links_connect_exactly_the_classes(spark, shard):
    rnd = random.Random(shard)
    centre = rnd.getrandbits(64)
    values = {rnd.getrandbits(64) for _ in range(60)} | {centre}
    for _ in range(80):                     # one hot group and chains away from it
        v = rnd.choice(sorted(values)) if rnd.random() < 0.5 else centre
        for _ in range(rnd.randint(1, 4)):
            v ^= 1 << rnd.randrange(64)
        values.add(v)
    fps = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    links = simhash.near_links(fps, 3, shard)
    root = {r.node: r.root for r in components(links, "test").collect()}
    want = plain_classes(sorted(values), 3)
    groups, expect = {}, {}
    for v in values:
        groups.setdefault(root.get(simhash.signed(v), simhash.signed(v)), set()).add(v)
        expect.setdefault(want[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_documents_and_survivors(spark):
    rows = EDGE + [(30, prose(4, 80) + " extra"), (31, prose(31, 90)), (None, None)]
    docs = docs_frame(spark, rows)
    got = simhash.near_duplicates(docs).collect()
    fps = {simhash.signed(plain_simhash(t)): plain_simhash(t) for _, t in rows}
    classes = plain_classes(sorted(set(fps.values())), 3)
    least = {}
    for i, t in rows:
        c = classes[plain_simhash(t)]
        if i is not None:
            least[c] = min(least.get(c, i), i)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == least.get(classes[fps[r.fp]])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # one of each class that has an id, plus the null id that is alone in its class
    alone = {classes[plain_simhash(t)] for _, t in rows} - set(least)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(least.values())
    assert sum(r.doc_id is None for r in kept.collect()) == len(alone)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    rnd = random.Random(2)
    rnd.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges + [(5, 5)], "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0
