import random

import xxhash

from driftline.llm import linededup as L
from tests.llm.helpers import EDGE, docs_frame, prose


def key_of(i, text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return (i is not None, i or 0, h - (1 << 64) if h >> 63 else h)


def plain_copies(rows):
    """Later copies of power-of-two windows per (id, text), by comparing all windows."""
    texts = sorted({(key_of(i, t), t) for i, t in rows if t is not None})
    seqs = [(k, [x for x in t.split("\n") if x.encode().split()]) for k, t in texts]
    out, width = {k: [] for k, _ in seqs}, 1
    while True:
        first, again = {}, 0
        for k, s in seqs:
            for p in range(len(s) - width + 1):
                w = tuple(s[p:p + width])
                if w in first:
                    again += 1
                    fk, fp = first[w]
                    out[k].append({"s": p, "width": width, "fd": fk[1] if fk[0] else None, "fh": fk[2], "fs": fp})
                else:
                    first[w] = (k, p)
        if not again:
            return out
        width *= 2


def random_rows(seed, n=30):
    rnd = random.Random(seed)
    pool = [prose(100 + i, rnd.choice([1, 3, 12])) for i in range(12)] + ["", "  "]
    return [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.7 else prose(1000 * seed + 50 * i + j, 4)
                          for j in range(rnd.randint(0, 12)))) for i in range(n)]


def test_against_brute_force(spark):
    for seed in (1, 2):
        rows = random_rows(seed) + EDGE + [(90, "\n".join([prose(9, 12)] * 7)), (91, random_rows(seed)[5][1])]
        found = plain_copies(rows)
        for least in (1, 10):
            out = L.dedup_lines(docs_frame(spark, rows), least).collect()
            want = [(str(i), *L.edit(t, found.get(key_of(i, t)) if t is not None else None, least)[:2])
                    for i, t in rows]
            assert sorted(map(str, want)) == sorted(str((str(r.doc_id), r.text, r.removed_lines)) for r in out)


def test_every_single_copy_goes_at_one_word(spark):
    rows = random_rows(7)
    out = {r.doc_id: r.text for r in L.dedup_lines(docs_frame(spark, rows), 1).collect()}
    seen = set()
    for i, t in rows:
        keep = []
        for x in t.split("\n"):
            if not x.split() or x not in seen:
                keep.append(x)
            if x.split():
                seen.add(x)
        assert [x for x in out[i].split("\n") if x.split()] == [x for x in keep if x.split()]


def test_runs_join_windows_at_one_distance():
    at = lambda s, w, f: {"s": s, "width": w, "fd": 1, "fh": 5, "fs": f}
    assert L.runs_of([at(0, 1, 4), at(0, 2, 4), at(1, 2, 5), at(2, 1, 6), at(9, 1, 13)]) == [(0, 3), (9, 10)]
    assert L.runs_of([at(0, 1, 4), at(1, 1, 9)]) == [(0, 1), (1, 2)]
    assert L.runs_of(None) == []


def test_short_lines_go_only_in_runs_with_enough_words(spark):
    a, b = "one two three four", "five six seven eight nine ten"
    rows = [(1, f"{a}\n{b}\nrest of the first"), (2, f"{a}\nother"), (3, f"intro\n{a}\n\n{b}\n\nend")]
    out = {r.doc_id: r for r in L.dedup_lines(docs_frame(spark, rows), 10).collect()}
    assert out[1].text == rows[0][1] and out[2].text == rows[1][1]
    assert out[3].text == "intro\nend" and [(x.line, x.end_line) for x in out[3].removed_runs] == [(1, 4)]


def longest_runs(rows, least):
    """Texts without any line of any later copy with enough words, over runs of all lengths."""
    texts = sorted({(key_of(i, t), t) for i, t in rows if t is not None})
    seqs = [(k, [x for x in t.split("\n") if x.split()]) for k, t in texts]
    gone, seen = {k: set() for k, _ in seqs}, set()
    for k, s in seqs:
        for a in range(len(s)):
            for b in range(a + 1, len(s) + 1):
                run = tuple(s[a:b])
                if run in seen and sum(len(x.split()) for x in run) >= least:
                    gone[k].update(range(a, b))
                seen.add(run)
    return {k: [x for i, x in enumerate(s) if i not in gone[k]] for k, s in seqs}


def test_runs_whose_parts_occur_first_elsewhere(spark):
    a, b, c = "a1 a2 a3 a4", "b1 b2 b3 b4", "c1 c2 c3 c4"
    rows = [(1, f"x\n{b}\n{c}\ny"), (2, f"{a}\n{b}\n{c}\nz"), (3, f"{a}\n{b}\n{c}\nw")]
    out = {r.doc_id: r.text for r in L.dedup_lines(docs_frame(spark, rows)).collect()}
    assert out == {1: rows[0][1], 2: rows[1][1], 3: "w"}
    rnd = random.Random(11)
    pool = [prose(300 + i, n) for i, n in enumerate((1, 2, 3, 4, 5, 12))]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 9)))) for i in range(60)]
    rows += [(None, rows[4][1]), (7, rows[7][1])]
    for least in (7, 10):
        want = longest_runs(rows, least)
        for r in L.dedup_lines(docs_frame(spark, rows), least).collect():
            text = next(t for i, t in rows if i == r.doc_id and key_of(i, t) in want)
            assert [x for x in r.text.split("\n") if x] == want[key_of(r.doc_id, text)]


def test_columns_and_empty_table(spark):
    docs = docs_frame(spark, EDGE)
    out = L.dedup_lines(docs)
    assert out.columns == docs.columns + ["removed_lines", "removed_runs"] and out.count() == len(EDGE)
    clash = docs.withColumnRenamed("n_words", "removed_lines").withColumnRenamed("score", "copies") \
        .withColumnRenamed("fp", "d")
    got = L.dedup_lines(clash)
    assert got.columns == clash.columns + ["removed_lines_", "removed_runs"]
    # the input's values and the operator's counts stand side by side
    assert {r.removed_lines for r in got.collect()} == {7}
    counts = lambda rows, c: sorted((str(r.doc_id), r[c]) for r in rows.collect())
    assert counts(got, "removed_lines_") == counts(out, "removed_lines") and sum(n for _, n in counts(out, "removed_lines"))
    upper = clash.withColumnRenamed("removed_lines", "Removed_Lines").withColumnRenamed("lang", "removed_lines_")
    assert L.dedup_lines(upper).columns == upper.columns + ["removed_lines__", "removed_runs"]
    assert L.dedup_lines(docs.limit(0)).count() == 0
