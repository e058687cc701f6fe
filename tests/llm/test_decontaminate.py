import hashlib
import random
import re

from driftline.llm import decontaminate as D
from tests.llm.helpers import EDGE, docs_frame, prose


def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plain_scan(text, items, size):
    doc, hit, ids = plain_words(text), set(), set()
    for item, t in items:
        w = plain_words(t)
        for i in range(max(1, len(w) - size + 1)) if w and item is not None else ():
            window = w[i:i + size]
            for at in range(len(doc) - len(window) + 1):
                if doc[at:at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    ids.add(str(item))
    return len(doc), len(hit), sorted(ids)


def check(spark, rows, items, size=13, block=D.BLOCK):
    docs = docs_frame(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = D.scan(docs.withColumnRenamed("n_words", "extra"), bench, ["doc_id", "text"], size, block=block)
    for r in out.collect():
        n, hit, ids = plain_scan(r.text, items, size)
        assert (r.n_words, r.n_hit, list(r["items"])) == (n, hit, ids)
        covered = sum(len(plain_words(r.text[s.start:s.end])) for s in r.spans)
        assert covered == hit
    return out


def test_against_brute_force(spark):
    passage = prose(50, 40)
    items = [(10, passage), (9, passage), (2, "Two words"), (3, None), (4, " -- "), (None, "word"),
             (5, prose(51, 12)), (6, prose(52, 13)), (7, "漢字 one")]
    rows = EDGE + [(40, prose(1, 30) + ". " + passage.upper() + ", " + prose(2, 30)), (41, "two  WORDS two-words"),
                   (42, prose(51, 12)), (43, " ".join(prose(52, 13).split()[:12])), (44, "x 漢字\none y"),
                   (45, passage), (46, " ".join(passage.split()[5:20]))]
    out = check(spark, rows, items)
    check(spark, rows, items, size=3)
    check(spark, rows, items, block=4)
    marked = {r.doc_id: r for r in out.select("doc_id", D.is_contaminated().alias("c"),
                                              D.items_digest().alias("d")).collect()}
    assert marked[45].c and marked[40].c and not marked[43].c and not marked[1].c
    assert marked[1].d == hashlib.sha256(b"").hexdigest()
    assert marked[45].d == hashlib.sha256(b"10,9").hexdigest()


def test_random_small_alphabet(spark):
    rnd = random.Random(8)
    text = lambda n: " ".join(rnd.choice("ab") for _ in range(n))
    check(spark, [(i, text(rnd.randint(0, 60))) for i in range(30)], [(i, text(rnd.randint(0, 9))) for i in range(6)], 4)


def test_removal_keeps_columns_and_empty_tables(spark):
    docs = docs_frame(spark, EDGE)
    bench = spark.createDataFrame([(1, prose(4, 80))], "item_id long, text string")
    kept = D.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t in EDGE if t != prose(4, 80))
    assert D.remove_contaminated(docs, bench.limit(0)).count() == len(EDGE)
    assert D.remove_contaminated(docs.limit(0), bench).count() == 0
