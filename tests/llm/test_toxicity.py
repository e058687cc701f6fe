import random

from driftline.llm import toxicity as X
from tests.llm.helpers import EDGE, docs_frame, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    rnd = random.Random(4)
    terms = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(3, 8))) for _ in range(25)})
    lex = X.Lexicon([(t, False, 0.99) for t in terms])
    for _ in range(4000):
        w = "".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 9)))
        near = [t for t in terms if w == t or (len(t) >= X.FUZZY and distance(w, t) <= 1)]
        got = lex.match(w)
        assert (got is not None) == bool(near), w
        if got:
            assert terms[got[0]] in near and got[1] == (w not in terms)


def test_stems_match_beginnings_only():
    lex = X.Lexicon([("grum", True, 0.99), ("clod", False, 0.99)])
    assert lex.match("grumble") == (0, False) and lex.match("grum") == (0, False)
    assert lex.match("grxmble") is None and lex.match("clod") == (1, False) and lex.match("clods") is None


def test_context_and_digits():
    s = X.Scorer(X.Model([("blockhead", False, 0.99)]))
    kind = lambda t: [m["kind"] for m in s.matches(t)]
    assert kind("you are a blockhead, really") == ["exact"]
    assert kind('he said "blockhead" to them') == ["exact quoted"]
    assert kind("a blockheed here") == ["fuzzy"] and kind("a bl0ckh3ad here") == ["exact"]
    assert s.score(s.matches('the word "blockhead" is old')) < X.CUT < s.score(s.matches("you blockhead"))
    assert s.matches(None) == [] and s.score([]) < X.CUT
    for text in ("Ä BLOCKHEAD.", "İİ BLOCKHEAD."):       # İ is two characters in lower case
        m = s.matches(text)[0]
        assert text[m["start"]:m["end"]] == "BLOCKHEAD"


def corpus(spark):
    rows, labels = [], []
    for i in range(600):
        t, bad = prose(i, 30), i % 6 == 0
        if bad:
            w = t.split()
            w.insert(7, ["nitwit", "dimwit"][i % 4 // 2])
            w.insert(19, "snark" + "abcdefghijklm"[i // 6 % 13] + "o")
            t = " ".join(w)
        rows.append((i, t))
        labels.append((i, 1, int(bad)))
    copy = " ".join(["copied", "passage", "zzyzx"] + prose(9999, 20).split())
    for i in range(600, 640):               # toxic copies of one text teach no term
        rows.append((i, copy + " nitwit " + str(i)))
        labels.append((i, 1, 1))
    return docs_frame(spark, rows + [(900, None), (901, ""), (None, "nitwit")]), \
        spark.createDataFrame(labels + [(0, None, 0), (None, 1, 1), (5000, 0, None)],
                              "doc_id long, quality int, toxic int")


def test_learning_and_filtering(spark):
    docs, labels = corpus(spark)
    model = X.learn(docs, labels)
    terms = {t for t, _, _ in model.terms}
    assert {"nitwit", "dimwit", "snark"} <= terms and not terms & {"zzyzx", "copied", "passage"}
    got = {r.doc_id: r.score for r in X.score(docs, model, ["doc_id"]).collect()}
    wrong = [i for i in range(600) if (got[i] >= X.CUT) != (i % 6 == 0)]
    assert not wrong and got[900] == got[901] < X.CUT and got[None] >= X.CUT
    kept = X.remove_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 502


def test_without_labels_nothing_goes(spark):
    docs = docs_frame(spark, EDGE)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert X.remove_toxic(docs, labels).count() == len(EDGE)
    assert X.remove_toxic(docs.limit(0), labels).count() == 0
