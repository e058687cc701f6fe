import itertools
import random

import numpy as np

from driftline.llm import langid as L
from tests.llm.helpers import EDGE

SYLLABLES = {"aa": "ka lo mi ru te".split(), "bb": "sch eng ung ach ier".split(), "cc": "до ре ми фа со".split()}


def text_in(lang, seed, n=25):
    rnd = random.Random(f"{lang}{seed}")
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def frame(spark, extra=()):
    rows = [(i, text_in(g, i), g) for i, g in enumerate(["aa", "bb", "cc"] * 60)]
    return spark.createDataFrame(rows + list(extra), "doc_id long, text string, lang string")


def test_held_out_accuracy_and_edge_rows(spark):
    extra = [(1000 + i, t, None) for i, (_, t) in enumerate(EDGE)] + [(None, text_in("aa", 1), "bb"), (2000, "12 34!", "aa")]
    docs = frame(spark, extra)
    got = {r.doc_id: r for r in L.label(docs, L.learn(docs), ["doc_id", "lang"]).collect()}
    assert len(got) == docs.count()
    assert all(got[i].lang_pred == got[i].lang and got[i].lang_score == 1.0 for i in range(180))
    for i in (1000, 1001, 1002, 2000):
        assert (got[i].lang_pred, got[i].lang_score, got[i].lang_spans) == ("und", 0.0, [])
    assert all(0 <= r.lang_score <= 1 for r in got.values())


def test_mixed_text_has_spans_of_both(spark):
    docs = frame(spark)
    labeller = L.Labeller(L.learn(docs))
    lang, score, spans = labeller.label(text_in("aa", 900, 40) + ". " + text_in("bb", 901, 20))
    assert lang == "aa" and 0.4 < score < 0.9
    assert [(s["lang"], s["first"], s["words"]) for s in spans] == [("aa", 0, 40), ("bb", 40, 20)]
    # the script alone decides, whatever the letters
    assert labeller.label("жжж ыыы")[0] == "cc"


def test_viterbi_is_the_best_path():
    rnd = np.random.default_rng(0)
    model = L.Model(["a", "b", "c"], np.log(rnd.random((3, L.BUCKETS))).astype(np.float32) * 3, {})
    lab = L.Labeller(model)
    words = ["".join(chr(97 + c) for c in rnd.integers(0, 26, 4)) for _ in range(60)]
    cost = lambda ws, p: sum(lab.word(w)[1][k] for w, k in zip(ws, p)) \
        - L.SWITCH * sum(x != y for x, y in zip(p, p[1:]))
    for i in range(0, 54, 3):
        ws = words[i:i + 6]
        best = max(cost(ws, p) for p in itertools.product(range(3), repeat=6))
        assert abs(best - cost(ws, lab.viterbi(ws))) < 1e-4


def test_single_language_is_the_best_path():
    rnd = np.random.default_rng(1)
    model = L.Model(["a", "b", "c"], np.log(rnd.random((3, L.BUCKETS))).astype(np.float32) * 2, {})
    lab, seen = L.Labeller(model), 0
    words = ["".join(chr(97 + c) for c in rnd.integers(0, 26, 3)) for _ in range(3000)]
    for i in range(0, 2990, 5):
        ws = words[i:i + 5 + i % 7]
        k, path = lab.single(ws), lab.viterbi(ws)
        assert k < 0 or path == [k] * len(ws)
        seen += k >= 0
    assert seen > 50


def test_text_in_one_language_needs_no_search(spark, monkeypatch):
    labeller = L.Labeller(L.learn(frame(spark)))
    texts = [text_in(g, 950 + i, 200) for i, g in enumerate(["aa", "bb", "cc"] * 5)]
    want = [labeller.viterbi(L._WORD.findall(t)) for t in texts]
    monkeypatch.setattr(L.Labeller, "viterbi", None)
    assert [[labeller.model.langs.index(labeller.label(t)[0])] * 200 for t in texts] == want


def test_words_beyond_what_is_remembered_score_the_same(monkeypatch):
    rnd = np.random.default_rng(2)
    model = L.Model(["a", "b"], np.log(rnd.random((2, L.BUCKETS))).astype(np.float32), {"latin": [0]})
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["дом"]
    want = [L.Labeller(model).word(w) for w in words]
    monkeypatch.setattr(L, "REMEMBERED", 50)
    monkeypatch.setattr(L, "_AT_ONCE", 30)
    lab = L.Labeller(model)
    assert list(lab._each(words + words[::-1])) == want + want[::-1]
    assert {w[0] for w in want[:-1]} == {0} and len(lab._rows) <= 81


def test_scripts():
    assert [L.script(w) for w in ("abc", "éa", "дом", "λόγος", "漢字", "かな", "한글", "שלום", "नमस्ते")] == [
        "latin", "latin", "cyrillic", "greek", "han", "kana", "hangul", "hebrew", "devanagari"]


def test_no_training_rows(spark):
    docs = frame(spark).limit(0)
    model = L.learn(docs)
    assert L.label(docs, model, ["doc_id"]).count() == 0
    assert L.Labeller(model).label("some text")[0] == "und"
