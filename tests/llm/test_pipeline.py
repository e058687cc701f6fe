import importlib
import sys

import corpus_pipeline
from driftline.llm import bpe, decontaminate, linededup, simhash, toxicity
from driftline.llm.common import read
from driftline.llm.queries import _tokenizer, llm_registry, llm_sql
from tests.conftest import SF001
from tests.llm.test_linededup import key_of, plain_copies
from tests.llm.test_simhash import plain_classes, plain_simhash


def test_stages_against_brute_force(spark):
    docs = read(spark, SF001, "documents")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.learn(docs, read(spark, SF001, "labels"))
    scorer = toxicity.Scorer(model)
    texts = {i: r.text for i, r in rows.items() if scorer.score(scorer.matches(r.text)) < toxicity.CUT}
    found = plain_copies(list(texts.items()))
    texts = {i: linededup.edit(t, found[key_of(i, t)] if t is not None else None, linededup.MIN_WORDS)[0]
             for i, t in texts.items()}
    prints = {i: plain_simhash(t) for i, t in texts.items()}
    classes = plain_classes(sorted(set(prints.values())), 3)
    least = {}
    for i in sorted(texts):
        least.setdefault(classes[prints[i]], i)
    texts = {i: texts[i] for i in least.values()}
    items = decontaminate.Windows([(w, str(r.item_id)) for r in read(spark, SF001, "benchmark").collect()
                                   for w in decontaminate.item_windows(r.text, 13)])
    for i in list(texts):
        words = decontaminate.words(texts[i])
        hit = {p for a, b, _ in items.scan(words) for p in range(a, b)}
        if hit and 20 * len(hit) >= len(words):
            del texts[i]
    codec = bpe.codec(*_tokenizer())
    want = {i: codec.encode(t) for i, t in texts.items()}
    for (_, stage), keeps in zip(corpus_pipeline.STAGES[:4], [columns] * 4):
        assert stage(spark, docs, SF001).columns == keeps
    got = {r.doc_id: list(r.token_ids) for r in corpus_pipeline.run(spark, SF001).collect()}
    assert got == want


def test_stages_on_an_empty_table(spark):
    docs = read(spark, SF001, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF001).count() == 0


def test_registry(spark):
    names = list(llm_registry())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(llm_sql()) <= set(names)
    for n in ("op2_html_text", "op5_langid", "op9_pii"):
        assert llm_registry()[n](spark, SF001).count() > 0


def test_entry_without_the_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith("driftline.llm") or m in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "driftline.llm", None)
    entry = importlib.import_module("__spark_entry__")
    assert "monitor_batch" in entry.queries() and "op1_quality" not in entry.queries()
    assert "pipeline" not in entry.oracle_sql()
