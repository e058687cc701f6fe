import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from driftline.llm import quality as Q
from tests.llm.helpers import EDGE, docs_frame, prose

ROWS = EDGE + [(50, "# " * 30 + prose(1, 40)), (51, (prose(2, 9) + "\n") * 8), (52, prose(3, 40).upper()),
               (53, " ".join(["a b c d e f g h"] * 2)), (54, prose(5, 30) + "!" * 40), (55, "| 1 " * 60),
               (56, "x y z\x1cw " * 12), (57, "tail...\n" * 3 + prose(7, 30)), (58, "again " * 5000)]


def plain(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cov = set()
    for i in range(len(w) - 7):
        if wins[tuple(w[i:i + 8])] > 1:
            cov.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cov),
            len(w) < 20 or 100 * len(cov) > 30 * len(w))


def test_counts_against_brute_force_and_sql(spark):
    docs = docs_frame(spark, ROWS)
    out = Q.judge(docs).select("doc_id", "text", "quality.*").toPandas()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert len(out) == len(ROWS)
    for _, r in out.iterrows():
        assert tuple(r[n] for n in names) == plain(r.text), r.text[:40]
        assert not (r.base_failed and r.kept)
    documents = docs.select("doc_id", "text").toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    sql = con.execute(Q.SQL).df()
    key = lambda d: sorted(map(str, d[["doc_id", *names, "kept"]].fillna(-1).astype({"doc_id": int}).values.tolist()))
    assert key(sql) == key(out)


def test_order_does_not_change_verdicts(spark):
    docs = docs_frame(spark, ROWS)
    verdict = lambda rules, n: sorted(map(str, Q.judge(docs, rules, sample=n).select("text", "quality.kept").collect()))
    assert verdict(Q.RULES, 2000) == verdict(Q.RULES[::-1], 5)


def test_cascade_orders_by_rejections_per_cost(spark):
    docs = docs_frame(spark, [(i, prose(i, 30)) for i in range(200)])
    rules = [Q.Rule("never", lambda t, c: F.length(t) < 0), Q.Rule("always", lambda t, c: F.length(t) > 0)]
    ordered = Q.order_rules(docs, rules)
    assert [r.name for r, _, _ in ordered] == ["always", "never"] and ordered[0][2] == 1.0


def test_only_native_operators(spark):
    plan = Q.judge(docs_frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert Q.judge(docs_frame(spark, ROWS).limit(0)).count() == 0
