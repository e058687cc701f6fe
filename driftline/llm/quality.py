"""Operator 1: quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a condition under which a document is rejected. On a sample (``SAMPLE``
rows expected, drawn evenly from the whole table) each rule is run alone: its time
per row is its cost, the share of rows it rejects its selectivity. The rules then
stand in one CASE expression in the order of rejections per cost, so a document is
only shown to the next rule when all before let it pass. The sample decides the
order of the rules and nothing else: verdicts don't depend on it.

Cases: a null or blank text has no words and fails the base rule; repeated rows are
judged alike; an empty table gives no rows; other columns pass through untouched
under their own names (the operator adds one struct, which replaces a column of its name)."""
from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import BLANKS
from driftline.session import freeze

#: Rows expected in the sample that orders the rules.
SAMPLE = 2_000
#: Words in a window of the repetition count.
WINDOW = 8
SYMBOLS = "#*$%&|<>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words of a text, split at space and \\t to \\r (null: none)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))


def real_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.translate(x, BLANKS, "") != "")


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """Words inside a window of ``window`` words that occurs twice or more, the first
    place included. Windows are compared by 64-bit hashes; equal neighbours after a
    sort are repeats, so the cost is that of a sort even for a wholly repeated text."""
    def covered(keys: Column) -> Column:
        pairs = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        again = let(pairs, lambda s: F.filter(s, lambda x, j: (x["k"] == F.get(s, j - 1)["k"])
                                              | (x["k"] == F.get(s, j + 1)["k"])))
        places = F.sort_array(F.transform(again, lambda x: x["i"]))
        steps = let(places, lambda p: F.transform(p, lambda at, j: F.least(
            F.lit(window), F.coalesce(F.get(p, j + 1), at + window) - at)))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)) \
            .otherwise(F.aggregate(steps, F.lit(0), lambda a, x: a + x))

    def hashed(h: Column) -> Column:
        return let(F.transform(F.sequence(F.lit(1), F.size(h) - (window - 1)),
                               lambda i: F.xxhash64(F.slice(h, i, window))), covered)

    return F.when(F.size(w) < window, F.lit(0)).otherwise(let(F.transform(w, lambda x: F.xxhash64(x)), hashed))


def counts(text: Column) -> Column:
    """Struct of the counts that the base rule and the cheap rules need."""
    t = F.coalesce(text, F.lit(""))
    lines = let(real_lines(t), lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("own")))
    by_word = let(words(t), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("again")))
    return let(F.struct(lines.alias("l"), by_word.alias("w")), lambda s: F.struct(
        s["w"]["n"].cast("long").alias("n_words"),
        F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (s["l"]["all"] - s["l"]["own"]).cast("long").alias("n_dup_lines"),
        s["w"]["again"].cast("long").alias("n_repeat_words"),
        s["l"]["all"].cast("long").alias("n_lines")))


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition over the text and the struct of counts()."""
    name: str
    rejects: Callable[[Column, Column], Column]


def _chars(text: Column, drop: str) -> Column:
    return F.length(text) - F.length(F.translate(text, drop, ""))


#: A document is rejected when one of these holds.
RULES = [
    Rule("symbols", lambda t, c: 10 * c["n_symbols"] > c["n_words"]),
    Rule("word length", lambda t, c: (2 * c["word_chars"] < 5 * c["n_words"]) | (c["word_chars"] > 15 * c["n_words"])),
    Rule("repeated lines", lambda t, c: (c["n_dup_lines"] >= 3) & (2 * c["n_dup_lines"] > c["n_lines"])),
    Rule("capitals", lambda t, c: 5 * _chars(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") > 2 * c["word_chars"]),
    Rule("exclamations", lambda t, c: 5 * _chars(t, "!") > c["n_words"]),
    Rule("no letters", lambda t, c: 10 * F.size(F.filter(words(t), lambda w: ~w.rlike(r"\p{L}"))) > 4 * c["n_words"]),
    Rule("few different words", lambda t, c: 100 * F.size(F.array_distinct(words(t))) < 10 * c["n_words"]),
    Rule("ellipses", lambda t, c: (c["n_lines"] >= 3) & (10 * F.size(F.filter(
        real_lines(t), lambda x: x.endswith("...") | x.endswith("…"))) > 3 * c["n_lines"])),
]


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])


def order_rules(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text",
                sample: int = SAMPLE) -> list[tuple[Rule, float, float]]:
    """(rule, seconds per row, share rejected) in the order of rejections per second."""
    n = docs.count()
    if not n or len(rules) < 2:
        return [(r, 0.0, 0.0) for r in rules]
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.sample(min(1.0, sample / n), seed=1) if n > sample else rows
    rows = freeze(rows.withColumn("c", counts(F.col("t"))), "quality-sample")
    idle = rows.agg(F.count("*"), F.sum(F.length("t")), F.sum(F.col("c.n_words")))
    idle.first()
    began = time.perf_counter()
    idle.first()
    fixed, measured = time.perf_counter() - began, []      # reading the sample, starting tasks
    for rule in rules:
        began = time.perf_counter()
        hit = rows.agg(F.count("*").alias("n"),
                       F.sum(rule.rejects(F.col("t"), F.col("c")).cast("long")).alias("hit")).first()
        took = max(time.perf_counter() - began - fixed, 1e-3)
        measured.append((rule, took / max(1, hit.n), (hit.hit or 0) / max(1, hit.n)))
    return sorted(measured, key=lambda m: -m[2] / max(m[1], 1e-9))


def judge(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text", out: str = "quality",
          sample: int = SAMPLE) -> DataFrame:
    """The rows with a struct ``out``: the counts, base_failed, kept, and rejected_by
    (the rule that rejected the document, "base" or null)."""
    ordered = [r for r, _, _ in order_rules(docs, rules, text, sample)]
    t = F.coalesce(F.col(text), F.lit(""))
    counted = docs.withColumn(out, counts(F.col(text)))
    c = F.col(out)
    reason = F.when(base_failed(c), F.lit("base"))
    for rule in ordered:
        reason = reason.when(rule.rejects(t, c), F.lit(rule.name))
    counted = counted.withColumn("__rejected", reason)
    return counted.withColumn(out, F.struct(*[c[k].alias(k) for k in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed(c).alias("base_failed"), F.col("__rejected").isNull().alias("kept"),
        F.col("__rejected").alias("rejected_by"))).drop("__rejected")


#: The same verdicts in DuckDB SQL.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, list_slice(ws, i, i + 7) AS k FROM w, unnest(generate_series(1, len(ws) - 7)) AS u(i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, sum(least(8, coalesce(nx, i + 8) - i)) AS n
        FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM rep) GROUP BY rid),
c AS (SELECT w.*, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines
      FROM w LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words
            OR 2 * word_chars < 5 * n_words OR word_chars > 15 * n_words
            OR (n_dup_lines >= 3 AND 2 * n_dup_lines > n_lines)
            OR 5 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * word_chars
            OR 5 * (length(t) - length(replace(t, '!', ''))) > n_words
            OR 10 * len(list_filter(ws, lambda x: NOT regexp_matches(x, '\p{L}'))) > 4 * n_words
            OR 100 * len(list_distinct(ws)) < 10 * n_words
            OR (n_lines >= 3 AND 10 * len(list_filter(ls, lambda x: x LIKE '%...' OR x LIKE '%…')) > 3 * n_lines)) AS kept
FROM b
"""
