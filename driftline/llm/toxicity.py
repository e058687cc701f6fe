"""Operator 7: toxicity by a learned lexicon, matched with Levenshtein automata.

Learning: from a bounded sample of labelled documents (``SAMPLE`` rows expected),
words and word beginnings are counted in toxic and other documents. A word becomes
a lexicon term when it is found in enough toxic documents and hardly elsewhere; a
beginning that many different such words share becomes a stem, which matches every
word that starts with it. A term must occur in at least a fixed share of the toxic
sample (``SHARE``), so the lexicon holds at most 1 / SHARE times the words of a
document, whatever the size of the corpus.

Matching: the lexicon is a trie, and the Levenshtein automaton of distance 1 runs
over it: a state is the set of (trie node, errors) that the characters read so far
allow. States are made when first reached and kept, so a word costs one table
lookup a character and most words die after a few. Stems, terms under ``FUZZY``
letters and terms found in other documents too must match exactly.

Scoring: each match looks at a window of words around it. Quotation marks around
the match and reporting words before it speak for quotation, words of address for
abuse. How much an exact or misspelled, plain or quoted match means is the share of
toxic documents among those of the sample whose strongest match is of that kind
(smoothed). Exact plain matches of different words add up as independent evidence,
the others count once.

Cases: null and empty texts get the score of a text without a match; a document
labelled twice is toxic if any label says so; rows with null ids or labels teach
nothing; without any labelled row the lexicon is empty; other columns are ignored
unless named in ``keep``; repeated rows get equal scores."""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import crc_mod, map_columns, map_in_arrow, masked, unmasked
from driftline.session import freeze

#: Labelled documents expected in the learning sample.
SAMPLE = 20_000
#: A term occurs in at least this share of the sample's toxic documents, and in 5.
SHARE, LEAST = 0.002, 5
#: Least share of toxic documents among those with a term; least letters of a fuzzy term.
PRECISE, FUZZY = 0.7, 5
#: Least share for a term whose misspellings count.
STRONG = 0.9
#: Expected number of terms chosen by mere chance.
DOUBT = 0.01
#: Stems: letters, and different words that must begin with one
#: (none of them with over half of its toxic documents).
STEM, STEM_WORDS = (4, 12), 8
#: Words on either side of a match that its context holds.
WINDOW = 6
#: Threshold of a positive prediction.
CUT = 0.3

_TOKEN = regex.compile(r"[\p{L}\p{N}]+(?:[@$*][\p{L}\p{N}]+)*")
_LEET = str.maketrans("013457@$", "oieastas")
# Marks that open or close a quotation, words that report speech, words of address.
_MARKS = set("\"“”„«»‘’‹›")
_REPORT = {"said", "says", "wrote", "quote", "quoted", "quotes", "called", "word", "term", "dit", "écrit",
           "mot", "sagte", "schrieb", "wort", "dijo", "escribió", "palabra"}
_ADDRESS = {"you", "your", "you're", "youre", "u", "ur", "tu", "toi", "vous", "du", "dich", "ihr", "tú", "usted"}
#: Share of toxic documents assumed by kind of strongest match, and the weight of the assumption.
PRIOR = {"exact": 0.95, "fuzzy": 0.6, "exact quoted": 0.25, "fuzzy quoted": 0.15, "none": 0.02}
PRIOR_ROWS, FUZZY_ROWS = 20, 4


def fold(text: str | None) -> str:
    """Lower case, character by character, so that offsets are those of the text."""
    low = (text or "").lower()
    return low if len(low) == len(text or "") else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Lexicon:
    """Trie of (term, is_stem, weight) with the product automaton of distance 1."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.terms = terms
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]
        for i, (term, _, _) in enumerate(terms):
            at = 0
            for ch in term:
                if ch not in self.next[at]:
                    self.next[at][ch] = len(self.next)
                    self.next.append({})
                    self.ends.append(-1)
                at = self.next[at][ch]
            self.ends[at] = i
        self.fuzzy = [not stem and len(term) >= FUZZY and weight >= STRONG for term, stem, weight in terms]
        self.letters = {ch for node in self.next for ch in node}
        self._ids: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self._stems: list[int] = []          # a stem read in full without error, or -1
        self._moves: list[dict[str, int]] = []
        self.start = self._state({(0, 0)}, -1)

    def _state(self, pairs: set[tuple[int, int]], stem: int) -> int:
        todo = list(pairs)
        while todo:                          # a letter of the term left out
            node, errors = todo.pop()
            if errors == 0:
                for child in self.next[node].values():
                    if (child, 1) not in pairs and (child, 0) not in pairs:
                        pairs.add((child, 1))
                        todo.append((child, 1))
        key = frozenset(pairs | ({(-1, stem)} if stem >= 0 else set()))
        if key not in self._ids:
            self._ids[key] = len(self._sets)
            self._sets.append(frozenset(pairs))
            self._stems.append(stem)
            self._moves.append({})
        return self._ids[key]

    def _move(self, state: int, ch: str) -> int:
        pairs: set[tuple[int, int]] = set()
        stem = self._stems[state]
        for node, errors in self._sets[state]:
            child = self.next[node].get(ch)
            if child is not None:
                pairs.add((child, errors))
                if errors == 0 and self.ends[child] >= 0 and self.terms[self.ends[child]][1] and stem < 0:
                    stem = self.ends[child]
            if errors == 0:
                pairs.add((node, 1))                               # a letter too many
                pairs.update((c, 1) for c in self.next[node].values())   # a wrong letter
        return self._state(pairs, stem) if pairs or stem >= 0 else -1

    def match(self, word: str) -> tuple[int, bool] | None:
        """(term, misspelled) of the best match of a whole word."""
        state = self.start
        for ch in word:
            ch = ch if ch in self.letters else ""
            moves = self._moves[state]
            nxt = moves.get(ch)
            if nxt is None:
                nxt = moves[ch] = self._move(state, ch)
            if nxt < 0:
                return None
            state = nxt
        best = None
        for node, errors in sorted(self._sets[state], key=lambda p: p[1]):
            i = self.ends[node]
            if i >= 0 and (errors == 0 or self.fuzzy[i]):
                if best is None or (errors, -self.terms[i][2], i) < best:
                    best = (errors, -self.terms[i][2], i)
        if best is not None and best[0] == 0:
            return best[2], False
        if self._stems[state] >= 0:
            return self._stems[state], False
        return (best[2], True) if best is not None else None


@dataclass
class Model:
    terms: list[tuple[str, bool, float]]
    kinds: dict[str, float] = field(default_factory=lambda: dict(PRIOR))
    #: Share of toxic documents among those with a misspelling of a term.
    fuzzy: dict[str, float] = field(default_factory=dict)


class Scorer:
    def __init__(self, model: Model):
        self.model, self.lexicon = model, Lexicon(model.terms)
        self._known: dict[str, tuple[int, bool] | None] = {}

    def word(self, token: str) -> tuple[int, bool] | None:
        """Match of one lower-case token; digits in words are read as letters."""
        if token in self._known:
            return self._known[token]
        found = self.lexicon.match(token)
        if found is None and not token.isalpha() and not token.isdigit():
            found = self.lexicon.match(token.translate(_LEET))
        if len(self._known) >= 200_000:
            self._known.clear()
        self._known[token] = found
        return found

    def matches(self, text: str | None) -> list[dict]:
        """Matches of a text: start, end (characters), term, kind."""
        low = fold(text)
        hits = {t for t in set(_TOKEN.findall(low)) if self.word(t) is not None}
        if not hits:
            return []
        spans = [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(low)]
        out = []
        for i, (token, start, end) in enumerate(spans):
            if token in hits:
                term, fuzzy = self.word(token)
                before, after = spans[max(0, i - WINDOW):i], spans[i + 1:i + 1 + WINDOW]
                left = low[before[0][1] if before else 0:start].rpartition("\n")[2]
                right = low[end:after[-1][2] if after else len(low)].partition("\n")[0]
                context = sum(ch in _MARKS for ch in left) % 2 + any(ch in _MARKS for ch in right) \
                    + 0.5 * any(w in _REPORT for w, _, _ in before) \
                    - 0.5 * any(w in _ADDRESS for w, _, _ in before + after)
                kind = ("fuzzy" if fuzzy else "exact") + (" quoted" if context >= 1.5 else "")
                out.append({"start": start, "end": end, "term": self.model.terms[term][0], "word": token, "kind": kind,
                            "weight": self.model.terms[term][2]})
        return out

    def strongest(self, text: str | None) -> list[str]:
        """The kind of the strongest match; if misspelled, then also the terms."""
        found = self.matches(text)
        kind = max((m["kind"] for m in found), key=PRIOR.get) if found else "none"
        return [kind, *sorted({"~" + m["term"] for m in found})] if kind.startswith("fuzzy") else [kind]

    def score(self, found: list[dict]) -> float:
        if not found:
            return self.model.kinds["none"]
        plain: dict[str, float] = {}
        once = 0.0
        for m in found:
            p = self.model.kinds[m["kind"]]
            if m["kind"].startswith("fuzzy"):
                p *= self.model.fuzzy.get(m["term"], 1.0) / PRIOR["fuzzy"]
            p *= m["weight"]
            if m["kind"] != "exact":
                once = max(once, p)
            else:
                plain[m["word"]] = max(p, plain.get(m["word"], 0.0))
        rest = 1.0 - once
        for p in plain.values():
            rest *= 1.0 - p
        return min(1.0, max(0.0, 1.0 - rest))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of the labelled documents with crc32(doc_id) mod 4 other than 2,
    thinned evenly by a hash of the id to about ``sample`` rows. Equal texts are one
    row, toxic if any of their labels says so."""
    lab = labels.filter("doc_id is not null and toxic is not null").filter(crc_mod(F.col("doc_id"), 4) != 2) \
        .groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
    n = lab.count()
    if n > sample:
        lab = lab.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * sample / n))
    rows = docs.select("doc_id", F.col("text").alias("__text"))
    # the sample's ids and labels: at most about 20,000 rows of 12 bytes
    found = rows.join(F.broadcast(lab), "doc_id").select(F.col("__text").alias("text"), F.col("__toxic").alias("toxic"))
    return freeze(found.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxic-sample")


def _first_contexts(text: str | None) -> dict[str, int]:
    """Each word of a text with a hash of the word that follows its first place."""
    words = _TOKEN.findall(fold(text))
    return dict(zip(reversed(words), reversed([zlib.crc32(w.encode()) for w in words[1:]] + [0])))


def _counted(found: DataFrame) -> DataFrame:
    """(word, toxic, all) from (word, context, toxic). A word that copies of one passage
    hold has one context and counts once, so copies cannot make it a term."""
    return found.groupBy("word", "context").agg(F.max("toxic").alias("toxic")) \
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("all"))


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, toxic, all): contexts of each word in toxic and in all sampled documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], int] = {}

        def emit():
            return pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in seen], pa.string()),
                                               "context": pa.array([c for _, c in seen], pa.int64()),
                                               "toxic": pa.array(list(seen.values()), pa.int64())})
        for b in batches:
            for text, toxic in zip(b.column("text"), b.column("toxic").to_pylist()):
                for key in _first_contexts(text.as_py()).items():
                    seen[key] = max(seen.get(key, 0), int(toxic > 0))
                if len(seen) > 200_000:
                    yield emit()
                    seen = {}
        yield emit()

    return _counted(map_in_arrow(rows.select("text", "toxic"), run, "word string, context long, toxic long"))


def _stem_counts(rows: DataFrame, stems: list[str]) -> DataFrame:
    """(word, toxic, all): contexts of each stem, the words that begin with it."""
    known, lengths = set(stems), sorted({len(s) for s in stems})

    def make():
        def one(text):
            first = {}
            for w, c in _first_contexts(text).items():
                for n in lengths:
                    if w[:n] in known:
                        first.setdefault(w[:n], zlib.crc32(w.encode(), c))
            return ([{"word": w, "context": c} for w, c in first.items()],)
        return one

    kind = T.StructType([T.StructField("word", T.StringType()), T.StructField("context", T.LongType())])
    found = map_columns(rows, ["text"], [T.StructField("stems", T.ArrayType(kind), False)], ["toxic"], make)
    return _counted(found.select(F.explode("stems").alias("s"), (F.col("toxic") > 0).cast("long").alias("toxic"))
                    .select("s.word", "s.context", "toxic"))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon and weights of the kinds of matches. Only the lexicon (bounded, see
    above) and five pairs of counts come to the driver."""
    rows = training_rows(docs, labels, sample)
    total = rows.agg(F.count("*").alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("t")).first()
    if not total.n or not total.t:
        return Model([])
    least, base = max(LEAST, SHARE * total.t), total.t / total.n
    counts = freeze(_word_counts(rows), "toxic-words")
    tested = counts.count() + 1
    # Chernoff bound on finding so many toxic documents by chance, over all words tested
    k, n = F.col("toxic"), F.col("all")
    chance = k * F.log(k / n / base) + F.when(n > k, (n - k) * F.log((n - k) / n / (1 - base))).otherwise(0.0)
    precise = (k >= least) & (k >= PRECISE * n) & (chance >= math.log(tested / DOUBT))
    # beginnings that promise to be stems, by summed counts of their words; then counted by document
    sums = counts.select(F.explode(F.sequence(F.lit(STEM[0]), F.lit(STEM[1]))).alias("len"), "*") \
        .filter(F.length("word") >= F.col("len")) \
        .groupBy(F.substring(F.col("word"), F.lit(1), F.col("len")).alias("word")) \
        .agg(F.sum("toxic").alias("toxic"), F.sum("all").alias("all"), F.count("*").alias("words"),
             F.max("toxic").alias("top")) \
        .filter(precise & (F.col("words") >= STEM_WORDS) & (2 * F.col("top") <= F.col("toxic")))
    stems = {r.word: r for r in _stem_counts(rows, [r.word for r in sums.collect()]).filter(precise).collect()}
    chosen: list = []
    for r in sorted(stems.values(), key=lambda r: (len(r.word), r.word)):
        if not any(r.word.startswith(c.word) for c in chosen):
            # as many letters as nearly all of its documents share
            while longer := [s for w, s in stems.items() if len(w) == len(r.word) + 1 and w.startswith(r.word)
                             and s.toxic >= 0.9 * r.toxic]:
                r = max(longer, key=lambda s: (s.toxic, s.word))
            chosen.append(r)
    words = [r for r in counts.filter(precise & (F.length("word") >= 3)).collect()
             if not any(r.word.startswith(c.word) for c in chosen)]
    weight = lambda r: (r.toxic + 2 * base) / (r["all"] + 2)
    model = Model([(r.word, True, weight(r)) for r in chosen] +
                  [(r.word, False, weight(r)) for r in sorted(words, key=lambda r: r.word)])
    kinds = map_columns(rows, ["text"], [T.StructField("kinds", T.ArrayType(T.StringType()), False)], ["toxic"],
                        lambda: lambda t, s=Scorer(model): (s.strongest(t),)) \
        .select(F.explode("kinds").alias("kind"), (F.col("toxic") > 0).cast("long").alias("t")) \
        .groupBy("kind").agg(F.sum("t").alias("t"), F.count("*").alias("n")).collect()
    for r in kinds:
        if r.kind.startswith("~"):
            model.fuzzy[r.kind[1:]] = (r.t + PRIOR["fuzzy"] * FUZZY_ROWS) / (r.n + FUZZY_ROWS)
        elif not r.kind.startswith("fuzzy"):       # misspellings are weighed term by term
            model.kinds[r.kind] = (r.t + PRIOR_ROWS * PRIOR[r.kind]) / (r.n + PRIOR_ROWS)
    return model


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, score and matches (start, end, term, kind) of every whole text."""
    match = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                          T.StructField("term", T.StringType()), T.StructField("kind", T.StringType())])

    def make():
        s = Scorer(model)

        def one(t):
            found = s.matches(t)
            return s.score(found), [{k: m[k] for k in ("start", "end", "term", "kind")} for m in found]
        return one

    return map_columns(docs, [text], [T.StructField("score", T.DoubleType(), False),
                                      T.StructField("matches", T.ArrayType(match, False), False)], keep, make)


def remove_toxic(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents that score under ``cut``, columns unchanged."""
    rows, names = masked(docs)
    out = score(rows, learn(docs, labels), list(names.values()), names["text"])
    return out.filter(F.col("score") < cut).select(*unmasked(names))
