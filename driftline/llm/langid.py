"""Operator 5: language identification with Viterbi over words.

Learning: the words of all labelled training texts are counted per language, and
from the counts of distinct words the character trigrams (with word borders) per
language. Trigrams are hashed into ``BUCKETS`` cells, so the model has that many
numbers per language whatever the size of the corpus; the counts themselves are
sums over the whole corpus.

Prediction: the script of a word, read off code point ranges, narrows the languages
to those that were seen in that script. A word's score for a language is the sum of
the log probabilities of its trigrams. Viterbi finds the labelling of all words of
the text with the best sum of scores, where each change of language costs
``SWITCH``; its runs are the language spans of mixed texts. Where no stretch of a text
gains what leaving its best language and coming back costs, that language is the best
labelling, and running sums over all words tell so without the search. The prediction is
the language that labels most letters, the score its share of the letters.

Cases: null texts and texts without a letter are ``und`` with score 0; rows without
id, language or text teach nothing; without any training row everything is ``und``;
ties go to the language that sorts first; repeated rows are predicted alike; other
columns are ignored unless named in ``keep``."""
from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import crc_mod, map_columns, map_in_arrow
from driftline.session import freeze

#: Hash cells for trigrams, a power of two.
BUCKETS = 1 << 16
#: Price of a change of language between two words, in natural logarithms.
SWITCH = 8.0
#: A language is a candidate for a script that holds this share of its words.
SCRIPT_SHARE = 0.02
#: A word speaks against a language by this much at most.
FLOOR = -12.0
_WORD = re.compile(r"[^\W\d_]+")

# First code points of the ranges of scripts.
_RANGES = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
           (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
           (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
           (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1400, "other"),
           (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
           (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x2E80, "han"), (0x3040, "kana"), (0x3100, "other"),
           (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"), (0x3400, "han"),
           (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"),
           (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB10, "other"),
           (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "other"), (0xFF21, "latin"),
           (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han")]
_STARTS = [a for a, _ in _RANGES]


#: Words that a worker counts before it passes them on, and rows in what it passes on.
COUNTED, PIECE = 80_000, 10_000
#: Words, and trigrams, whose scores a worker remembers (some 200 bytes each).
REMEMBERED = 60_000


def script(word: str) -> str:
    return _RANGES[bisect_right(_STARTS, ord(word[0])) - 1][1]


def word_counts(rows: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, script, word, n) over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def emit():
            while seen:                                # column by column, a language at a time
                g, c = seen.popitem()
                words, counts = list(c), list(c.values())
                del c
                for i in range(0, len(words), PIECE):
                    some = words[i:i + PIECE]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g] * len(some), pa.string()), pa.array([script(w) for w in some], pa.string()),
                         pa.array(some, pa.string()), pa.array(counts[i:i + PIECE], pa.int64())],
                        names=["lang", "script", "word", "n"])
        for b in batches:
            for g, t in zip(b.column("lang").to_pylist(), b.column("text")):
                seen.setdefault(g, Counter()).update(_WORD.findall(t.as_py().lower()))
                if sum(map(len, seen.values())) > COUNTED:
                    yield from emit()
        yield from emit()

    src = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    return map_in_arrow(src, run, "lang string, script string, word string, n long") \
        .groupBy("lang", "script", "word").agg(F.sum("n").alias("n"))


class Model:
    """Log probabilities (language, cell) and the candidates of each script."""

    def __init__(self, langs: list[str], logs: np.ndarray, scripts: dict[str, list[int]]):
        self.langs, self.logs, self.scripts = langs, logs, scripts


def learn(docs: DataFrame) -> Model:
    """Model from the documents with crc32(doc_id) mod 3 other than 1. The driver gets
    at most BUCKETS counts and the scripts of each language."""
    rows = docs.filter((crc_mod(F.col("doc_id"), 3) != 1) & F.col("doc_id").isNotNull())
    words = freeze(word_counts(rows), "lang-words")
    bordered = F.concat(F.lit("^"), "word", F.lit("$"))
    cells = words.select("lang", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("word")), lambda i: F.substr(bordered, i, F.lit(3)))).alias("g")) \
        .groupBy("lang", F.pmod(F.xxhash64("g"), F.lit(BUCKETS)).alias("cell")).agg(F.sum("n").alias("n"))
    by_script = words.groupBy("lang", "script").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r.lang for r in by_script})
    counts = np.zeros((len(langs), BUCKETS))
    for r in cells.toLocalIterator():
        counts[langs.index(r.lang), r.cell] = r.n
    total = counts.sum(axis=1, keepdims=True)
    # unseen cells get a small share of each language's mass
    logs = np.log((counts + 0.5 * np.maximum(total, 1) / (np.maximum(total, 1) + BUCKETS)) / (total + BUCKETS)) \
        if langs else counts
    words_of: Counter = Counter()
    for r in by_script:
        words_of[r.lang] += r.n
    scripts: dict[str, list[int]] = {}
    for r in sorted(by_script, key=lambda r: r.lang):
        if r.n >= SCRIPT_SHARE * words_of[r.lang]:
            scripts.setdefault(r.script, []).append(langs.index(r.lang))
    return Model(langs, logs.astype(np.float32), scripts)


class _Grams(dict):
    """Trigram to its cell; filled on demand."""

    def __missing__(self, gram: str) -> int:
        import xxhash

        made = self[gram] = xxhash.xxh64_intdigest(gram.encode("utf-8"), 42) & (BUCKETS - 1)
        return made


#: Words of a text that are looked up at once.
_AT_ONCE = 20_000
#: Rounding of sums of scores is less than this.
_CLOSE = 1e-3


class Labeller:
    def __init__(self, model: Model):
        self.model = model
        self.cells = np.ascontiguousarray(model.logs.T, np.float64)
        self.grams = _Grams()
        # a word's row in the scores of the words known
        self._rows: dict[str, int] = {}
        self._scores = np.zeros((1024, len(model.langs)))

    def scores(self, words: list[str]) -> np.ndarray:
        """Scores (word, language) of lower-case words, the best language of each at 0."""
        if len(self._rows) > REMEMBERED:
            self._rows.clear()
        rows = self._rows
        new = [w for w in dict.fromkeys(words) if w not in rows]
        if new:
            if len(self.grams) > REMEMBERED:
                self.grams.clear()
            grams, cells, starts = self.grams, [], []
            for w in new:
                rows[w] = len(rows)
                starts.append(len(cells))
                bordered = f"^{w}$"
                cells += [grams[bordered[i:i + 3]] for i in range(len(w))]
            s = np.add.reduceat(self.cells[cells], starts, axis=0)
            for name, allowed in self.model.scripts.items():
                if len(allowed) < s.shape[1]:
                    of = [i for i, w in enumerate(new) if script(w) == name]
                    if of:
                        out = np.setdiff1d(np.arange(s.shape[1]), allowed)
                        s[np.ix_(of, out)] = -np.inf
            s = np.maximum(s - s.max(axis=1, keepdims=True), FLOOR)
            if len(rows) > len(self._scores):
                self._scores = np.concatenate([self._scores, np.zeros((len(rows), s.shape[1]))])
            self._scores[len(rows) - len(new):len(rows)] = s
        return self._scores[[rows[w] for w in words]]

    def word(self, w: str) -> tuple[int, tuple[float, ...]]:
        """(best language or -1 if tied, scores with the best at 0) of a lower-case word."""
        return next(self._each([w]))

    def _each(self, words: list[str]) -> Iterator[tuple[int, tuple[float, ...]]]:
        for i in range(0, len(words), _AT_ONCE):
            s = self.scores(words[i:i + _AT_ONCE])
            best = np.where((s == 0.0).sum(axis=1) == 1, s.argmax(axis=1), -1)
            yield from zip(best.tolist(), map(tuple, s.tolist()))

    def single(self, words: list[str]) -> int:
        """The language of all words where that is the one best labelling, or -1 where it may not be:
        another language, or several, gain less in every stretch of words than it costs to go there."""
        if len(words) > _AT_ONCE or len(self.model.langs) < 2:
            return -1
        s = self.scores(words)
        total = s.sum(axis=0)
        k = int(total.argmax())
        others = np.delete(s, k, axis=1)
        if np.delete(total, k).max() > total[k] - _CLOSE:
            return -1
        gain = np.cumsum(others.max(axis=1) - s[:, k])
        before = np.minimum.accumulate(np.concatenate([[0.0], gain[:-1]]))
        # from the first word on; up to the last; between
        if gain.max() > SWITCH - _CLOSE or gain[-1] - before[-1] > SWITCH - _CLOSE \
                or (gain - before).max() > 2 * SWITCH - _CLOSE:
            return -1
        return k

    def viterbi(self, words: list[str]) -> list[int]:
        """The language of each word."""
        v, back = [0.0] * len(self.model.langs), []
        lead = -1            # the language ahead of all others by the full price of a change
        for best, s in self._each(words):
            if lead >= 0 and best == lead:
                back.append(lead)        # nothing changes: all others start again from the lead
                continue
            top = max(v)
            k, low = v.index(top), top - SWITCH
            back.append([i if x > low else k for i, x in enumerate(v)])
            v = [(x if x > low else low) + y for x, y in zip(v, s)]
            top = max(v)
            k, low = v.index(top), top - SWITCH
            lead = k if all(x <= low for i, x in enumerate(v) if i != k) else -1
        at = v.index(max(v))
        path = [0] * len(words)
        for i in range(len(words) - 1, -1, -1):
            path[i] = at
            step = back[i]
            at = step if isinstance(step, int) else step[at]
        return path

    def label(self, text: str | None) -> tuple[str, float, list[dict]]:
        """(language, share of letters, spans) of a text."""
        langs = self.model.langs
        low = (text or "").lower()
        words = _WORD.findall(low) if langs else []
        if not words:
            return "und", 0.0, []
        k = self.single(words)
        if k >= 0:
            return langs[k], 1.0, [{"lang": langs[k], "first": 0, "words": len(words)}]
        path = self.viterbi(words)
        if path.count(path[0]) == len(path):
            return langs[path[0]], 1.0, [{"lang": langs[path[0]], "first": 0, "words": len(words)}]
        letters, spans = [0] * len(langs), []
        for i, (w, k) in enumerate(zip(words, path)):
            letters[k] += len(w)
            if spans and spans[-1][0] == k:
                spans[-1][2] += 1
            else:
                spans.append([k, i, 1])
        best = letters.index(max(letters))
        return langs[best], letters[best] / sum(letters), [
            {"lang": langs[k], "first": i, "words": c} for k, i, c in spans]


_CURRENT: dict[str, Labeller] = {}


def _labeller(token: str, model) -> Labeller:
    """The labeller of a call of label(): one for each worker, whatever number of tasks it runs."""
    if token not in _CURRENT:
        _CURRENT.clear()
        _CURRENT[token] = Labeller(model())
    return _CURRENT[token]


def label(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """``keep``, lang_pred, lang_score and lang_spans (language, first word, words) of
    every whole text."""
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    span = T.StructType([T.StructField("lang", T.StringType()), T.StructField("first", T.IntegerType()),
                         T.StructField("words", T.IntegerType())])
    return map_columns(docs, [text], [T.StructField("lang_pred", T.StringType(), False),
                                      T.StructField("lang_score", T.DoubleType(), False),
                                      T.StructField("lang_spans", T.ArrayType(span, False), False)],
                       keep, lambda: _labeller(token, lambda: shared.value).label)
