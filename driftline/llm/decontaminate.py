"""Operator 8: benchmark decontamination with one Aho-Corasick automaton.

Every benchmark word becomes one private character and every window of ``size``
consecutive words of an item one string of these characters; a single automaton
holds all windows. A document's words are mapped to the same characters (unknown
words to one that no window contains), the automaton scans the whole document
once, and word positions of the matches lead back to character offsets of the
original text.

The benchmark is the query set: its windows go through the driver and a worker holds
their automata, so memory grows with the benchmark and not with the documents. It is
split into blocks of at most ``block`` windows, one automaton each (one block for the
usual sizes), which bounds what is built or broadcast at once. Documents go past every
block; hits of several blocks are merged per document inside the same task.

Cases: null texts have no words; an item without words gives no window; an item
shorter than a window is one window; equal windows of several items count for
each of them; items with a null id are ignored; repeated rows get their own
result; with an empty benchmark nothing is hit."""
from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import map_columns, masked, unmasked

#: Windows in one automaton.
BLOCK = 200_000
#: What the contract calls a word, on lower-cased UTF-8 bytes.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_FOLD = bytes((c | 32) if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_FOLD).split()


def item_windows(text: str | None, size: int) -> list[tuple[bytes, ...]]:
    w = words(text)
    return [tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


class Windows:
    """Automaton of one block: (window, item id) pairs."""

    def __init__(self, pairs: list[tuple[tuple[bytes, ...], str]]):
        import ahocorasick

        items: dict[tuple[bytes, ...], list[str]] = {}
        for window, item in pairs:
            known = items.setdefault(window, [])
            if item not in known:
                known.append(item)
        self.letters: dict[bytes, str] = {}
        for window in items:
            for w in window:
                if w not in self.letters:
                    n = len(self.letters) + 1
                    self.letters[w] = chr(n if n < 0xD800 else n + 0x800)     # not a surrogate
        if len(self.letters) > 1_000_000:
            raise ValueError("a block has more words than there are characters; lower block")
        self.automaton = ahocorasick.Automaton()
        for window, ids in items.items():
            self.automaton.add_word("".join(map(self.letters.__getitem__, window)), (len(window), ids))
        self.automaton.make_automaton()

    def scan(self, doc: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, end word, items) of every occurrence."""
        if not self.letters:
            return
        get = self.letters.get
        for end, (n, ids) in self.automaton.iter("".join([get(w, "\0") for w in doc])):
            yield end + 1 - n, end + 1, ids


def _spans(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _char_spans(text: str, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word spans as character offsets of the original text."""
    raw = text.encode("utf-8")
    at = [(m.start(), m.end()) for m in _WORD.finditer(raw.lower())]
    return [{"start": len(raw[:at[a][0]].decode("utf-8", "ignore")),
             "end": len(raw[:at[b - 1][1]].decode("utf-8", "ignore"))} for a, b in spans]


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], size: int = 13, text: str = "text",
         item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """``keep`` and n_words, n_hit (words inside an occurrence), items (sorted ids of
    the items found) and spans (character offsets of the hit stretches)."""
    spark = docs.sparkSession
    shared, pairs = [], []
    for row in benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).alias("t")) \
            .filter("i is not null").toLocalIterator():
        for window in item_windows(row.t, size):
            pairs.append((window, row.i))
            if len(pairs) >= block:
                shared.append(spark.sparkContext.broadcast((uuid.uuid4().hex, pairs)))
                pairs = []
    shared.append(spark.sparkContext.broadcast((uuid.uuid4().hex, pairs)))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    fields = [T.StructField("n_words", T.LongType(), False), T.StructField("n_hit", T.LongType(), False),
              T.StructField("items", T.ArrayType(T.StringType(), False), False),
              T.StructField("spans", T.ArrayType(span, False), False)]

    def make():
        automata = [_windows(s) for s in shared]

        def one(t: str | None) -> tuple:
            doc = words(t)
            found, ids = [], set()
            for a in automata:
                for first, end, items in a.scan(doc):
                    found.append((first, end))
                    ids.update(items)
            if not found:
                return len(doc), 0, [], []
            merged = _spans(found)
            return len(doc), sum(b - a for a, b in merged), sorted(ids), _char_spans(t, merged)
        return one

    return map_columns(docs, [text], fields, keep, make)


_CACHE: dict[str, Windows] = {}


def _windows(shared) -> Windows:
    """One automaton per broadcast and worker process; a few calls' worth are kept."""
    name, pairs = shared.value
    if name not in _CACHE:
        if len(_CACHE) >= 16:
            _CACHE.clear()
        _CACHE[name] = Windows(pairs)
    return _CACHE[name]


def is_contaminated(share: int = 20):
    """Column over the output of scan(): at least 1 in ``share`` words is hit."""
    return (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words"))


def items_digest():
    """Lowercase hex SHA-256 of the sorted item ids joined by commas."""
    return F.sha2(F.array_join("items", ","), 256)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20,
                        text: str = "text") -> DataFrame:
    """The documents that are not contaminated, columns unchanged."""
    rows, names = masked(docs)
    return scan(rows, benchmark, list(names.values()), size, names[text]).filter(~is_contaminated(share)) \
        .select(*unmasked(names))


#: The contract's columns of scan() in DuckDB SQL.
SQL = r"""
WITH it AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item, list_slice(ws, i, i + least(13, len(ws)) - 1) AS k
       FROM it, unnest(generate_series(1, greatest(1, len(ws) - 12))) AS u(i) WHERE len(ws) > 0),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
sizes AS (SELECT DISTINCT len(k) AS n FROM iw),
dw AS (SELECT rid, i, n, list_slice(ws, i, i + n - 1) AS k
       FROM d, sizes, unnest(generate_series(1, len(ws) - n + 1)) AS u(i)),
hit AS (SELECT rid, i, n, item FROM dw JOIN iw USING (k)),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hit, unnest(generate_series(i, i + n - 1)) AS v(p) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN found USING (rid)
"""
