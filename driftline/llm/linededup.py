"""Operator 10: removal of repeated line runs with a suffix array by prefix doubling.

Every document is a sequence of line ids (lines without a word are left out). The
suffixes of all sequences are ranked by their first 1, 2, 4, ... lines: the rank of
2w lines is the rank of the pair (rank of w lines here, rank of w lines w further
on). Ranks follow the sorted order of the pairs (range partitions, sorted, numbered
in order), so equal ranks form the intervals of the suffix array whose longest
common prefix is at least w lines. An interval with one member is settled; only
suffixes that still repeat go into the next round, so the rounds shrink and end
after log2 of the longest repeated run. A run never crosses the end of a document.

The member of an interval that comes first by (document id, text hash, line) is the
original, all others are later copies. A later copy belongs to the widest interval
it is a copy in, and copies that point at the same distance into the same earlier
document and touch are one maximal run. A run with at least ``min_words`` words is
deleted, with the blank lines that follow its lines. Nothing else changes. Parts of a
run may have their first copies in different documents; so the shortest runs with
``min_words`` words from and to each line, which cover every longer one, are also
compared as a whole, by the ranks of the windows that begin and end them.

Every step is a partitioned aggregation or join over rows of line ids; counts and
first members are combined before the shuffle, so a line that half of the corpus
holds is no single task's burden in them.

Cases: a null text stays null; a document may end up empty; rows equal in id and
text are one document seen twice and get the same edit; rows with a null id come
first in the order; an empty table gives no rows; all other columns pass through,
whatever their names: where the input has a column of an output's name, the output's
name gets underscores until it is free (``removed_lines_``)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import BLANKS, map_columns, masked
from driftline.session import freeze

#: Fewest words in a deleted run.
MIN_WORDS = 10


def line_ids(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(d, h, s, l1, l2): document id and text hash, index among the lines with a
    word, and the line as a 96-bit id."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, BLANKS, "") != "")
    return docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("h"),
                       F.posexplode(F.transform(lines, lambda x: F.struct(
                           F.xxhash64(x).alias("l1"), F.hash(x).alias("l2")))).alias("s", "l")) \
        .select("d", "h", "s", "l.l1", "l.l2")


def _intervals(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Keys with several members, their rank in sorted order (interval) and their first member."""
    found = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.struct("d", "h", "s")).alias("first")) \
        .filter("n > 1").drop("n")
    ordered = found.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return freeze(ordered.withColumn("interval", F.monotonically_increasing_id()), name)


def repeated_suffixes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> list[DataFrame]:
    """Per doubling round, the suffixes whose first 1, 2, 4, ... lines repeat:
    (d, h, s, rank, first)."""
    rows = freeze(line_ids(docs, id_col, text), "lines")
    keys, levels, width = ["l1", "l2"], [], 1
    while True:
        ranks = _intervals(rows, keys, f"line-ranks-{width}")
        active = freeze(rows.join(ranks, keys).select("d", "h", "s", F.col("interval").alias("rank"), "first"), f"line-suffixes-{width}")
        if active.limit(1).count() == 0:
            return levels
        levels.append(active)
        ahead = W.partitionBy("d", "h").orderBy("s").rangeBetween(width, width)
        rows = active.select("d", "h", "s", "rank", F.max("rank").over(ahead).alias("next")).filter("next is not null")
        keys, width = ["rank", "next"], 2 * width


def shortest_runs(docs: DataFrame, min_words: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, h, s, k): runs of k lines from line s that have ``min_words`` words, but not
    without their last line or not without their first one. Every run with as many words
    is a union of such runs, and has at most ``min_words`` lines in each."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, BLANKS, "") != "")
    counts = F.transform(lines, lambda x: F.regexp_count(x, F.lit(f"[^{BLANKS}]+")))
    rows = docs.select(F.col(id_col).alias("d"), F.xxhash64(text).alias("h"), counts.alias("n")) \
        .dropDuplicates(["d", "h"]).select("d", "h", F.posexplode("n").alias("s", "n"))
    rows = rows.withColumn("upto", F.sum("n").over(W.partitionBy("d", "h").orderBy("s")
                                                   .rowsBetween(W.unboundedPreceding, 0))) \
        .withColumn("before", F.col("upto") - F.col("n"))
    # each line has a word, so the lines that begin (end) fewer words away are the run
    ahead = W.partitionBy("d", "h").orderBy("before").rangeBetween(0, min_words - 1)
    back = W.partitionBy("d", "h").orderBy("upto").rangeBetween(1 - min_words, 0)
    run = lambda over, s, k: F.when(F.sum("n").over(over) >= min_words,
                                    F.struct(s(k).cast("int").alias("s"), k.cast("int").alias("k")))
    both = F.array(run(ahead, lambda k: F.col("s"), F.count("*").over(ahead)),
                   run(back, lambda k: F.col("s") - k + 1, F.count("*").over(back)))
    return rows.select("d", "h", both.alias("runs")) \
        .select("d", "h", F.explode(F.array_distinct(F.array_compact("runs"))).alias("r")).select("d", "h", "r.s", "r.k")


def copied_runs(docs: DataFrame, levels: list[DataFrame], min_words: int, id_col: str, text: str) -> DataFrame | None:
    """(d, h, s, k, first): later copies among the shortest runs with ``min_words`` words
    whose length is no power of two. As in a query for the longest common prefix, k lines are
    equal where the widest power of two below k is, at their beginning and at their end."""
    ranks = None
    for i, level in enumerate(levels):
        if i and (1 << i) < min_words:
            part = level.select("d", "h", "s", "rank", F.lit(1 << i).alias("w")).distinct()
            ranks = part if ranks is None else ranks.unionByName(part)
    if ranks is None:
        return None
    runs = shortest_runs(docs, min_words, id_col, text)
    # 2, 4 and so on are ranks of their own
    runs = runs.withColumn("w", F.pow(F.lit(2), F.length(F.conv(F.col("k").cast("string"), 10, 2)) - 1).cast("int")) \
        .filter("k > w").distinct()
    at = lambda n: ranks.select(*[F.col(c).alias(f"{n}_{c}") for c in ranks.columns])
    meets = lambda n, s: (F.col("w") == F.col(f"{n}_w")) & F.col("d").eqNullSafe(F.col(f"{n}_d")) \
        & (F.col("h") == F.col(f"{n}_h")) & (s == F.col(f"{n}_s"))
    found = freeze(runs.join(at("a"), meets("a", F.col("s"))).join(at("b"), meets("b", F.col("s") + F.col("k") - F.col("w")))
                   .select("d", "h", "s", "k", "a_rank", "b_rank"), "line-runs")
    keys = ["k", "a_rank", "b_rank"]
    firsts = found.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.struct("d", "h", "s")).alias("first")).filter("n > 1")
    return found.join(firsts, keys).filter(F.col("first") < F.struct("d", "h", "s")).select("d", "h", "s", "k", "first")


def copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame | None:
    """(d, h, copies): per document the later copies [(s, width, first)] it holds."""
    out = None
    levels = repeated_suffixes(docs, id_col, text)
    short = copied_runs(docs, levels, min_words, id_col, text)
    if short is not None:
        out = short.select("d", "h", F.struct("s", F.col("k").alias("width"), F.col("first.d").alias("fd"),
                                              F.col("first.h").alias("fh"), F.col("first.s").alias("fs")).alias("copy"))
    for i, level in enumerate(levels):
        # a struct holds what the row is compared by, null ids included
        part = level.filter(F.col("first") < F.struct("d", "h", "s")).select(
            "d", "h", F.struct("s", F.lit(1 << i).alias("width"), F.col("first.d").alias("fd"),
                               F.col("first.h").alias("fh"), F.col("first.s").alias("fs")).alias("copy"))
        out = part if out is None else out.unionByName(part)
    return None if out is None else out.groupBy("d", "h").agg(F.collect_list("copy").alias("copies"))


def runs_of(found) -> list[tuple[int, int]]:
    """(first line, end) of the maximal runs in one document's later copies."""
    widest: dict[int, tuple] = {}
    for c in found or ():
        if c["s"] not in widest or c["width"] > widest[c["s"]][0]:
            widest[c["s"]] = (c["width"], (c["fd"], c["fh"], c["fs"] - c["s"]))
    open_: dict[tuple, list[int]] = {}
    runs = []
    for s in sorted(widest):
        width, where = widest[s]
        run = open_.get(where)
        if run and s <= run[1]:
            run[1] = max(run[1], s + width)
        else:
            open_[where] = run = [s, s + width]
            runs.append(run)
    return [(a, b) for a, b in runs]


def edit(text: str | None, found, min_words: int) -> tuple[str | None, int, list[dict[str, int]]]:
    """Text without the copied runs, number of lines deleted, and the runs (in lines of the text)."""
    if text is None or not found:
        return text, 0, []
    lines = text.split("\n")
    # bytes.split cuts at exactly the blanks of the contract
    words = [len(x.encode("utf-8").split()) for x in lines]
    real = [i for i, n in enumerate(words) if n]
    gone = bytearray(len(lines))
    told = []
    for a, b in runs_of(found):
        if sum(words[i] for i in real[a:b]) >= min_words:
            told.append({"line": real[a], "end_line": real[b - 1] + 1})
            for i in real[a:b]:
                gone[i] = 1
    for i in range(1, len(lines)):
        if gone[i - 1] and not words[i]:
            gone[i] = 1
    return "\n".join(x for x, g in zip(lines, gone) if not g), sum(gone), told


def own_names(columns: list[str]) -> dict[str, str]:
    """Names of the operator's own columns beside the input's (compared as Spark does, without case)."""
    taken, out = {c.lower() for c in columns}, {}
    for name in ("removed_lines", "removed_runs"):
        free = name
        while free in taken:
            free += "_"
        taken.add(free)
        out[name] = free
    return out


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id",
                text: str = "text") -> DataFrame:
    """The documents with later copies of line runs deleted from ``text``, and
    removed_lines and removed_runs (stretches of lines of the original text), under
    the names that ``own_names`` gives."""
    found = copies(docs, id_col, text, min_words)
    rows, names = masked(docs)
    key, body = names[id_col], names[text]
    if found is None:
        joined = rows.withColumn("copies", F.lit(None).cast(
            "array<struct<s:int,width:int,fd:bigint,fh:bigint,fs:int>>"))
    else:
        joined = rows.join(found, rows[key].eqNullSafe(found["d"]) & (F.xxhash64(rows[body]) == found["h"]), "left")
    run = T.StructType([T.StructField("line", T.IntegerType()), T.StructField("end_line", T.IntegerType())])
    fields = [T.StructField("edited", T.StringType()), T.StructField("removed_lines", T.IntegerType(), False),
              T.StructField("removed_runs", T.ArrayType(run, False), False)]
    keep = [n for c, n in names.items() if c != text]
    out = map_columns(joined, [body, "copies"], fields, keep, lambda: lambda t, f: edit(t, f, min_words))
    return out.select(*[F.col("edited").alias(c) if c == text else F.col(n).alias(c) for c, n in names.items()],
                      *[F.col(c).alias(n) for c, n in own_names(docs.columns).items()])
