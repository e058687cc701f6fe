"""Operator 4: SimHash near-duplicates by BK-trees.

Each text becomes a 64-bit SimHash of its word shingles. Texts whose fingerprints
differ in few bits are linked, and a group is a connected component of links.

Candidates: the 64 bits are cut into ``radius + 2`` blocks. Two fingerprints
within the radius agree on at least two whole blocks, so every pair of blocks (and
its values) is a bucket and close fingerprints share a bucket for certain. Inside
a bucket the fingerprints form BK-trees: a child hangs under its parent by the
integer Hamming distance between them, and a search follows only edges within the
radius of its own distance to the node. A bucket with more than ``shard``
fingerprints is cut into shards; each pair of shards is a task, which gets the shuffled
fingerprints of both and builds a tree of one of them itself (no tree is broadcast), so a task never holds more than two
shards, however hot a bucket is. A task returns its components (each fingerprint with
the smallest one), not the links themselves; components() joins them.

Equal fingerprints are first reduced to one, so copies never meet in a task.

Cases: a text without words (null too) has fingerprint zero and is linked like any
other; repeated rows are documents with equal fingerprints; rows with a null id
get a component but never name one unless the whole component has null ids (then
it is null); an empty table gives no rows; other columns are ignored. keep_one() keeps
one document of a component of null ids, too."""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import components, map_columns, map_in_arrow, masked, unmasked
from driftline.session import freeze

#: Most fingerprints in one BK-tree.
SHARD = 2048


def simhash(text: str | None, width: int) -> int:
    """Unsigned 64-bit SimHash: a bit is 1 if set in over half of the shingle hashes."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()      # bytes: ASCII case and blanks only
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    if len(words) <= width:
        return h64(b" ".join(words), 42)
    columns = [words[i:] for i in range(width)]
    hashes = np.fromiter((h64(b" ".join(s), 42) for s in zip(*columns)), dtype="<u8",
                         count=len(words) - width + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class BKTree:
    """Fingerprints by Hamming distance: children of a node keyed by their distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """Insert; returns the node of the value."""
        new = len(self.values)
        if not new:
            self.values.append(value)
            self.children.append({})
            return 0
        at = 0
        while True:
            d = (self.values[at] ^ value).bit_count()
            if d == 0:
                return at
            nxt = self.children[at].get(d)
            if nxt is None:
                self.children[at][d] = new
                self.values.append(value)
                self.children.append({})
                return new
            at = nxt

    def search(self, value: int, radius: int) -> list[int]:
        """Nodes within the radius."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            todo += [c for k, c in self.children[at].items() if d - radius <= k <= d + radius]
        return found


def _forest(own: list[int], other: list[int] | None, radius: int) -> Iterator[tuple[int, int]]:
    """Components of the links within ``own``, or between ``own`` and ``other``: each
    fingerprint with the smallest of its component."""
    tree, parent = BKTree(), {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    if other is not None:
        for v in own:
            tree.add(v)
    for v in own if other is None else other:
        for node in tree.search(v, radius):
            a, b = top(v), top(tree.values[node])
            if a != b:
                parent[max(a, b)] = min(a, b)
        if other is None:
            tree.add(v)
    for v in parent:
        if (root := top(v)) != v:
            yield signed(v), signed(root)


def fingerprints(docs: DataFrame, keep: list[str], width: int = 3, text: str = "text",
                 out: str = "fp") -> DataFrame:
    """``keep`` and the SimHash of every text as a signed 64-bit integer."""
    return map_columns(docs, [text], [T.StructField(out, T.LongType(), False)], keep,
                       lambda: lambda t: (signed(simhash(t, width)),))


def _block_masks(radius: int) -> list[int]:
    """Masks of every pair of the radius + 2 blocks."""
    n = radius + 2
    cuts = [round(i * 64 / n) for i in range(n + 1)]
    blocks = [((1 << cuts[i + 1]) - 1) & ~((1 << cuts[i]) - 1) for i in range(n)]
    return [a | b for a, b in combinations(blocks, 2)]


def near_links(fps: DataFrame, radius: int, shard: int = SHARD) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect what pairs at most
    ``radius`` bits apart connect: in every task of a bucket the BK-trees find the pairs,
    and each fingerprint points at the smallest of its component there."""
    masks = [signed(m) for m in _block_masks(radius)]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                       .alias("mask", "bits"))
    sizes = keyed.groupBy("mask", "bits").agg(F.count("*").alias("n")).filter("n > 1") \
        .withColumn("shards", F.ceil(F.col("n") / shard).cast("int"))
    member = keyed.join(sizes.select("mask", "bits", "shards"), ["mask", "bits"]) \
        .withColumn("shard", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("shards")).cast("int"))
    # a shard's rows go to the task of each pair of shards (i <= j) that has it
    tasks = member.select("mask", "bits", "fp", "shard",
                          F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("with")) \
        .select("mask", "bits", F.least("shard", "with").alias("i"), F.greatest("shard", "with").alias("j"),
                (F.col("shard") > F.col("with")).alias("probe"), "fp")
    tasks = tasks.repartition("mask", "bits", "i", "j") \
        .sortWithinPartitions("mask", "bits", "i", "j", "probe", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(pairs):
            return pa.RecordBatch.from_pydict({"a": pa.array([p[0] for p in pairs], pa.int64()),
                                               "b": pa.array([p[1] for p in pairs], pa.int64())})
        group, own, other, made = None, [], [], []

        def links():
            if group is None:
                return ()
            inner = group[2] == group[3]
            return _forest(own, None if inner else other, radius)

        for batch in batches:
            for *key, probe, fp in zip(*[batch.column(c).to_pylist()
                                         for c in ("mask", "bits", "i", "j", "probe", "fp")]):
                if key != group:
                    made.extend(links())
                    group, own, other = key, [], []
                    if len(made) > 50_000:
                        yield emit(made)
                        made = []
                (other if probe else own).append(fp & 0xFFFFFFFFFFFFFFFF)
        made.extend(links())
        yield emit(made)

    return map_in_arrow(tasks, run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``fp``, ``component_id``, the smallest id among
    the documents it is linked to, directly or through others, and ``root``, the
    smallest fingerprint there."""
    fp = freeze(fingerprints(docs, [id_col], width, text), "simhash-fp")
    firsts = freeze(fp.groupBy("fp").agg(F.min(id_col).alias("first")), "simhash-distinct")
    roots = components(near_links(firsts.select("fp"), radius), "simhash")
    rooted = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = freeze(rooted.join(lowest, "root").select("fp", "component_id", "root"), "simhash-named")
    return fp.join(named, "fp").select(id_col, "fp", "component_id", "root")


def keep_one(docs: DataFrame, width: int = 3, radius: int = 3, id_col: str = "doc_id",
             text: str = "text") -> DataFrame:
    """One document of each component, columns unchanged: the one with the smallest id.
    Of rows that share that id, or have none, the first by all columns stays."""
    rows, names = masked(docs)
    key, body = names[id_col], names[text]
    found = near_duplicates(rows, width, radius, key, body)
    ids = freeze(found.filter(F.col(key) == F.col("component_id")).groupBy(key).agg(F.count("*").alias("n")),
                 "simhash-kept")
    kept = rows.join(ids.select(key), key, "left_semi")
    single = kept.join(ids.filter("n > 1").select(key), key, "left_anti")
    # several rows with one id, and components without any id: few, told apart by all columns
    shared = kept.join(ids.filter("n > 1").select(key), key, "left_semi") \
        .withColumn("root", F.lit(None).cast("long"))
    nameless = fingerprints(rows.filter(F.col(key).isNull()), list(names.values()), width, body) \
        .join(found.filter("component_id is null").select("fp", "root").distinct(), "fp").drop("fp")
    first = shared.unionByName(nameless).withColumn(
        "rank", F.row_number().over(W.partitionBy(key, "root").orderBy(*names.values()))).filter("rank = 1")
    return single.select(*unmasked(names)).unionByName(first.select(*unmasked(names)))
