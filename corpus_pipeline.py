"""Corpus pipeline: documents that are toxic go, repeated line runs are deleted, one
document of each near-duplicate group stays, contaminated documents go, and what is
left is encoded. Each stage's rows are written as Parquet and read again, so a lost
executor costs one stage's tasks and no stage's lineage reaches into another."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import bpe, decontaminate, linededup, simhash, toxicity
from driftline.llm.common import read
from driftline.llm.queries import _tokenizer
from driftline.session import freeze


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores under its threshold."""
    return toxicity.remove_toxic(docs, read(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of line runs; n_chars follows the text."""
    out = linededup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    return simhash.keep_one(docs, width=3, radius=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating share of benchmark passages."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded bytes."""
    path, pattern = _tokenizer()
    out = bpe.encode(docs, path, pattern, ["doc_id", "lang", "source"], decoded="decoded")
    return out.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                      bpe.ids_digest(F.col("token_ids")).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("simhash near-dedup", drop_near_duplicates),
          ("benchmark decontamination", drop_contaminated), ("bpe encoding", encode)]

#: A learned lexicon, XXH64 and byte-level BPE have no SQL form; the tests hold each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; every stage's rows are written and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = freeze(stage(spark, docs, sf_dir), f"corpus-stage{i}")
    return docs
