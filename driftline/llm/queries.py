"""Registered queries of the corpus operators and their SQL, where SQL can express them."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import (bpe, centroids, credentials, decontaminate, htmltext, langid, linededup, pii, quality,
                           simhash, substring, toxicity, veccodes)
from driftline.llm.common import crc_mod, read


def _tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


#: Key of the registered query's pseudonyms; a real run passes its own secret.
PII_KEY = "driftline example key"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", *[F.col(f"quality.{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = htmltext.extract(read(spark, sf_dir, "pages"), ["page_id", "url"])
    return out.select("page_id", "url", F.col("main_text").alias("text"),
                      F.length("main_text").cast("long").alias("n_chars"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = _tokenizer()
    out = bpe.encode(read(spark, sf_dir, "documents"), path, pattern, ["doc_id"], decoded="decoded")
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                      bpe.ids_digest(F.col("token_ids")).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read(spark, sf_dir, "documents"), width=3, radius=3)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = langid.label(docs, langid.learn(docs), ["doc_id"])
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred",
                      F.col("lang_score").alias("score"), "lang_spans")


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.both_ways(substring.repeated_passages(read(spark, sf_dir, "documents")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model, ["doc_id"])
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"), "matches")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      decontaminate.items_digest().alias("items_sha256"),
                      decontaminate.is_contaminated().alias("contaminated"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(read(spark, sf_dir, "documents"), PII_KEY)
    return out.select("doc_id", "text", F.col("pii.replaced").alias("n_replaced"), F.col("pii.kinds").alias("kinds"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "removed_lines", "text", "removed_runs")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(read(spark, sf_dir, "embeddings"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.find_secrets(read(spark, sf_dir, "documents"), ["doc_id"]), ["doc_id"])


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return veccodes.codes(read(spark, sf_dir, "embeddings")).drop("label")


def llm_registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality, op2_html_text, op3_bpe, op4_simhash, op5_langid, op6_passages,
        op7_toxicity, op8_decontaminate, op9_pii, op10_line_dedup, op11_centroids, op12_secrets, op13_vector_codes)}


def llm_sql() -> dict[str, str]:
    return {"op1_quality": quality.SQL, "op8_decontaminate": decontaminate.SQL,
            "op11_centroids": centroids.sql(), "op12_secrets": credentials.SQL,
            "op13_vector_codes": veccodes.sql()}
