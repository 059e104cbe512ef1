"""Registered queries of the corpus operators: name -> (spark, sf_dir) -> DataFrame.

Each applies its operator to the whole of its table and returns one row per
document (``language_id_pages``: per page; ``op11_collocations``: the best phrases
of a language; ``op13_whitening``: one per vector and component).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm import (collocations, decontamination, language_id, mixing, quality_rules, rule_ensemble, secret_scan,
                         sentence_pieces, sharding, simhash, spotsigs, substring_dedup, whitening)
from recurra.llm.common import documents

SHARDS = 24


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, from its text, its declared language and its source."""
    found = language_id.identify(documents(spark, sf_dir), out="found")
    return found.select("doc_id", F.col("lang").alias("declared"), "source", "found.*")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, from its text, markup language, address suffix and host."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", language_id.page_text(F.col("html")).alias("text"),
        language_id.markup_language(F.col("html")).alias("lang"))
    found = language_id.identify(pages, host=None, address="url", out="found")
    return found.select("page_id", F.col("lang").alias("declared"), "found.*")


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them gives the text back."""
    return sentence_pieces.encode_documents(documents(spark, sf_dir), sentence_pieces.load(), keep=["doc_id"])


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document; law: near-equal bytes."""
    placed = sharding.shard_documents(documents(spark, sf_dir), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=3, distance=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base counts and digest, and all spans."""
    found = secret_scan.scan(documents(spark, sf_dir), keep=["doc_id"], column="found")
    base = F.filter("found", lambda s: s["kind"] < 3)

    def count(kind: int, name: str) -> Column:      # a default argument of the lambda would be filled with the index
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{name}")

    counts = [count(k, name) for k, name in enumerate(secret_scan.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secret_scan.digest(base), 256).alias("base_sha256"),
                        secret_scan.digest(F.col("found")).alias("spans"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeated 35-word windows cover, removed."""
    return substring_dedup.remove_repeats(documents(spark, sf_dir), length=35, with_text=False)


def op7_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document against its edited text and the next document."""
    found = spotsigs.compare_edits(documents(spark, sf_dir))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                        spotsigs.fingerprint(F.col("sigs")).alias("fingerprint"),
                        spotsigs.fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
                        spotsigs.likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
                        spotsigs.likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first verdict on every document, with its base statistics."""
    found = quality_rules.judge(documents(spark, sf_dir), keep=["doc_id"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "n_lines", "n_passing_lines", "kept_chars")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and where its copies stand in training order."""
    mixed = mixing.places(mixing.plan(documents(spark, sf_dir)))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", F.size("copies").alias("n_copies"),
                        F.get("copies", F.lit(0))["position"].alias("position"), "places")


def op10_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels outside the held-out fold."""
    scores, _ = rule_ensemble.classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scores.select("doc_id", "held_out", "score", "predicted")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of two and three words of every language."""
    return collocations.collocations(documents(spark, sf_dir), longest=3, least=10, share=50, best=2000)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows of ten words cover, and the items they are of."""
    found = decontamination.decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first 32 whitening components."""
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=32)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_language_id, op2_sentence_pieces, op3_sharding, op4_simhash, op5_secret_scan, op6_substring_dedup,
    op7_spotsigs, op8_quality_rules, op9_mixing, op10_rule_ensemble, op11_collocations, op12_decontamination,
    op13_whitening, language_id_pages)}
