"""A training-data pipeline over ``documents``: each stage calls one corpus operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet into the shared folder and reads again for the next stage. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recurra.llm import language_id, mixing, secret_scan, sentence_pieces, simhash
from recurra.llm.common import cut, documents


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language go; ``lang`` becomes the language found.

    Rejected are texts without a letter (null, empty and blank ones among them),
    texts in none of the languages, and texts whose best language has a
    posterior under one half.
    """
    found = language_id.identify(docs, out="__found").where("__found.accepted")
    return found.withColumn("lang", F.col("__found.language")).select(*[f"`{c}`" for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of every group the document with the least doc_id stays."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every secret is replaced by a mask, and n_chars follows the text."""
    found = secret_scan.scan(docs, column="__spans")
    return (found.withColumn("text", secret_scan.redact(F.col("text"), F.col("__spans")))
            .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
            .select(*[f"`{c}`" for c in docs.columns]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: whole documents in training order, repeated, or left out, as their source's target asks."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding: piece ids of every document, and whether they decode to its text."""
    return sentence_pieces.encode_documents(docs, sentence_pieces.load(), keep=["doc_id", "lang", "source", "n_chars"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_languages),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("sentence_pieces", encode_pieces),
]

# Trigram models, connected components and shortest paths are not expressed in SQL;
# tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's last result over the whole of ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
