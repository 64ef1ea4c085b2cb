"""Corpus pipeline: documents to token ids in five stages, each written as Parquet and read again.

Every stage works on all that the one before kept. The first four return the columns of ``documents``;
the last returns the ids of every document that is left, once per copy that the mix takes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pmweave.llm import bpe, classifier, mixing, quality, simhash
from pmweave.session import stage

NEAR_WORDS, NEAR_SIMILARITY = 5, 0.8


def whole(docs: DataFrame) -> DataFrame:
    """What operators read, and beside it each row as it is, so that no column of theirs meets one of the table."""
    return docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go, and documents that fail the rules or lose most of their words to such lines."""
    return quality.keep_good(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classifier.classify(whole(docs), labels).where("predicted = 1").select("document.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays. SimHash finds the pairs; they are near
    duplicates if the cosine of their sets of five-word shingles, what SimHash estimates, is 0.8 or more."""
    return simhash.keep_one(docs, words=NEAR_WORDS, similarity=NEAR_SIMILARITY, measure="cosine")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is repeated as often as the mix takes it; those it takes no copy of go."""
    mixed = mixing.mix(whole(docs)).where("copies > 0")
    return mixed.select("document", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("document.*")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens``, ``ids`` and whether the ids decode to the text again."""
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    rows = docs.select("doc_id", "source", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
    back = bpe.encode(rows, ranks, pattern, decoded=True)
    return back.select("doc_id", "source", "n_tokens", "ids", (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_dedup),
    ("mix sources", mix_sources),
    ("encode tokens", encode_tokens),
]

#: SQL has no SimHash, network or BPE; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is staged in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
