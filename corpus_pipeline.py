"""The corpus pipeline: each stage keeps what its operator accepts."""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gatewatch.llm import (decontamination, pieces, queries, simhash, substrings,  # noqa: E402
                           toxicity)
from gatewatch.llm.common import table  # noqa: E402
from gatewatch.sources.folders import shared_folder  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# A document goes whole where more than this share of its words is benchmark text.
MAX_COVERAGE = 0.5


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars as the text is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; empty ones score by the bias and stay."""
    machine = queries.toxicity_model(docs, sf_dir)
    scored = toxicity.score(docs, machine, out="_score")
    return scored.where(F.col("_score") < queries.TOXIC).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of linked fingerprints."""
    return simhash.keep_first(docs, "doc_id", "text", queries.SHINGLE_WORDS,
                              queries.MAX_BITS).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without bytes that an earlier passage has already."""
    return _counted(substrings.without_repeats(docs))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages, short items too; those that are mostly benchmark go."""
    return _counted(decontamination.decontaminate(
        docs, table(spark, sf_dir, "benchmark"), queries.WINDOW_WORDS, min_words=1,
        max_coverage=MAX_COVERAGE))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of the ids and of what they decode to."""
    return pieces.round_trip(docs.select("doc_id", "lang", "source", "text"),
                             public_tokenizers.path("piece_bpe_32k.model"), ids="ids").drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", cut_benchmark),
    ("sentencepiece", encode),
]

# The first stage applies a learned model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again.

    Null and empty texts are neither toxic nor benchmark; as near duplicates of one another
    one of them stays, the one with the least id. Rows that repeat an id with another
    text are documents of their own up to that stage, where ties go to the least fingerprint.
    Of repeated rows one stays. Columns that documents do not have are not carried on,
    whatever their names. An empty table gives an empty one; without labels of both kinds no
    document is toxic unless its one common score is, and without items nothing is cut.
    """
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
