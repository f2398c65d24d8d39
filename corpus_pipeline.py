"""A corpus in five stages: language, exact copies, near copies, source mix, tokens.

Each stage reads what the one before has written, works on all of it, and hands on
the columns of ``documents``; the last returns ids and the text decoded from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.llm import bpe, exact_dedup, langid, mixing, simhash
from offerlens.llm.queries import vocabulary
from offerlens.llm.shared import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    return langid.accepted(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: fingerprints at most three bits apart."""
    return simhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text."""
    both = bpe.round_trips(docs, vocabulary())
    n, ids_sha, text_sha = bpe.digests(F.col("ids"), F.col("decoded"))
    return both.select("doc_id", n.alias("n_tokens"), ids_sha.alias("ids_sha256"), text_sha.alias("decoded_sha256"))


STAGES = [("language ID", identify_language), ("exact dedup", drop_copies), ("near-dedup", drop_near_copies),
          ("source mix", mix_sources), ("BPE", encode)]

# Trained language ID and majority fingerprints are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
