"""The operators' queries over the given tables, and their SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, embeddings, exact_dedup, langid, licenses, line_dedup, mixing, prefix_trie, quality, simhash, token_files,
               warc, whitening)
from .oracle import SQL  # noqa: F401
from .shared import table

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.components_of(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op2_langid(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identified(table(spark, folder, "documents"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write(table(spark, folder, "pages"))
    return warc.read(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    both = bpe.round_trips(table(spark, folder, "documents"), vocabulary())
    n, ids_sha, text_sha = bpe.digests(F.col("ids"), F.col("decoded"))
    return both.select("doc_id", n.alias("n_tokens"), ids_sha.alias("ids_sha256"), text_sha.alias("decoded_sha256"))


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op7_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = token_files.write(table(spark, folder, "documents"), vocabulary(), END_ID)
    return token_files.read(spark, files).select("doc_id", "start", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
                                                 F.crc32("ids").alias("ids_crc32"))


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.assignments(table(spark, folder, "documents"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.removed_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                        F.concat_ws(",", F.col("removed").cast("array<string>")).alias("removed_lines"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_langid, op3_mixing, op4_warc, op5_bpe, op6_licenses, op7_embeddings,
                            op8_token_files, op9_exact_dedup, op10_line_dedup, op11_whitening, op12_prefix_trie,
                            op13_quality_rules)}
