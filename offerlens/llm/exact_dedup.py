"""Exact dedup: two passes over a Bloom filter, then only possible repeats shuffle.

Pass 1 counts, in a filter of slots, how many rows touch each slot; a slot touched
twice sets a bit.  Pass 2 probes every row: a hash whose bits are not all set occurs
once, so its row passes straight through.  The rest is grouped by the SHA-256 of the
normalised text, so false positives of the filter only cost a shuffled row.

Defined cases: a null text counts as empty; all empty texts are one group.  Among
equal texts the smallest ``doc_id`` stays, a null ``doc_id`` comes last; where rows
repeat that ``doc_id``, each of them is marked as kept.  Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, filter_word, filter_words, fresh, written


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _slots(h: Column, words: int) -> list[Column]:
    """The two slots of a hash, both in the same 64-bit word."""
    base = filter_word(h, words) * 64
    return [base + F.shiftrightunsigned(h, s).bitwiseAND(F.lit(63).cast("long")) for s in (0, 6)]


def repeated_filter(hashes: DataFrame, words: int) -> DataFrame:
    """(filter_word, filter_bits) with a bit for each slot that two rows or more touch:
    at most ``words`` rows."""
    first, second = _slots(F.col("h"), words)
    touched = (hashes.select(F.explode(F.array_distinct(F.array(first, second))).alias("slot"))
               .groupBy("slot").count().where("count > 1"))
    return (touched.groupBy(F.shiftright("slot", 6).alias("filter_word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("filter_bits")))


def _mask(h: Column) -> Column:
    bits = [F.call_function("shiftleft", F.expr("1L"),
                            F.shiftrightunsigned(h, s).bitwiseAND(F.lit(63).cast("long")).cast("int"))
            for s in (0, 6)]
    return bits[0].bitwiseOR(bits[1])


def split_by_filter(df: DataFrame, h: Column, bloom: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Rows that occur once for certain, and rows that may repeat."""
    word, bits, maybe = fresh(df, "filter_word", "filter_bits", "maybe")
    probed = (df.join(F.broadcast(bloom.select(F.col("filter_word").alias(word), F.col("filter_bits").alias(bits))),
                      filter_word(h, words) == F.col(word), "left")
              .withColumn(maybe, F.coalesce(F.col(bits).bitwiseAND(_mask(h)) == _mask(h), F.lit(False))))
    return probed.where(~F.col(maybe)).drop(word, bits, maybe), probed.where(maybe).drop(word, bits, maybe)


def assignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    text = normalised(F.col(text_col))
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("h"),
                               F.sha2(text, 256).alias("text_sha256")), "exact-hashes")
    words = filter_words(rows.count())
    bloom = written(repeated_filter(rows.select("h"), words), "exact-filter")
    once, maybe = split_by_filter(rows, F.col("h"), bloom, words)
    # Written, so that the join below has two plain inputs and a hot text can be split.
    groups = written(maybe.groupBy(F.col("text_sha256").alias("sha"))
                     .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                     .where("group_size > 1"), "exact-groups")
    repeats = (maybe.join(groups, F.col("text_sha256") == F.col("sha"), "left")
               .select("doc_id", F.when(F.col("sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                       F.coalesce("group_size", F.lit(1)).alias("group_size"),
                       (F.col("sha").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
                       "text_sha256"))
    return once.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                       F.lit(True).alias("kept"), "text_sha256").unionByName(repeats)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns of ``docs``.  Rows the filter clears
    never shuffle; of the others, each text keeps the row with the smallest id (one
    row, also where that id repeats)."""
    h, sha = F.xxhash64(normalised(F.col(text_col))), F.sha2(normalised(F.col(text_col)), 256)
    hashes = written(docs.select(h.alias("h")), "exact-hashes")
    words = filter_words(hashes.count())
    bloom = written(repeated_filter(hashes, words), "exact-filter")
    own, sha_col, row = fresh(docs, "h", "sha", "row")
    once, maybe = split_by_filter(docs.withColumn(own, h), F.col(own), bloom, words)
    # min_by over the row: partial first, so a hot text sends one row per task.
    best = (maybe.groupBy(sha.alias(sha_col))
            .agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]),
                          F.struct(F.col(id_col).isNull(), F.col(id_col))).alias(row)))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(best.select(f"{row}.*"))
