"""Tables, shared storage and small column helpers of the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of all contracts: space and the controls 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder below the session's ``spark.checkpoint.dir``, which driver and
    executors share.  Where it is unset, only a session on one machine may go on."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "/tmp/checkpoints"
    return f"{root.rstrip('/')}/offerlens-llm/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """The frame as a table in the shared folder: later steps neither compute it
    again nor lose it with an executor, and Spark knows its size."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as keep it apart from the
    columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def ascii_lower(c: Column) -> Column:
    """Lower case of A-Z alone."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def filter_words(n: int, per_word: int = 4, most: int = 1 << 20) -> int:
    """Words of a Bloom filter for ``n`` hashes: a power of two, at most ``most``.
    Beyond that the filter lets more rows through; results stay the same."""
    words = 1 << 10
    while words < most and words * per_word < n:
        words *= 2
    return words


def filter_word(h: Column, words: int) -> Column:
    """Which 64-bit word of the filter a hash falls in."""
    return F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(words - 1).cast("long"))


def filter_mask(h: Column) -> Column:
    """The three bits of that word that stand for the hash."""
    bits = [F.expr("1L")] * 3
    at = [F.shiftrightunsigned(h, s).bitwiseAND(F.lit(63).cast("long")).cast("int") for s in (0, 6, 12)]
    masks = [F.call_function("shiftleft", b, a) for b, a in zip(bits, at)]
    return masks[0].bitwiseOR(masks[1]).bitwiseOR(masks[2])


def bloom_filter(hashes: DataFrame, words: int) -> DataFrame:
    """(filter_word, filter_bits) of the hashes in column ``h``: at most ``words`` rows."""
    return (hashes.groupBy(filter_word(F.col("h"), words).alias("filter_word"))
            .agg(F.bit_or(filter_mask(F.col("h"))).alias("filter_bits")))


def possibly_in(df: DataFrame, h: Column, bloom: DataFrame, words: int) -> DataFrame:
    """Rows of ``df`` whose hash may be in the filter.  The broadcast is bounded by
    ``words`` rows of two longs."""
    mask = filter_mask(h)
    return (df.join(F.broadcast(bloom), filter_word(h, words) == F.col("filter_word"))
            .where(F.col("filter_bits").bitwiseAND(mask) == mask).drop("filter_word", "filter_bits"))
