import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
# Columns whose names the operators might use themselves.
CLASHING = ("h", "fp", "node", "size", "line", "count", "part", "threshold", "filter_word", "filter_bits", "maybe", "sha", "row",
            "gone", "_gone", "gone_doc", "_gone_doc", "mix_source", "_mix_source", "mix_copy", "_dedup_h")


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from texts, with ids from 0, or from (id, text, lang, source) rows."""
    def build(rows, clash=False):
        rows = [(k, r, "en", f"s{k % 2}") if not isinstance(r, tuple) else r for k, r in enumerate(rows)]
        df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
        for c in CLASHING if clash else ():
            df = df.withColumn(c, df["n_chars"])
        return df
    return build


# Nulls, empty and blank texts, repeats, a very long text, and one with characters of
# one to four bytes.
EDGES = [None, "", " \t\n ", "one", "one", "Two words", "a b c d e f", "é ß 漢字 😀 naïve", "x" * 50_000,
         "word " * 20_000, "one\x0btwo\x1cthree", None]


@pytest.fixture()
def edges():
    return list(EDGES)


@pytest.fixture(scope="session")
def small(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
