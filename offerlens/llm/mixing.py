"""Mixing sources to target weights by hash-threshold histograms.

Words are summed by source and hash bucket; the running sum finds the bucket that
holds a source's budget; only that bucket is refined, level by level, down to single hash
values.  A document is in when its hash is at most its source's threshold: no sort,
and the same choice on every run.  Targets above a source's size take every document
once and the rest of the target a second time.

Defined cases: a null text has size 0; a null source is a source of its own, last in
order; sizes and takes of rows that repeat a ``doc_id`` count each, and they are in or
out together.  A null ``doc_id`` hashes like an empty string.  The boundary document
is taken if that brings its source nearer to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, fresh, written

WEIGHTS = (3, 1, 2)           # repeating, over the sources in order
SHARE = 1.5                   # of all words
MOST = 2                      # times a source's own words
LEVELS = (10, 10, 10)         # bits of the hash per histogram: 1,024 buckets per source; 30 more remain


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(doc_id: Column) -> Column:
    """60 bits of MD5, which any SQL engine can compute as well."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.
    With caps in order of cap per weight, the capped sources are a prefix; all others
    get the same amount per weight.  One task, one row per source."""
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    w = (sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int")))
         .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
         .withColumn("budget", F.lit(float(share)) * F.sum("source_size").over(every))
         .withColumn("per_weight", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
         .withColumn("capped", F.col("cap") <= F.col("per_weight") * F.col("w")))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("w"), "per_weight"))).over(every)["per_weight"]
    return w.select("source", "source_size", F.when(F.col("capped"), F.col("cap"))
                    .otherwise(F.least("cap", level * F.col("w"))).alias("target"))


def _boundary(rows: DataFrame, budgets: DataFrame, bucket: Column) -> DataFrame:
    """Per source: the bucket where the running sum passes what is ``left``, with the
    words ``left`` for it.  Sources whose budget covers all their rows have none."""
    hist = (rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")))
    run = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    return (hist.withColumn("run", run).join(budgets, hist["source"].eqNullSafe(budgets["source_b"]))
            .where((F.col("run") > F.col("left")) & (F.col("run") - F.col("words") <= F.col("left")) & (F.col("words") > 0))
            .select("source", "bucket", (F.col("left") - (F.col("run") - F.col("words"))).alias("left"), "words"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): hashes up to it are in.  ``rows``: source, size, h;
    ``budgets``: source, left."""
    h, bits = F.col("h"), 60
    edge, inner = budgets.select(F.col("source").alias("source_b"), "left"), rows
    for step in LEVELS:
        bits -= step
        part = written(_boundary(inner, edge, F.shiftright(h, bits)), "mix-bucket")
        inner = (inner.join(part.select(F.col("source").alias("source_p"), "bucket"),
                            F.col("source").eqNullSafe(F.col("source_p")) & (F.shiftright(h, bits) == F.col("bucket")))
                 .drop("source_p", "bucket"))
        edge = part.select(F.col("source").alias("source_b"), "left")
    last = _boundary(inner, edge, h)
    # Half a document or more left over: the boundary document is in.
    return last.select("source", F.when(F.col("left") * 2 >= F.col("words"), F.col("bucket"))
                       .otherwise(F.col("bucket") - 1).alias("threshold"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, copies."""
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                               words_of(F.col(text_col)).alias("size"), hash60(F.col(id_col)).alias("h")), "mix-rows")
    goal = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
                   .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                               .otherwise(0).cast("long"))
                   .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    edge = thresholds(rows, goal.select("source", "left"))
    plan = written(goal.join(edge.withColumnRenamed("source", "source_e"),
                             F.col("source").eqNullSafe(F.col("source_e")), "left")
                   .select(F.col("source").alias("source_t"), "source_size", "target", "whole",
                           F.coalesce("threshold", F.lit(-1)).alias("threshold")), "mix-plan")
    copies = F.col("whole") + (F.col("h") <= F.col("threshold")).cast("long")
    # One row per source: Spark broadcasts the plan by its size, else splits a hot source.
    return (rows.join(plan, F.col("source").eqNullSafe(F.col("source_t")))
            .select("doc_id", "source", "size", "source_size", "target",
                    (copies * F.col("size")).alias("taken"), copies.alias("copies"), "h", "threshold", "whole"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix, a row for each time a document is taken, with the
    columns of ``docs``.  The rows are filtered in place by their source's threshold."""
    source, threshold, whole, copy = fresh(docs, "mix_source", "mix_threshold", "mix_whole", "mix_copy")
    plan = written(mix(docs, id_col, text_col, source_col).groupBy(F.col("source").alias(source))
                   .agg(F.max("threshold").alias(threshold), F.max("whole").alias(whole)), "mix-thresholds")
    copies = F.col(whole) + (hash60(F.col(id_col)) <= F.col(threshold)).cast("long")
    return (docs.join(plan, F.col(source_col).cast("string").eqNullSafe(F.col(source)))
            .withColumn(copy, F.explode(F.when(copies > 0, F.sequence(F.lit(1).cast("long"), copies))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
