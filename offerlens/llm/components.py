"""Connected components of a graph too large for one machine.

Rounds of large-star and small-star: every node hands its larger, then its smaller
neighbours to the least node it knows of.  The edges end as stars around the least
node of each component.  Each round is written to the shared folder, which cuts the
lineage and lets Spark split the join at a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(edges: DataFrame, tag: str) -> DataFrame:
    return written(edges.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("node")).alias("m")), tag)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long), component being the
    least node reachable.  Loops are allowed; nulls are not."""
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both, "least")
        # Large star: neighbours above a node go to the least of its neighbourhood.
        large = written(both.where("v > u").join(least, F.col("u") == F.col("node"))
                        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "edges")
        # Small star: of the neighbours below, all go to the least.
        least = _least(large, "least")
        new = written(large.join(least, F.col("u") == F.col("node")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .where("u <> v").unionByName(least.select(F.col("node").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        after = _state(new)
        if after == state:
            break
        now, state = new, after
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
