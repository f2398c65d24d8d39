"""Embedding near-dedup over a pivot-permutation index.

A bounded sample of the vectors are pivots.  A vector is described by its nearest
pivots in order; near vectors have nearly the same.  The inverted lists are those of
pairs of pivots (both among a vector's first ``LISTED``), which keeps lists short: who
meets in one shares two pivots.  The pairs met are counted for shared pivots among the
first ``DESCRIBED``, and those with enough are verified by cosine in double precision.

Equal vectors of a label are one class from the start, so hot copies are one row.  Only
vectors of the same label and length meet.

Defined cases: vectors that are null, of norm zero, empty, or hold null or non-finite
components, and vectors without a label or ``vec_id``, link with nothing; rows that
repeat a ``vec_id`` are vectors of their own (classes are told apart by 128 bits of hash
and named by 64 of these in the index and the links).  Fewer than two pivots: one list for all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import written

COSINE = 0.98
PIVOTS = 256                  # the sample; all other bounds follow from the parameters
DESCRIBED = 10                # pivots of a description
LISTED = 6                    # of these, in the inverted lists
SHARED = 4                    # of these, that a pair must share


def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists(vec, lambda x: x != F.lit(0.0))
    return F.coalesce(~bad & some, F.lit(False))


def pivots_of(classes: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """Unit vectors of at most ``n`` classes, chosen by a hash of the vector, padded to
    one length."""
    rows = classes.select("vec", F.xxhash64("vec", F.lit(3)).alias("h")).orderBy("h").limit(n).collect()
    length = max((len(r["vec"]) for r in rows), default=0)
    out = np.zeros((len(rows), length))
    for k, r in enumerate(rows):
        out[k, :len(r["vec"])] = r["vec"]
    return out / np.linalg.norm(out, axis=1, keepdims=True) if len(out) else out


def described(vec: Column, pivots: np.ndarray, k: int = DESCRIBED) -> Column:
    """array<int>: the ``k`` nearest pivots, nearest first."""
    def run(vectors: pa.Array) -> pa.Array:
        values, ends = np.asarray(vectors.values, np.float64), np.asarray(vectors.offsets)
        x = np.zeros((len(vectors), pivots.shape[1]))
        for i, (a, b) in enumerate(zip(ends, ends[1:])):
            x[i, :min(b - a, x.shape[1])] = values[a:b][:x.shape[1]]
        near = np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :k].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1]), pa.array(near.reshape(-1)))

    return F.arrow_udf(run, "array<int>")(vec)


def cosine(a: Column, b: Column) -> Column:
    """Of arrays without nulls and of the same length, in double precision."""
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        x, y = np.asarray(left.values, np.float64), np.asarray(right.values, np.float64)
        for p, q, r, s in zip(left.offsets.to_pylist(), left.offsets.to_pylist()[1:], right.offsets.to_pylist(), right.offsets.to_pylist()[1:]):
            u, v = x[p:q], y[r:s]
            out.append(float(u @ v / np.sqrt(u @ u) / np.sqrt(v @ v)))
        return pa.array(out, pa.float64())

    return F.arrow_udf(run, "double")(a, b)


def candidates(classes: DataFrame, pivots: np.ndarray, described_by: int = DESCRIBED, listed: int = LISTED,
               shared: int = SHARED) -> DataFrame:
    """(a, b), a < b: classes of one label and length that share enough pivots."""
    index = written(classes.select("node", "label", F.size("vec").alias("length"), described(F.col("vec"), pivots, described_by).alias("near")), "pivots")
    first = F.slice("near", 1, listed)
    pairs = F.filter(F.flatten(F.transform(first, lambda p: F.transform(first, lambda q: F.struct(p.alias("p"), q.alias("q"))))),
                     lambda x: x["p"] < x["q"])
    lists = index.select("node", "label", "length", "near", F.explode(pairs).alias("list"))
    one, two = lists.alias("x"), lists.alias("y")
    met = one.join(two, (F.col("x.label") == F.col("y.label")) & (F.col("x.length") == F.col("y.length"))
                   & (F.col("x.list") == F.col("y.list")) & (F.col("x.node") < F.col("y.node")))
    enough = F.size(F.array_intersect("x.near", "y.near")) >= min(shared, len(pivots))
    return met.where(enough).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = COSINE, n_pivots: int = PIVOTS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    vec = F.col(vec_col)
    ok = usable(vec) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()
    text = F.col(label_col).cast("string")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), text.alias("label"), vec.alias("vec"), ok.alias("ok"),
                          F.xxhash64(text, vec).alias("k1"), F.xxhash64(vec, text, F.lit(1)).alias("k2"))
    classes = written(rows.where("ok").groupBy(F.col("k1").alias("node"), "k2")
                      .agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
                           F.first("vec").alias("vec")), "vector-classes")
    pivots = pivots_of(classes, n_pivots)
    found = written(candidates(classes, pivots), "vector-candidates")
    one, two = classes.select(F.col("node").alias("a"), F.col("vec").alias("va")), classes.select(F.col("node").alias("b"), F.col("vec").alias("vb"))
    links = written(found.join(one, "a").join(two, "b").where(cosine(F.col("va"), F.col("vb")) >= threshold).select("a", "b"), "vector-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = (both.join(classes.select(F.col("node").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others")))
    ends = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    named = written(classes.select("node", "k2", "least_id", "copies").join(others, F.col("node") == F.col("a"), "left")
                    .join(ends.select(F.col("node").alias("n"), "component"), F.col("node") == F.col("n"), "left")
                    .select(F.col("node").alias("c1"), F.col("k2").alias("c2"), "least_id",
                            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component"), "vector-named")
    # Components by the least id of their vectors; classes without links are their own.
    least = written(named.where("component is not null").groupBy(F.col("component").alias("c")).agg(F.min("least_id").alias("least_of")), "vector-least")
    about = written(named.join(least, F.col("component") == F.col("c"), "left")
                    .select("c1", "c2", "n_links", F.coalesce("least_of", "least_id").alias("component_id")), "vector-about")
    out = (rows.select("vec_id", "ok", "k1", "k2")
           .join(about, F.col("ok") & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left"))
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
