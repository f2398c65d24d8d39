"""SimHash near-dedup with bit-sliced comparison.

Fingerprints of all documents are computed in one pass; equal ones become one node, so
a hot group of copies is one row from there on.  Two fingerprints within the radius
agree on all bits of some ``BANDS - RADIUS`` out of ``BANDS`` bands, so each node goes
to one bucket per such choice.  Buckets are packed into blocks; in a block, bit planes
stand vertically (64 fingerprints to a word), carry-save counters update the distances
of a slab of fingerprints to all others at once, and a slab is abandoned as soon as
every distance is beyond the radius.  A bucket that is too large for one block is cut
into chunks, and every pair of its chunks meets in a block.

A block hands on a spanning forest of its links, never all pairs.

Defined cases: a null, empty or blank text has fingerprint 0 and is linked like any
other; rows without a ``doc_id`` get a fingerprint, and their component if another
document has the same fingerprint, but carry no links of their own; rows that repeat a
``doc_id`` are alike.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import texts_of
from .components import components
from .shared import fresh, written

SHINGLE = 3                   # words
RADIUS = 3                    # differing bits
BANDS = 5
BLOCK = 2048                  # fingerprints to a block or chunk
SLAB = 64                     # fingerprints compared with a block at once
ALL = np.uint64(0xFFFF_FFFF_FFFF_FFFF)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    from xxhash import xxh64_intdigest

    words = text.lower().split()          # of bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else iter([b" ".join(words)])
    n = max(1, len(words) - shingle + 1)
    ones, done = np.zeros(64, np.int64), 0
    hashes = map(xxh64_intdigest, shingles, repeat(42))
    while done < n:                       # bits of a stretch of hashes, summed
        h = np.fromiter(hashes, np.uint64, min(n - done, 1 << 14))
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        done += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column) -> Column:
    """The fingerprint's 64 bits as a long."""
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t) for t in texts_of(texts)], np.uint64).view(np.int64))

    return F.arrow_udf(run, "long")(text)


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def band_masks(bands: int = BANDS, radius: int = RADIUS) -> list[int]:
    edges = [round(64 * k / bands) for k in range(bands + 1)]
    one = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(one, bands - radius)]


def planes_of(fps: np.ndarray) -> np.ndarray:
    """64 bit planes of ``fps``, 64 fingerprints to a word."""
    padded = np.zeros(-len(fps) % 64 + len(fps), np.uint64)
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def within(slab: np.ndarray, planes: np.ndarray, n: int, radius: int = RADIUS) -> np.ndarray:
    """bool [len(slab), n]: is the distance at most ``radius`` (0 to 3)?  Counters of two
    bits in carry-save form: ``one`` and ``two``; ``gone`` once a distance is beyond."""
    one = np.zeros((len(slab), planes.shape[1]), np.uint64)
    two, gone = one.copy(), one.copy()
    for b in range(64):
        flip = np.where((slab >> np.uint64(b)) & np.uint64(1), ALL, np.uint64(0))[:, None]
        x = planes[b] ^ flip
        carry = one & x
        one ^= x
        x = two & carry
        two ^= carry
        gone |= x                                             # four or more
        if radius < 3:
            gone |= (two & one) if radius == 2 else two if radius == 1 else (one | two)
        if b % 8 == 7 and (gone == ALL).all():
            return np.zeros((len(slab), n), bool)
    return np.unpackbits((~gone).view(np.uint8), axis=1, bitorder="little")[:, :n].astype(bool)


def forest(fps: np.ndarray) -> np.ndarray:
    """For each fingerprint, the first place of its component within the block."""
    order = np.argsort(fps, kind="stable")
    s = fps[order]
    lead = np.concatenate([[True], s[1:] != s[:-1]])          # equal ones are linked without comparing
    distinct, group = s[lead], np.cumsum(lead) - 1
    label, planes = np.arange(len(distinct)), planes_of(distinct)
    for at in range(0, len(distinct), SLAB):
        near = within(distinct[at:at + SLAB], planes, len(distinct))
        for k in np.flatnonzero(near.sum(1) > 1) if near.any() else ():
            met = np.unique(label[near[k]])
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    out = np.empty(len(fps), np.int64)
    out[order] = label[group]
    first = np.full(len(distinct), len(fps))
    np.minimum.at(first, out, np.arange(len(fps)))
    return first[out]


def block_links(batches):
    """Links of a partition whose rows (bucket columns, fp, node) are sorted by bucket."""
    held_fp, held_node, held_key = [], [], []

    def links():
        fps, nodes = np.concatenate(held_fp), np.concatenate(held_node)
        root = forest(fps)
        mine = np.flatnonzero(root != np.arange(len(fps)))
        out = np.unique(np.stack([nodes[mine], nodes[root[mine]]], 1), axis=0) if len(mine) else np.zeros((0, 2), np.int64)
        return pa.record_batch([pa.array(out[:, 0]), pa.array(out[:, 1])], ["u", "v"])

    for batch in batches:
        key = np.stack([np.asarray(batch.column(k)) for k in range(4)], 1)
        fps, nodes = np.asarray(batch.column(4)).view(np.uint64), np.asarray(batch.column(5))
        starts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
        for a, b in zip(starts, starts[1:]):
            # A block ends with a bucket, once it has enough rows.
            if held_key and sum(map(len, held_fp)) >= BLOCK and not (held_key[-1] == key[a]).all():
                yield links()
                held_fp, held_node, held_key = [], [], []
            held_fp.append(fps[a:b])
            held_node.append(nodes[a:b])
            held_key = [key[a]]
    if held_fp:
        yield links()


def links(nodes: DataFrame, bands: int = BANDS, radius: int = RADIUS, chunk: int = BLOCK) -> DataFrame:
    """Links (u, v) between ``nodes`` (fp, node; fp distinct) that connect all pairs
    within the radius, directly or by way of others."""
    masks = band_masks(bands, radius)
    keyed = nodes.select(F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m))
                                                for m in masks])).alias("band", "key"), "fp", "node")
    # Buckets of one are no candidates; a large one is cut.  Written, so that the join
    # has two plain inputs.
    sizes = written(keyed.groupBy(F.col("band").alias("band_s"), F.col("key").alias("key_s")).count().where("count > 1")
                    .withColumn("chunks", F.ceil(F.col("count") / chunk).cast("int")), "buckets")
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    met = (keyed.join(sizes, (F.col("band") == F.col("band_s")) & (F.col("key") == F.col("key_s")))
           .withColumn("mine", mine).withColumn("other", other)
           .select("band", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp", "node"))
    by = ["band", "key", "i", "j"]
    return met.repartition(*by).sortWithinPartitions(*by).mapInArrow(block_links, "u long, v long")


def components_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fp (long), component_id (least doc_id reachable)."""
    rows = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), fingerprints(F.col(text_col)).alias("fp")), "simhash")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"), "simhash-nodes")
    found = components(links(nodes))
    classes = written(nodes.join(found.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
                      .select(F.col("fp").alias("fp_c"), F.coalesce("component", "node").alias("component_id")), "simhash-classes")
    return (rows.join(classes, F.col("fp") == F.col("fp_c"), "left").select("doc_id", "fp", "component_id"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the least id, with the columns of
    ``docs``; documents without an id stay."""
    own, = fresh(docs, "gone")
    gone = written(components_of(docs, id_col, text_col).where("doc_id <> component_id")
                   .select(F.col("doc_id").alias(own)).distinct(), "simhash-gone")
    return docs.join(gone, F.col(id_col) == F.col(own), "left_anti")
