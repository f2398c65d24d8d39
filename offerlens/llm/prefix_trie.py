"""A prefix trie over conversations, from padded matrices of turn ids.

Every turn (role, text) gets a 128-bit id.  Conversations are sequences of ids; they are
cut into segments of ``SEGMENT`` turns, so that a row stays small however long its
conversation is, and each segment is keyed by a digest of all turns before it.  Segments
are dealt in ranges of (prefix, ids, conversation), so neighbours stand in one shard and a
sequence that very many conversations share is spread over several.

A block of a shard becomes a matrix, padded to its longest row, and is lexsorted; masks of
the columns that differ from the row above, OR-accumulated along the row, mark where nodes
start.  The first pass keeps of this how many leading turns each row shares with the row
above.  The second aggregates every depth with ``reduceat``; all sums are over rows, as each
node is counted in the one row where it starts.  Nodes that a block's edge cuts, and those
that go on in a later segment, come out in parts, which are recombined by their keys.

Defined cases: turns are ordered by (turn, id), a null turn first; the id is from the
SHA-256 of role and text, so equal rows are two equal turns; a null role or text is empty;
rows without a ``conv_id`` belong to no conversation and are left out; no conversations,
no nodes; the head of a conversation c comes from c - c % 5 with the sign of c.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

SEGMENT = 64                  # turns to a row
CELLS = 1 << 20               # turns to a padded matrix
FAMILY, LONGEST_HEAD = 5, 8   # fixed values: conversations to a family; most turns of a shared head
NONE = np.iinfo(np.int64).max
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id long, depth long, n_convs long, n_children long, n_leaves long, total long, owned long, ends string, "
        "first_end long, key binary, parent_key binary, parent_conv_id long")


def running(df: DataFrame, key: str, order: list[Column], **aggregates: str) -> DataFrame:
    """``df`` with columns that aggregate, for each row, the rows of its ``key`` up to and
    with itself: name='function:column' with function sum or bit_xor.  The rows of a key may
    span any number of tasks: they are dealt by range, and a shard's rows start from what
    the shards before it hold of the key."""
    parsed = {name: spec.split(":") for name, spec in aggregates.items()}
    rows = written(df.repartitionByRange(F.col(key), *order).sortWithinPartitions(F.col(key), *order)
                   .withColumn("_at", F.monotonically_increasing_id()).withColumn("_shard", F.shiftright("_at", 33)), "running")
    parts = rows.groupBy(F.col(key).alias("_key"), F.col("_shard").alias("_of")).agg(*[F.expr(f"{f}({c})").alias(f"_{n}") for n, (f, c) in parsed.items()])
    earlier = Window.partitionBy("_key").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    before = written(parts.select("_key", "_of", *[F.expr(f"{f}(_{n})").over(earlier).alias(f"_{n}") for n, (f, _) in parsed.items()]), "running-before")
    here = Window.partitionBy(key, "_shard").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    within = rows.select("*", *[F.expr(f"{f}({c})").over(here).alias(n) for n, (f, c) in parsed.items()])

    def joined(n, f):
        held = F.coalesce(F.col(f"_{n}"), F.lit(0))
        return (F.col(n) + held if f == "sum" else F.col(n).bitwiseXOR(held)).alias(n)

    met = within.join(before, (F.col(key) == F.col("_key")) & (F.col("_shard") == F.col("_of")))
    return met.select(*[F.col(c) for c in df.columns], *[joined(n, f) for n, (f, _) in parsed.items()])


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id, bytes): the id is 32 hexadecimal digits, the bytes those of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return written(conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32).alias("id"),
        F.octet_length(text).cast("long").alias("bytes")), "trie-turns")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, id, bytes, turns): every conversation as its family's head and its own
    rest.  One without turns has a row with a null ``pos``."""
    rows = written(running(turns.withColumn("one", F.lit(1).cast("long")), "conv_id", [F.col("turn").asc_nulls_first(), F.col("id")], nth="sum:one")
                   .select("conv_id", (F.col("nth") - 1).alias("pos"), "id", "bytes"), "trie-numbered")
    sizes = written(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    own = sizes.select(F.col("conv_id").alias("c"), "n", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("first_of"),
                       (F.crc32(F.col("conv_id").cast("string")) % (LONGEST_HEAD + 1)).alias("h"))
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("n").alias("head_n"))
    taken, rest = F.least("h", F.coalesce("head_n", F.lit(0))), F.greatest(F.col("n") - F.col("h"), F.lit(0))
    plan = written(own.join(heads, F.col("first_of") == F.col("head"), "left").select("c", "first_of", "h", taken.alias("taken"), (taken + rest).alias("turns")), "trie-plan")
    # A conversation's own turns after its head; a hot one is split by the adaptive join, as both sides are plain tables.
    tails = (rows.join(plan, F.col("conv_id") == F.col("c")).where("pos >= h")
             .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id", "bytes", "turns"))
    starts = (rows.where(F.col("pos") < LONGEST_HEAD).join(plan, F.col("conv_id") == F.col("first_of")).where("pos < h")
              .select(F.col("c").alias("conv_id"), "pos", "id", "bytes", "turns"))
    none = plan.where("turns = 0").select(F.col("c").alias("conv_id"), F.lit(None).cast("long").alias("pos"), F.lit(None).cast("string").alias("id"),
                                          F.lit(None).cast("long").alias("bytes"), "turns")
    return tails.unionByName(starts).unionByName(none)


def segments(turns: DataFrame, width: int) -> DataFrame:
    """(seg, k1, k2, ids, more, conv_id, n1, n2, lens): at most ``width`` turns to a row.
    (k1, k2) stands for all turns before the segment, (n1, n2) for those up to its end;
    ``more`` says whether the conversation goes on."""
    seg = F.coalesce(F.floor(F.col("pos") / width), F.lit(0)).cast("long")
    rows = (turns.groupBy("conv_id", seg.alias("seg"))
            .agg(F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "id", "bytes")))).alias("t"), F.max("turns").alias("turns"))
            .select("conv_id", "seg", F.unhex(F.array_join("t.id", "")).alias("ids"), F.col("t.bytes").alias("lens"),
                    ((F.col("seg") + 1) * width < F.col("turns")).alias("more"), (F.col("turns") > width).alias("several"))
            .withColumns({"d1": F.xxhash64("seg", "ids"), "d2": F.xxhash64("ids", "seg")}))
    rows = written(rows, "trie-segments")
    alone = rows.where("not several").withColumns({"n1": F.col("d1"), "n2": F.col("d2")})
    long = running(rows.where("several"), "conv_id", [F.col("seg")], n1="bit_xor:d1", n2="bit_xor:d2")
    return alone.unionByName(long).select("seg", F.col("n1").bitwiseXOR(F.col("d1")).alias("k1"), F.col("n2").bitwiseXOR(F.col("d2")).alias("k2"),
                                          "ids", "more", "conv_id", "n1", "n2", "lens")


class Block:
    """Rows of segments as a padded matrix, lexsorted."""

    def __init__(self, batch: pa.RecordBatch):
        ids = batch.column("ids").cast(pa.binary()).to_pylist()
        self.n = len(ids)
        self.len = np.array([len(x) // 16 for x in ids], np.int64)
        self.width = max(1, int(self.len.max()))
        flat = b"".join(x.ljust(16 * self.width, b"\0") for x in ids)
        turn_ids = np.frombuffer(flat, ">u8").reshape(self.n, 2 * self.width).astype(np.uint64)
        keys = [np.asarray(batch.column(c)) for c in ("seg", "k1", "k2")]
        ends = [np.asarray(batch.column(c).cast(pa.int64())) for c in ("more", "conv_id")]
        # Spark deals in signed order and lexsort follows it; the last key given is the first to sort by.
        order = np.lexsort((*ends[::-1], self.len, *turn_ids.T[::-1], *keys[::-1]))
        self.batch, self.len, self.ids = batch.take(pa.array(order)), self.len[order], [ids[k] for k in order]
        turn_ids, self.same = turn_ids[order], np.ones(self.n, bool)
        for k in keys:
            self.same[1:] &= k[order][1:] == k[order][:-1]
        self.same[0] = False
        # Column masks: does a turn differ from the one above?  A row that has ended differs from one that goes on.
        at = np.arange(self.width)
        has = at < self.len[:, None]
        pair = turn_ids.reshape(self.n, self.width, 2)
        differs = np.ones((self.n, self.width), bool)
        differs[1:] = (pair[1:] != pair[:-1]).any(2) | ~has[1:] | ~has[:-1]
        self.changed = np.logical_or.accumulate(differs, axis=1)          # a node starts here
        self.shared = np.where(self.same, (~self.changed).sum(1), -1)     # turns shared with the row above

    def column(self, name: str) -> np.ndarray:
        return np.asarray(self.batch.column(name))


def blocks(batches, cells: int):
    """Stretches of a shard's rows, each of at most ``cells`` cells once padded (one row at
    least); every one but the first starts with the last row of the one before."""
    held, wide, count = [], 1, 0
    for batch in batches:
        lengths = np.asarray(pc.binary_length(batch.column("ids").cast(pa.binary()))) // 16
        start = 0
        for k, n in enumerate(lengths.tolist()):
            wide, count = max(wide, n), count + 1
            if wide * count > cells and count > 2:
                held.append(batch.slice(start, k + 1 - start))
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, start, wide, count = [], k, max(1, n), 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def neighbours(cells: int):
    """Adds to the rows of a shard, in order, how many turns they share with the row above
    (``above``) and the row below (``below``): -1 across prefixes, null at a shard's ends."""
    def run(batches):
        first, last_above = True, None
        for block in blocks(batches, cells):
            b = Block(block)
            shared = b.shared.astype(object)
            shared[0] = last_above                                        # the first row was the last one of the block before
            out = pa.Table.from_batches([b.batch])
            table = out.append_column("above", pa.array(shared.tolist(), pa.int64()))
            table = table.append_column("below", pa.array([*b.shared[1:].tolist(), None], pa.int64()))
            if not first:
                held = held.set_column(held.schema.get_field_index("below"), "below", pa.array([int(b.shared[1]) if b.n > 1 else None], pa.int64()))
            ready = table.slice(0, b.n - 1) if first else pa.concat_tables([held, table.slice(1, max(0, b.n - 2))])
            if b.n > 1 or first:
                yield from ready.combine_chunks().to_batches()
                held, last_above, first = table.slice(b.n - 1), table["above"][b.n - 1].as_py(), False
        if not first:
            yield from held.combine_chunks().to_batches()

    return run


def node_key(seg: int, k1: int, k2: int, ids: bytes) -> bytes:
    return hashlib.blake2b(np.array([seg, k1, k2], "<i8").tobytes() + ids, digest_size=16).digest()


def nodes_of(b: Block, above: np.ndarray, below: np.ndarray, width: int):
    """The nodes that a sorted block's rows are members of, as rows of ``NODE``: whole ones
    without a key, parts with theirs."""
    seg, k1, k2, n1, n2 = (b.column(c) for c in ("seg", "k1", "k2", "n1", "n2"))
    conv, more = b.column("conv_id"), b.column("more").astype(bool)
    tail_total, tail_owned = b.column("tail_total"), b.column("tail_owned")
    leaf = np.where(more, b.column("tail_leaf"), below < b.len).astype(np.int64)
    has = np.arange(b.width) < b.len[:, None]
    byte = np.zeros((b.n, b.width), np.int64)
    byte[has] = b.batch.column("lens").flatten().to_numpy()
    starts = has & (np.arange(b.width) >= np.maximum(above, 0)[:, None])          # nodes counted in this row
    total = byte[:, ::-1].cumsum(1)[:, ::-1] + tail_total[:, None]
    owned = (byte * starts)[:, ::-1].cumsum(1)[:, ::-1] + tail_owned[:, None]
    parent = None                                                                 # of each row: (conv, key or None)
    for depth in range(b.width + 1):
        member = b.len >= depth
        new = ~b.same if depth == 0 else (np.r_[True, b.shared[1:] < depth])
        first = np.flatnonzero(member & new)
        if not len(first):
            break
        run = lambda values, ufunc=np.add, none=0: ufunc.reduceat(np.where(member, values, none), first)
        ended = member & (b.len == depth) & ~more
        last = np.append(first[1:], b.n) - 1
        count = run(member.astype(np.int64))
        last = first + count - 1                                                  # members are neighbours
        low = run(conv, np.minimum, NONE)
        children = run(starts[:, depth].astype(np.int64) if depth < b.width else np.zeros(b.n, np.int64))
        whole_depth = depth + seg[first] * width
        cut = (above[first] >= depth) | (below[last] >= depth) | (depth == 0)
        if depth == width:
            cut |= run(more.astype(np.int64)) > 0
        if depth:
            sums = [run(x).tolist() for x in (leaf, total[:, depth - 1], owned[:, depth - 1])]
        else:                                                                     # the root sums over whole rows
            sums = [run(x).tolist() for x in (leaf, total[:, 0], owned[:, 0])]
        n_ended = run(ended.astype(np.int64)).tolist()
        here_conv, here_key = np.zeros(b.n, np.int64), np.empty(b.n, object)
        rows = zip(first.tolist(), last.tolist(), count.tolist(), low.tolist(), children.tolist(), whole_depth.tolist(), cut.tolist(), n_ended, *sums)
        for i, j, n, conv_id, n_children, d, is_cut, n_ends, leaves, t, o in rows:
            key = None
            if is_cut:
                key = (node_key(int(seg[i]) + 1, int(n1[i]), int(n2[i]), b"") if depth == width
                       else node_key(int(seg[i]), int(k1[i]), int(k2[i]), b.ids[i][:16 * depth]))
            here_conv[i:j + 1], here_key[i:j + 1] = conv_id, key
            ends = ",".join(map(str, conv[i:i + n_ends].tolist())) if n_ends else ""
            if not is_cut:
                ends = hashlib.sha256(ends.encode()).hexdigest() if n_ends else EMPTY
            above_conv, above_key = (None, None) if depth == 0 else (int(parent[0][i]), parent[1][i])
            if depth == 0 and seg[i] > 0:                                         # the members were counted where the segment before ends
                yield (None, d, 0, n_children, 0, 0, 0, "", None, key, None, None)
            else:
                yield (conv_id, d, n, n_children, leaves, t, o, ends, int(conv[i]) if n_ends else None, key,
                       above_key, None if above_key is not None else above_conv)
        parent = (here_conv, here_key)


def shard_nodes(width: int, cells: int):
    def run(batches):
        out, first = [], True
        schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                            ("total", pa.int64()), ("owned", pa.int64()), ("ends", pa.string()), ("first_end", pa.int64()), ("key", pa.binary()),
                            ("parent_key", pa.binary()), ("parent_conv_id", pa.int64())])
        for batch in stretches(batches, cells):
            b = Block(batch)
            out.extend(nodes_of(b, b.column("above"), b.column("below"), width))
            while len(out) >= 10_000:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out[:10_000]), schema)], schema=schema)
                out = out[10_000:]
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def stretches(batches, cells: int):
    """As ``blocks``, without rows that come twice and never across shards."""
    held, wide, count, shard = [], 1, 0, None
    for batch in batches:
        lengths = (np.asarray(pc.binary_length(batch.column("ids").cast(pa.binary()))) // 16).tolist()
        start = 0
        for k, (n, s) in enumerate(zip(lengths, batch.column("shard").to_pylist())):
            wide, count = max(wide, n), count + 1
            if count > 1 and (wide * count > cells or s != shard):
                held.append(batch.slice(start, k - start))
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, start, wide, count = [], k, max(1, n), 1
            shard = s
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def recombined(batches):
    """Parts of nodes, sorted by (key, first_end), as whole nodes; the ids of conversations
    that end there are hashed as they stream by."""
    now, value, sha, some = None, None, None, False

    def whole():
        conv, depth, n, children, leaves, total, owned, parent_key, parent_conv = value
        return (conv, depth, n, children, leaves, total, owned, sha.hexdigest(), now, parent_key, parent_conv)

    def packed(out):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    names = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "total", "owned", "ends", "key", "parent_key", "parent_conv_id"]
    types = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary(), pa.int64()]
    for batch in batches:
        out = []
        for r in zip(*(batch.column(c).to_pylist() for c in ("key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "total", "owned", "ends", "parent_key", "parent_conv_id"))):
            if r[0] != now:
                if now is not None:
                    out.append(whole())
                now, value, sha, some = r[0], [None, r[2], 0, 0, 0, 0, 0, None, None], hashlib.sha256(), False
            if r[1] is not None:
                value[0] = r[1] if value[0] is None else min(value[0], r[1])
            for k in range(2, 7):
                value[k] += r[k + 1]
            value[7] = r[9] if value[7] is None else value[7]
            value[8] = r[10] if value[8] is None else value[8]
            if r[8]:
                sha.update((b"," if some else b"") + r[8].encode())
                some = True
        if out:
            yield packed(out)
    if now is not None:
        yield packed([whole()])


def trie(conversations: DataFrame, width: int = SEGMENT, cells: int = CELLS) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = segments(rebuilt(turns_of(conversations)), width)
    by = ["seg", "k1", "k2", "ids", "more", "conv_id"]
    kinds = "seg long, k1 long, k2 long, ids binary, more boolean, conv_id long, n1 long, n2 long, lens array<long>, shard long, above long, below long"
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("shard", F.spark_partition_id().cast("long"))
    rows = written(dealt.mapInArrow(neighbours(cells), kinds).withColumn("at", F.monotonically_increasing_id()), "trie-rows")
    # Rows at the ends of shards look at each other: one row a shard.
    ends = rows.where("above is null or below is null").select("at", *by[:4])
    pair = Window.orderBy("at")
    before, after = [[move(c).over(pair).alias(f"{c}_") for c in by[:4]] for move in (F.lag, F.lead)]
    edges = written(ends.select("at", *by[:4], *before).select("at", _shared(by[:4]).alias("edge_above"))
                    .join(ends.select(F.col("at").alias("a"), *by[:4], *after).select("a", _shared(by[:4]).alias("edge_below")), F.col("at") == F.col("a"))
                    .select(F.col("at").alias("edge"), "edge_above", "edge_below"), "trie-edges")
    rows = written(rows.join(edges, F.col("at") == F.col("edge"), "left")
                   .withColumns({"above": F.coalesce("above", "edge_above"), "below": F.coalesce("below", "edge_below")})
                   .drop("edge", "edge_above", "edge_below"), "trie-rows")
    # What later segments of a conversation hold: bytes, bytes of nodes counted there, and its leaf.
    size = F.size("lens")
    summed = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y)
    later = rows.where("seg > 0").select("conv_id", "seg", summed(F.col("lens")).alias("b"),
                                         summed(F.slice("lens", F.greatest(F.col("above"), F.lit(0)).cast("int") + 1, F.greatest(size, F.lit(1)))).alias("o"),
                                         (~F.col("more") & (F.col("below") < size)).cast("long").alias("l"))
    tails = written(running(later, "conv_id", [F.col("seg").desc()], tail_total="sum:b", tail_owned="sum:o", tail_leaf="sum:l")
                    .select(F.col("conv_id").alias("c"), (F.col("seg") - 1).alias("s"), "tail_total", "tail_owned", "tail_leaf"), "trie-tails")
    full = (rows.join(tails, (F.col("conv_id") == F.col("c")) & (F.col("seg") == F.col("s")), "left")
            .drop("c", "s").fillna(0, ["tail_total", "tail_owned", "tail_leaf"]))
    found = written(full.repartition("shard").sortWithinPartitions("shard", *by).mapInArrow(shard_nodes(width, cells), NODE), "trie-nodes")
    parts = found.where("key is not null").repartition("key").sortWithinPartitions("key", "first_end")
    whole = written(parts.mapInArrow(recombined, NODE.replace("first_end long, ", "")), "trie-whole")
    nodes = found.where("key is null").drop("first_end").unionByName(whole)
    parents = whole.select(F.col("key").alias("held"), F.col("conv_id").alias("held_conv"))
    return (nodes.join(parents, F.col("parent_key") == F.col("held"), "left")
            .select("conv_id", "depth", F.coalesce("held_conv", "parent_conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    (F.col("total") - F.col("owned")).alias("saved_tokens"), F.col("ends").alias("ends_sha256")))


def _shared(cols: list[str]) -> Column:
    """Turns that a row shares with its neighbour in the columns with ``_``; -1 for another prefix or none."""
    seg, k1, k2, ids = cols
    mine, other = F.hex(ids), F.hex(f"{ids}_")
    turns = F.least(F.length(ids), F.length(f"{ids}_")) / 16
    differ = F.array_position(F.transform(F.sequence(F.lit(1), F.greatest(turns.cast("int"), F.lit(1))),
                                          lambda k: F.substr(mine, (k - 1) * 32 + 1, F.lit(32)) == F.substr(other, (k - 1) * 32 + 1, F.lit(32))), False)
    alike = F.when(turns < 1, 0).when(differ > 0, differ - 1).otherwise(turns)
    same = F.col(seg).eqNullSafe(F.col(f"{seg}_")) & F.col(k1).eqNullSafe(F.col(f"{k1}_")) & F.col(k2).eqNullSafe(F.col(f"{k2}_"))
    return F.when(same, alike).otherwise(-1).cast("long")
