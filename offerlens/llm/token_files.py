"""Token ids in binary files: Simple-8b words in frames, and back.

A 64-bit word holds a selector in its top 4 bits and 60 bits of payload: selector s
packs ``COUNTS[s]`` ids of ``60 // COUNTS[s]`` bits, the first in the lowest bits.
Selector 0 is the escape: the payload is a place in the frame's list of values too
wide for 60 bits.  A frame holds the ids of whole documents, about ``FRAME_IDS`` of
them, and everything needed to decode it alone, all at once, without a loop over words:

    magic "S8BF", then little-endian unsigned 64-bit: part, ids of the part before this
    frame, documents, words, escapes; then 64-bit doc_ids, 8-bit "doc_id is null" flags,
    64-bit ids per document, the words, the escaped values, and one line feed.

Spark's text writer puts the frames into files, so files are committed with their task
and any Hadoop file system will do; files are read back as binary files.  Parts are
ranges of doc_id in ascending order, and frames ascend within a part, so a document's
start in the whole corpus is the sum of the parts before, the frame's place in its part
and the documents before it in the frame.

Defined cases: a null or empty text is the end id alone; a null doc_id sorts first; rows
that repeat a doc_id are ordered by a hash of their text; an empty table leaves no frame.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import codec, encoded_texts, texts_of
from .shared import shared_path, written

# Ids per word by selector; 0 is the escape.
COUNTS = (0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
MAGIC = b"S8BF"
HEAD = struct.Struct("<4s5Q")
FRAME_IDS = 1 << 16
FRAMES_PER_FILE = 64
DOC_SCHEMA = "part long, part_start long, doc_id long, ids binary"


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escaped values) of unsigned 64-bit integers."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    values = values.astype(np.uint64)
    best = np.full(n, len(COUNTS) - 1, np.uint8)          # the selector to use at each place
    wide = (values >> np.uint64(60)) > 0
    bits = np.frexp(values.astype(np.float64))[1].astype(np.uint8)     # one more than needed just below 2^53 and up
    for s in range(len(COUNTS) - 2, 0, -1):               # narrower ids, more of them per word
        c = COUNTS[s]
        run, have = np.concatenate([bits <= 60 // c, np.ones(c, bool)]), 1     # run[i]: the next `have` values fit
        while have < c:
            step = min(have, c - have)
            run = run[: len(run) - step] & run[step:]
            have += step
        run = np.flatnonzero(run[:n])
        if not len(run):                                  # then no longer run of narrower ids does
            break
        best[run] = s
    best[wide] = 0
    hop = np.array(COUNTS, np.uint8)
    hop[0] = 1
    jump, at, starts = hop[best].tobytes(), 0, []
    while at < n:
        starts.append(at)
        at += jump[at]
    starts = np.array(starts)
    chosen = best[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([values, np.zeros(60, np.uint64)])
    for s in np.unique(chosen).tolist():
        mine = np.flatnonzero(chosen == s)
        if s == 0:
            words[mine] |= np.arange(len(mine), dtype=np.uint64)
            continue
        c = COUNTS[s]
        for k in range(c):
            words[mine] |= padded[starts[mine] + k] << np.uint64(k * (60 // c))
    return words, values[wide]


def unpack(words: np.ndarray, escaped: np.ndarray, n: int) -> np.ndarray:
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS, np.int64)
    counts[0] = 1
    ends = np.cumsum(counts[selectors])
    starts = ends - counts[selectors]
    out = np.zeros(max(n, int(ends[-1]) if len(ends) else 0), np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for s in np.unique(selectors).tolist():
        mine = np.flatnonzero(selectors == s)
        if s == 0:
            out[starts[mine]] = escaped[payload[mine].astype(np.int64)]
            continue
        width = 60 // COUNTS[s]
        for k in range(COUNTS[s]):
            out[starts[mine] + k] = (payload[mine] >> np.uint64(k * width)) & np.uint64((1 << width) - 1)
    return out[:n]


def frame(part: int, before: int, doc_ids: list, sizes: list[int], ids: np.ndarray) -> bytes:
    words, escaped = pack(ids)
    return b"".join([HEAD.pack(MAGIC, part, before, len(doc_ids), len(words), len(escaped)),
                     np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
                     np.array([d is None for d in doc_ids], np.uint8).tobytes(),
                     np.array(sizes, "<u8").tobytes(), words.astype("<u8").tobytes(), escaped.astype("<u8").tobytes()])


def frames_of(content: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, memoryview]]:
    """(part, ids before, doc_ids, null flags, sizes, the rest) of each frame of a file."""
    at, view = 0, memoryview(content)
    while at < len(content):
        magic, part, before, docs, words, escaped = HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no frame at byte {at}")
        body = at + HEAD.size
        sizes = np.frombuffer(view[body + 9 * docs: body + 17 * docs], "<u8")
        end = body + 17 * docs + 8 * (words + escaped)
        yield (part, before, np.frombuffer(view[body: body + 8 * docs], "<i8"),
               np.frombuffer(view[body + 8 * docs: body + 9 * docs], np.uint8), sizes,
               view[end - 8 * (words + escaped): end - 8 * escaped], view[end - 8 * escaped: end])
        at = end + 1


def write(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encodes all texts and writes their ids, ``end_id`` after each document, in
    ascending order of doc_id.  Returns the folder."""
    path = path or shared_path(docs.sparkSession, "token-files")

    def encode(batches):
        part, c, before, doc_ids, sizes, packed, n = TaskContext.get().partitionId(), codec(vocabulary), 0, [], [], [], 0
        end = np.array([end_id], "<u4").tobytes()

        def flush():
            out = frame(part, before, doc_ids, sizes, np.frombuffer(b"".join(packed), "<u4"))
            return pa.record_batch([pa.array([out], pa.binary())], ["frame"])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded_texts(texts_of(batch.column(1)), c)):
                packed.append(ids + end)
                doc_ids.append(doc_id)
                sizes.append(len(packed[-1]) // 4)
                n += sizes[-1]
                if n >= FRAME_IDS:
                    yield flush()
                    before, doc_ids, sizes, packed, n = before + n, [], [], [], 0
        if doc_ids:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
     .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
     .mapInArrow(encode, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("maxRecordsPerFile", FRAMES_PER_FILE).text(path))
    return path


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, ids (little-endian unsigned
    32-bit integers in one binary value)."""
    def sizes(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = [(part, int(s.sum())) for part, _, _, _, s, _, _ in frames_of(content.as_py())]
                yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())],
                                      ["part", "n"])

    def documents(batches):
        for batch in batches:
            for content in batch.column(0):
                for part, before, doc_ids, none, s, words, escaped in frames_of(content.as_py()):
                    ids = unpack(np.frombuffer(words, "<u8"), np.frombuffer(escaped, "<u8"), int(s.sum())).astype("<u4").tobytes()
                    ends = np.cumsum(s.astype(np.int64))
                    starts = ends - s.astype(np.int64)
                    yield pa.record_batch([pa.array(np.full(len(s), part, np.int64)), pa.array(before + starts),
                                           pa.array(doc_ids.astype(np.int64), mask=none.astype(bool)),
                                           pa.array([ids[4 * a:4 * b] for a, b in zip(starts, ends)], pa.binary())],
                                          ["part", "part_start", "doc_id", "ids"])

    # One row per part: their running sum in one task.
    parts = (_files(spark, path).mapInArrow(sizes, "part long, n long").groupBy("part").agg(F.sum("n").alias("n"))
             .select(F.col("part").alias("part_p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")))
    parts = written(parts, "token-parts")
    return (_files(spark, path).mapInArrow(documents, DOC_SCHEMA).join(parts, F.col("part") == F.col("part_p"))
            .select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "ids"))
