"""Byte-level BPE encoding and decoding with forced boundaries.

A pair of bytes that stands inside no vocabulary token can never be merged over, so a
cut between the two is certain.  Texts are cut there, the fragments are encoded each
on its own (and remembered, as most occur again and again), and their ids concatenated.
Short fragments are remembered in a table of fixed size, in which a whole batch of them
is looked up at once; where two fall on one row, the later one stays.

Cuts also have to leave the pre-tokenizer's view of both sides as it is.  It looks
ahead only after white space and looks back nowhere, so a cut is taken only after an
ASCII character that is no white space, before the first byte of a character, and
never at an apostrophe or inside the letters of a contraction.  Special tokens are
found before anything else, as the library does.

Defined cases: a null or empty text has no ids; ids unknown to the vocabulary decode
to nothing; bytes that form no character decode to U+FFFD; null ids decode to null.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The byte-level alphabet shows these bytes as themselves, the others,
# in order, as the characters from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
# The letters of the contractions 're 've 'll that must stay together.
CONTRACTIONS = (b"re", b"ve", b"ll")

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"   # fixed value

TABLE_BITS = 20               # of the number of rows of the table of short fragments, one per Python worker
SHORT = 15                    # bytes of a short fragment
FEW = 8                       # ids of a short fragment
REMEMBERED = 50_000           # other fragments per Python worker, twice; then the older half goes
LONGEST_REMEMBERED = 48       # bytes
STRETCH = 1000                # texts that a worker encodes at a time
TOGETHER = 1 << 18            # bytes of text that are cut and looked up at a time
BETWEEN = b"\x01"             # stands between fragments that are encoded in one go
# The pattern without its look ahead, BETWEEN apart from all else.
QUICK_PATTERN = r"\x01|'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}\x01]+|\s+"
SPACES = re.compile(r"\s\s")

_OPEN: dict[str, "Codec"] = {}


def codec(path: str) -> "Codec":
    """One per worker and file."""
    if path not in _OPEN:
        _OPEN[path] = Codec(path)
    return _OPEN[path]


def byte_of_character() -> dict[str, int]:
    hidden = [b for b in range(256) if b not in set(SHOWN)]
    return {chr(b): b for b in SHOWN} | {chr(256 + i): b for i, b in enumerate(hidden)}


def cut_table(tokens: list[bytes]) -> np.ndarray:
    """For each pair of bytes, 256 * first + second: is a cut between them certain?"""
    inside = np.zeros((256, 256), bool)
    for t in tokens:
        a = np.frombuffer(t, np.uint8)
        inside[a[:-1], a[1:]] = True
    for pair in CONTRACTIONS:
        inside[pair[0], pair[1]] = True
    cut = ~inside
    cut[[*range(9, 14), 28, 29, 30, 31, 32, 39, *range(128, 256)]] = False     # white space, apostrophe, not ASCII
    cut[:, 39] = False
    cut[:, 128:192] = False                                                    # inside a character
    return cut.reshape(-1)


def _singly(fragments: list[bytes], exact) -> list[bytes]:
    return [struct.pack(f"<{len(ids)}I", *ids) for ids in (exact(f.decode()) for f in fragments)]


def _joined(fragments: list[bytes], exact, quick, between: int) -> list[bytes]:
    """Ids of many fragments from one text, in which ``BETWEEN``, a byte that no longer token
    holds, stands between them as a piece of its own; its id shows where to split.

    ``quick`` has no look ahead, which matters only for white space of two characters or
    more; fragments with that, or with that byte, are encoded by themselves.
    """
    joined, alone = BETWEEN.join(fragments).decode(), []
    if SPACES.search(joined) or joined.count(BETWEEN.decode()) != len(fragments) - 1:
        alone = [f for f in fragments if BETWEEN in f or SPACES.search(f.decode())]
        skip = set(alone)
        joined = BETWEEN.join([f for f in fragments if f not in skip]).decode()
    ids = quick(joined, allowed_special=set(), disallowed_special=()).astype("<u4")
    at, raw = (4 * np.flatnonzero(ids == between)).tolist(), ids.tobytes()
    pieces = [raw[i + 4:j] for i, j in zip([-4, *at], [*at, len(raw)])]
    if not alone:
        return pieces
    known, pieces = dict(zip(alone, _singly(alone, exact))), iter(pieces)
    return [known[f] if f in known else next(pieces) for f in fragments]


class Table:
    """Ids of fragments of at most ``SHORT`` bytes and ``FEW`` ids.  A key is the fragment's
    bytes with zeros behind and its length as the last byte, so equal keys are equal fragments.
    No key of a longer fragment is ever there.  A row of 64 bytes holds the key, the number
    of ids and the ids."""

    def __init__(self):
        self.rows = np.zeros((1 << TABLE_BITS, 8), "<u8")
        length = np.arange(SHORT + 2)
        self.inside = np.where(np.arange(16) < length[:, None], 255, 0).astype(np.uint8).view("<u8")
        self.lengths = length.astype(np.uint64) << np.uint64(56)

    def keys_of(self, a: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and row numbers of the fragments of ``sizes`` bytes that start at ``at``;
        ``a`` goes on for 16 bytes after the start of the last of them."""
        sizes = np.minimum(sizes, SHORT + 1)
        keys = np.lib.stride_tricks.sliding_window_view(a, 16)[at].view("<u8")
        keys &= self.inside[sizes]
        keys[:, 1] |= self.lengths[sizes]
        h = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h = (h + keys[:, 1]) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x9E3779B97F4A7C15)
        return keys, (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def get(self, keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which keys are there, how many ids each has (none if it is not there), and the
        ids of all that are there, one after the other."""
        held = self.rows[rows]
        there = (held[:, 0] == keys[:, 0]) & (held[:, 1] == keys[:, 1])
        counts = np.where(there, held[:, 2], 0).astype(np.int64)
        return there, counts, held.view("<u4")[:, -FEW:][np.arange(FEW) < counts[:, None]]

    def put(self, keys: np.ndarray, rows: np.ndarray, packed: list[bytes]) -> None:
        counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        few = np.flatnonzero(counts <= FEW)
        rows, first = np.unique(rows[few], return_index=True)           # one key per row
        few = few[first]
        held = np.zeros((len(few), 8), "<u8")
        held[:, :2], held[:, 2] = keys[few], counts[few]
        held.view("<u4")[:, -FEW:][np.arange(FEW) < counts[few][:, None]] = np.frombuffer(b"".join([packed[k] for k in few.tolist()]), "<u4")
        self.rows[rows] = held


class Codec:
    """Decoding needs the tokens' bytes alone; what encodes is loaded with the first
    fragment, so that workers that only decode do not hold it."""

    def __init__(self, path: str):
        self.path = path
        data = self._file()
        alphabet = byte_of_character()
        vocabulary = data["model"]["vocab"]
        added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * (1 + max([*vocabulary.values(), *added.values()]))
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token)
        self.cuts = cut_table(self.bytes_of)
        for token, i in added.items():
            self.bytes_of[i] = token.encode()
        self.special = re.compile(b"(" + b"|".join(re.escape(t.encode()) for t in added) + b")") if added else None
        self.added = {t.encode(): i for t, i in added.items()}
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.fragments = self.table = None

    def _file(self) -> dict:
        with open(self.path, encoding="utf-8") as f:
            return json.load(f)

    def _encoder(self):
        """From a list of fragments to the packed ids of each: a quick encoder for many at
        once if merges are in the order of their ids and the pre-tokenizer is the usual
        pattern, else the library."""
        data = self._file()
        vocabulary, pre = data["model"]["vocab"], data["pre_tokenizer"] or {}
        made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in data["model"]["merges"]]
        if made == sorted(made) and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space", True) and pre.get("use_regex", True):
            import tiktoken

            ranks = {self.bytes_of[i]: i for i in vocabulary.values()}
            exact, quick = (tiktoken.Encoding("fragments", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (PATTERN, QUICK_PATTERN))
            if [t for t in ranks if BETWEEN in t] != [BETWEEN]:
                return lambda fragments: _singly(fragments, exact.encode_ordinary)
            return lambda fragments: _joined(fragments, exact.encode_ordinary, quick.encode_to_numpy, ranks[BETWEEN])
        os.environ["TOKENIZERS_PARALLELISM"] = "false"                         # Spark's tasks use the cores
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return lambda fragments: [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in
                                  library.encode_batch_fast([f.decode() for f in fragments], add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        """Ids of fragments that the table does not hold; those it has no room for are kept
        in ``known``.  Once that is full it becomes ``older``, from which fragments that occur
        again come back."""
        found = {f: i for f in new if (i := self.known.get(f)) is not None} if self.known else {}
        back = {f: i for f in new if f not in found and (i := self.older.get(f)) is not None} if self.older else {}
        found.update(back)
        if len(found) < len(new):
            if self.fragments is None:
                self.fragments = self._encoder()
            unseen = [f for f in new if f not in found] if found else new
            fresh = self.fragments(unseen)
            found.update(zip(unseen, fresh))
            back.update((f, i) for f, i in zip(unseen, fresh) if len(f) <= LONGEST_REMEMBERED and (len(f) > SHORT or len(i) > 4 * FEW))
        if len(self.known) + len(back) > REMEMBERED:
            self.known, self.older = {}, self.known
        self.known.update(back)
        return found

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts without special tokens, cut and looked up together."""
        if self.table is None:
            self.table = Table()
        joined, ends, table = b"".join([*texts, bytes(16)]), np.cumsum([0, *map(len, texts)]), self.table
        a, n = np.frombuffer(joined, np.uint8), int(ends[-1])
        mark = np.zeros(n + 1, bool)
        if n > 1:
            mark[1:-1] = self.cuts[(a[:n - 1].astype(np.uint16) << 8) | a[1:n]]
        mark[ends] = True
        at = np.flatnonzero(mark)
        places, at, sizes = np.searchsorted(at, ends), at[:-1], np.diff(at)
        keys, rows = table.keys_of(a, at, sizes)
        there, counts, ids = table.get(keys, rows)
        if not there.all():
            other = np.flatnonzero(~there)
            fragments = [joined[i:j] for i, j in zip(at[other].tolist(), (at[other] + sizes[other]).tolist())]
            where = dict(zip(fragments, other.tolist()))
            found = self._learn(list(where))
            short = [f for f in where if len(f) <= SHORT]
            if short:
                which = np.array([where[f] for f in short])
                table.put(keys[which], rows[which], [found[f] for f in short])
            packed = list(map(found.__getitem__, fragments))
            counts[other] = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            late, quick = np.repeat(~there, counts), ids
            ids = np.empty(len(late), "<u4")
            ids[~late], ids[late] = quick, np.frombuffer(b"".join(packed), "<u4")
        raw, stops = ids.tobytes(), 4 * np.concatenate([[0], np.cumsum(counts)])[places]
        return [raw[i:j] for i, j in zip(stops.tolist(), stops[1:].tolist())]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if self.special is None:
            return self._plain(texts)
        # Special tokens stand at the odd places; the library encodes them as one id.
        parts = [self.special.split(t) if self.special.search(t) else [t] for t in texts]
        plain = iter(self._plain([p for some in parts for p in some[::2]]))
        return [b"".join(struct.pack("<I", self.added[p]) if k % 2 else next(plain) for k, p in enumerate(some)) for some in parts]

    def encode(self, text: bytes) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < len(self.bytes_of))]
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def texts_of(a: pa.Array):
    """The UTF-8 bytes of each text of an Arrow array, empty where null."""
    for x in a.cast(pa.binary()):
        yield x.as_py() or b""


def stretches(batches):
    """The same rows, few at a time, so that a worker holds the ids of few texts."""
    for batch in batches:
        for k in range(0, batch.num_rows, STRETCH):
            yield batch.slice(k, STRETCH)


def encoded_texts(texts, c: "Codec"):
    """The packed ids of each text, encoded some ``TOGETHER`` bytes at a time."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= TOGETHER:
            yield from c.encode_all(held)
            held, size = [], 0
    if held:
        yield from c.encode_all(held)


def id_lists(packed: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def encoded(text: Column, path: str) -> Column:
    """Ids of a text: array<int>, empty where the text is null."""
    def ids(texts: pa.Array) -> pa.Array:
        c = codec(path)
        return id_lists(list(encoded_texts(texts_of(texts), c)))

    return F.arrow_udf(ids, "array<int>")(text)


def round_trips(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): documents encoded and their ids decoded again, by one
    worker, so the ids do not go back and forth and one worker's memory is enough."""
    def run(batches):
        c = codec(path)
        for batch in stretches(batches):
            packed = list(encoded_texts(texts_of(batch.column(1)), c))
            texts = pa.array([c.decode(np.frombuffer(p, "<i4")) for p in packed], pa.string())
            yield pa.record_batch([batch.column(0), id_lists(packed), texts], ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def decoded(ids: Column, path: str) -> Column:
    """The text of an array<int> of ids."""
    def text(lists: pa.Array) -> pa.Array:
        c, values, ends = codec(path), np.asarray(lists.values), np.asarray(lists.offsets)
        return pa.array([c.decode(values[a:b]) if ok else None
                         for a, b, ok in zip(ends, ends[1:], lists.is_valid().to_pylist())], pa.string())

    return F.arrow_udf(text, "string")(ids)


def digests(ids: Column, text: Column) -> tuple[Column, Column, Column]:
    """n_tokens, SHA-256 of the decimal ids joined by commas, SHA-256 of the text."""
    return (F.size(ids).cast("long"), F.sha2(F.concat_ws(",", ids.cast("array<string>")), 256), F.sha2(text, 256))
