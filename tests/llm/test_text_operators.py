"""Operators on documents against brute force and exact round trips."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.llm import bpe, exact_dedup, langid, licenses, line_dedup, mixing, simhash, token_files
from offerlens.llm.queries import vocabulary


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


# ---- SimHash ---------------------------------------------------------------------
def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_simhash_is_brute_force(documents, small, edges):
    texts = edges + [r.text for r in small.limit(60).collect()] + ["one two three four five six", "one two three four five sex"]
    texts += [texts[20] + " tail", texts[20]]
    fps = {k: brute_fingerprint(t) for k, t in enumerate(texts)}
    want = brute_components(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.components_of(documents(texts, clash=True)).collect()}
    assert got == {k: (fps[k], want[k]) for k in fps}


def test_bit_slices_count_distances():
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(150)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), k)) for f in fps[:80] for k in (1, 3, 4)]
    a = np.array(fps, np.uint64)
    planes = simhash.planes_of(a)
    for radius in (0, 1, 2, 3):
        near = np.concatenate([simhash.within(a[i:i + 64], planes, len(a), radius) for i in range(0, len(a), 64)])
        want = np.array([[(x ^ y).bit_count() <= radius for y in fps] for x in fps])
        assert (near == want).all()


def test_links_with_small_chunks_lose_none(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(4))) for b in base for _ in range(12)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, node long")
    from offerlens.llm.components import components
    got = {r.node: r.component for r in components(simhash.links(nodes, chunk=4)).collect()}
    want = brute_components(range(len(fps)), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 3)
    assert {k: got.get(k, k) for k in want} == want


def test_simhash_without_ids(documents):
    rows = simhash.components_of(documents([(None, "a", "en", "s"), (3, "a", "en", "s"), (None, "b b", "en", "s")])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (-1, 3), (3, 3)]


def test_simhash_and_licenses_of_no_documents(documents):
    none = documents(["x"]).limit(0)
    assert simhash.components_of(none).count() == 0 and simhash.deduplicated(none).count() == 0 and licenses.scan(none).count() == 0


def test_simhash_keeps_one_of_each(documents):
    kept = simhash.deduplicated(documents(["a b c", "a b c", None, "", "q w e r t y"], clash=True))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 4] and "fp" in kept.columns


# ---- language ID -----------------------------------------------------------------


def test_languages_held_out(small):
    rows = langid.identified(small).join(small.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 30 and sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(documents, small):
    known = small.select("doc_id", "text", "lang", "source", "n_chars")
    odd = documents([(10 ** 6 + k, t, None, None) for k, t in enumerate([None, "", "123 !?", "Ünd", "the " * 50_000])])
    got = {r.doc_id - 10 ** 6: r for r in langid.identified(known.unionByName(odd)).collect() if r.doc_id >= 10 ** 6}
    assert [got[k].lang_pred for k in range(3)] == ["und"] * 3 and got[0].score == 0.0
    assert got[3].lang_pred != "und" and got[4].lang_pred == "en"


def test_language_nothing_to_learn(documents):
    rows = langid.identified(documents([(0, "text", None, "s"), (1, "text", None, "s")])).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}
    assert {r.lang_pred for r in langid.identified(documents(["word"] * 8)).collect()} == {"en"}
    assert langid.identified(documents(["x"]).limit(0)).count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 40])
def test_codewords_differ(n):
    code = langid.codewords(n)
    assert len({tuple(c) for c in code.tolist()}) == n and (code.min(0) != code.max(0)).all()


def test_rejected_languages_go(documents, small):
    odd = documents([(10 ** 6, "42", None, None), (10 ** 6 + 1, None, None, None)], clash=True)
    assert langid.accepted(small.unionByName(odd, allowMissingColumns=True)).count() == small.count()


# ---- mixing ----------------------------------------------------------------------
def test_mix_targets(documents):
    rows = []
    for s, n in (("a", 900), ("b", 60), ("c", 40), (None, 500)):
        rows += [(len(rows) + k, "w " * (1 + k % 7), "en", s) for k in range(n)]
    mixed = mixing.mix(documents(rows, clash=True)).toPandas()
    size = mixed.groupby(mixed.source.fillna("~"))["size"].sum()
    assert (mixed.taken <= 2 * mixed["size"]).all()
    by = mixed.groupby(mixed.source.fillna("~")).agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(by.taken - by.target) <= 7).all()
    assert by.target.sum() == pytest.approx(1.5 * size.sum()) and (by.target <= 2 * size + 1e-9).all()
    # 3, 1, 2, 3 by order; b and c are at their caps, a and the null source share alike.
    assert by.target["b"] == 2 * size["b"] and by.target["c"] == 2 * size["c"]
    again = mixing.mix(documents(list(reversed(rows)))).toPandas()
    assert again.set_index("doc_id").taken.sort_index().equals(mixed.set_index("doc_id").taken.sort_index())


def test_mix_edges(documents):
    assert mixing.mix(documents(["x"]).limit(0)).count() == 0
    rows = mixing.mix(documents([(1, None, "en", None), (2, "", "en", "e"), (3, " a\x0bb ", "en", "e"), (3, "c", "en", "e"), (None, "d", "en", "f")])).collect()
    assert {(r.doc_id, r.size) for r in rows} == {(1, 0), (2, 0), (3, 2), (3, 1), (None, 1)}


def test_mixed_rows_are_the_mix(documents):
    docs = documents([(k, "w " * (k % 9), "en", f"s{k % 4}") for k in range(400)], clash=True)
    want = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    got = {r.doc_id: r["count"] for r in mixing.mixed_documents(docs).select("doc_id").groupBy("doc_id").count().collect()}
    assert got == want and mixing.mixed_documents(docs).columns == docs.columns


# ---- BPE -------------------------------------------------------------------------
def tricky():
    rng = random.Random(1)
    letters = ["a", "re", "'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", " ", " ", "é", "ß", "漢", "😀", "1", "½", "²", "!", "|", "...",
               "the", " the", "<|endoftext|>", "<|", "\x1c", "\x85", "Q", "_", "ʼ", "َ", "‍", "İ"]
    return ["".join(rng.choices(letters, k=rng.randrange(1, 25))) for _ in range(4000)]


def test_encoding_is_the_librarys(library):
    c = bpe.codec(vocabulary())
    for t in tricky():
        assert np.frombuffer(c.encode(t.encode()), "<u4").tolist() == ids_of(library, t), repr(t)


def test_every_character_encodes_as_the_librarys(library):
    c = bpe.codec(vocabulary())
    points = [p for p in range(1, 0x110000) if not 0xD800 <= p < 0xE000]
    for k in range(0, len(points), 5000):
        t = "".join(f"a{chr(p)}1{chr(p)} {chr(p)}b" for p in points[k:k + 5000:7])
        assert np.frombuffer(c.encode(t.encode()), "<u4").tolist() == ids_of(library, t)


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    c = bpe.Codec(vocabulary())
    for t in tricky()[:300]:
        assert np.frombuffer(c.encode(t.encode()), "<u4").tolist() == ids_of(library, t)


def test_a_full_table_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_BITS", 4)
    c = bpe.Codec(vocabulary())
    texts = tricky()[:1000] + ["a" * k + "." for k in range(40)] + [" \0", "\0" * 9 + "a.", "a\0.", "a.\0\0"]
    for _ in range(2):
        for t, ids in zip(texts, c.encode_all([t.encode() for t in texts])):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(library, t), repr(t)


def test_many_short_fragments_stay_known():
    """Words of one text that are met again in the next; 400,000 were remembered at most."""
    c, learned, real = bpe.Codec(vocabulary()), [], bpe.Codec._learn
    c._learn = lambda new: learned.append(len(new)) or real(c, new)
    parts = [a + b for a in "bcdfghlmnprstvw" for b in "aeiou"]
    words = ["".join(parts[k // 75 ** j % 75] for j in range(4)) for k in range(0, 75 ** 4, 63)][:500_000]
    texts = [" ".join(words[at:at + 1000]).encode() for at in range(0, len(words), 1000)]
    first = list(bpe.encoded_texts(texts, c))
    n = sum(learned)
    assert n > 400_000 and list(bpe.encoded_texts(texts, c)) == first
    assert sum(learned) - n < n / 2


def test_round_trip(documents, library, edges):
    texts = edges + tricky()[:50]
    df = documents(texts, clash=True).withColumn("ids", bpe.encoded(F.col("text"), vocabulary())).withColumn("back", bpe.decoded(F.col("ids"), vocabulary()))
    for r in df.collect():
        assert r.ids == ids_of(library, texts[r.doc_id]) and r.back == (texts[r.doc_id] or "")
    n, ids, text = bpe.digests(F.col("ids"), F.col("back"))
    for r in df.select("doc_id", n.alias("n"), ids.alias("i"), text.alias("t")).collect():
        want = ids_of(library, texts[r.doc_id])
        assert (r.n, r.i) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest())
        assert r.t == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_round_trips_in_one_worker(documents, library, edges, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH", 7)
    texts = edges + tricky()[:50]
    for r in bpe.round_trips(documents(texts, clash=True), vocabulary()).collect():
        assert r.ids == ids_of(library, texts[r.doc_id]) and r.decoded == (texts[r.doc_id] or "")
    assert bpe.round_trips(documents(["x"]).limit(0), vocabulary()).count() == 0


def test_decoding_odd_ids(spark, library):
    lists = [[447], [50256, 2], [99999, 5], [], None, [250, 250]]
    df = spark.createDataFrame([(x,) for x in lists], "ids array<int>").select("ids", bpe.decoded(F.col("ids"), vocabulary()).alias("t"))
    for r in df.collect():
        assert r.t == (None if r.ids is None else library.decode(r.ids, skip_special_tokens=False))


# ---- license scans ---------------------------------------------------------------
def brute_scan(text):
    words = licenses.words_of((text or "").encode())
    base = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.encode().split()]
    found = {}
    for b in range(0, len(words), licenses.STRIDE):
        block = set(words[b:b + licenses.BLOCK_WORDS])
        for label, t in licenses.TEMPLATES.items():
            theirs = set(licenses.words_of(t.encode()))
            part = len(block & theirs) / len(theirs)
            if part >= 0.8:
                found[label] = max(part, found.get(label, 0))
    return (len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
            sorted({x for _, x in base}), sorted({x for _, x in base} | set(found)), 1.0 if base else max(found.values(), default=0.0))


def test_licenses_are_brute_force(documents, edges):
    rng = random.Random(2)
    texts = list(edges)
    for t in licenses.TEMPLATES.values():
        words = t.split()
        for drop in (0, 1, 2, 4):
            kept = [w for k, w in enumerate(words) if k not in rng.sample(range(len(words)), min(drop, len(words)))]
            texts.append("lorem " * rng.randrange(70) + " ".join(kept).upper() + " ipsum" * rng.randrange(70))
            rng.shuffle(kept)
            texts.append(", ".join(kept))
    texts += ["ALL rights\n\nreserved; all rights, reserved all rights", "cc-by CC  BY", "General Public licence license", "all " * 100]
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(documents(texts, clash=True)).collect()}
    assert got == {k: brute_scan(t) for k, t in enumerate(texts)}


# ---- token files -----------------------------------------------------------------
def test_simple8b_round_trip():
    rng = np.random.default_rng(3)
    for bits in (1, 3, 8, 16, 30, 59, 60, 61, 64):
        for n in (1, 2, 59, 60, 61, 1000):
            v = rng.integers(0, 1 << bits, n, dtype=np.uint64, endpoint=False) if bits < 64 else rng.integers(0, np.iinfo(np.uint64).max, n, dtype=np.uint64)
            v[rng.random(n) < 0.3] >>= np.uint64(bits // 2)
            words, escaped = token_files.pack(v)
            assert (token_files.unpack(words, escaped, n) == v).all()
    assert len(token_files.pack(np.zeros(0, np.uint64))[0]) == 0
    assert len(token_files.pack(np.zeros(6000, np.uint64))[0]) == 100


def test_token_files_round_trip(spark, documents, library, edges, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 100)
    texts = edges + tricky()[:200]
    random.Random(4).shuffle(texts)
    docs = documents(texts, clash=True).repartition(5)
    got = {r.doc_id: r for r in token_files.read(spark, token_files.write(docs, vocabulary(), 2)).collect()}
    start = 0
    for k, t in enumerate(texts):
        ids = np.array([*ids_of(library, t), 2], "<u4")
        assert (got[k].start, zlib.crc32(bytes(got[k].ids))) == (start, zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(texts)


def test_token_files_edges(spark, documents):
    none = token_files.write(documents(["x"]).limit(0), vocabulary(), 2)
    assert token_files.read(spark, none).count() == 0
    rows = token_files.read(spark, token_files.write(documents([(None, "a", "en", "s"), (1, "b", "en", "s"), (1, "b", "en", "s"), (-5, None, "en", "s")]), vocabulary(), 2)).collect()
    assert sorted((r.start, r.doc_id) for r in rows) == [(0, None), (2, -5), (3, 1), (5, 1)]


# ---- exact dedup -----------------------------------------------------------------
def brute_exact(rows):
    import re

    groups = {}
    for k, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(k)
    return {k: (min(ids), len(ids), k == min(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for k in ids}


def test_exact_dedup_is_brute_force(documents, edges):
    texts = edges + ["a  b", "a b", "a\tb", " a b", "same"] + ["same"] * 500 + [f"text {k % 300}" for k in range(900)]
    docs = documents(texts, clash=True).repartition(7)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.assignments(docs).collect()}
    want = brute_exact(list(enumerate(texts)))
    assert got == want
    kept = exact_dedup.deduplicated(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, v in want.items() if v[2]) and kept.columns == docs.columns


def test_exact_dedup_saturated_filter(spark, documents, monkeypatch):
    monkeypatch.setattr(exact_dedup, "filter_words", lambda n: 1)
    texts = [f"text {k % 200}" for k in range(300)]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.assignments(documents(texts)).collect()}
    assert got == brute_exact(list(enumerate(texts)))


def test_exact_dedup_edges(documents):
    assert exact_dedup.assignments(documents(["x"]).limit(0)).count() == 0
    rows = exact_dedup.assignments(documents([(None, "a", "en", "s"), (4, "a", "en", "s"), (4, "a", "en", "s")])).collect()
    assert sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept) for r in rows) == [(-1, 4, 3, False), (4, 4, 3, True), (4, 4, 3, True)]
    assert [r.doc_id for r in exact_dedup.deduplicated(documents([(None, "a", "en", "s"), (4, "a", "en", "s"), (4, "a", "en", "s")])).collect()] == [4]


# ---- line dedup ------------------------------------------------------------------
def brute_lines(texts):
    lines = [(d, k, frozenset(w for w in x.lower().replace("\x0b", " ").replace("\t", " ").split(" ") if w))
             for d, t in enumerate(texts) if t is not None for k, x in enumerate(t.split("\n"))]
    gone = {d: [] for d in range(len(texts))}
    for i, (d, k, s) in enumerate(lines):
        if s and any(len(s & t) * 9 >= 4 * (len(s) + len(t)) for _, _, t in lines[:i] if t):
            gone[d].append(k)
    return gone


def variants():
    rng = random.Random(7)
    words = [f"w{k}" for k in range(60)]
    base = [rng.choices(words, k=rng.randrange(1, 40)) for _ in range(25)]
    texts = []
    for _ in range(60):
        out = []
        for _ in range(rng.randrange(1, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.randrange(4)):
                line[rng.randrange(len(line))] = rng.choice(words)
            out.append(" ".join(line))
        texts.append("\n".join(out))
    return texts


def test_line_dedup_is_brute_force(documents):
    texts = variants() + [None, "", "\n\n", "W1 w2\tw3\nw3 w2 W1", "z " * 5000, " y "]
    got = {r.doc_id: r for r in line_dedup.removed_lines(documents(texts, clash=True).repartition(5)).collect()}
    assert {k: r.removed for k, r in got.items()} == brute_lines(texts)
    assert {k: r.n_lines for k, r in got.items()} == {k: 0 if t is None else len(t.split("\n")) for k, t in enumerate(texts)}


def test_line_dedup_texts(documents):
    texts = ["keep this line here\nother words stand there", "Keep this LINE here\n\nnew words altogether now", None]
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(documents(texts, clash=True)).collect()}
    assert got == {0: texts[0], 1: "\nnew words altogether now", 2: None}


def test_line_dedup_of_a_large_group(documents, monkeypatch):
    """Near copies cost their number: all meet the head of a word, few are left to pair."""
    rng = random.Random(3)
    base = [f"b{k}" for k in range(30)]
    texts = [" ".join(base if k == 0 else base[:at] + [f"n{k}"] + base[at + 1:]) for k in range(150) for at in [rng.randrange(30)]]
    texts += variants()
    pairs, real = {}, line_dedup.written

    def counted(df, tag):
        out = real(df, tag)
        pairs[tag] = out.count() if tag in ("line-heads", "line-pairs") else None
        return out

    monkeypatch.setattr(line_dedup, "written", counted)
    got = {r.doc_id: r.removed for r in line_dedup.removed_lines(documents(texts)).collect()}
    assert got == brute_lines(texts)
    assert pairs["line-heads"] + pairs["line-pairs"] < 150 * 149 / 8


def test_line_dedup_pairs_no_settled_line(documents, monkeypatch):
    """What a head has removed is an earlier partner at most, and each word has several heads."""
    rng = random.Random(8)
    base = [f"b{k}" for k in range(40)]
    texts = []
    for k in range(240):
        out = set(rng.sample(range(40), rng.randrange(7)))
        texts.append(" ".join(f"n{k}x{j}" if j in out else w for j, w in enumerate(base)))
    texts += variants()
    frames, real = {}, line_dedup.written

    def kept(df, tag):
        frames.setdefault(tag, []).append(real(df, tag))
        return frames[tag][-1]

    monkeypatch.setattr(line_dedup, "written", kept)
    rows = documents([(None if k == 200 else k, t, "en", "s") for k, t in enumerate(texts)])
    got = {r.doc_id: r.removed for r in line_dedup.removed_lines(rows).collect()}
    want = brute_lines(texts[:200] + texts[201:] + texts[200:201])
    ids = [*range(200), *range(201, len(texts)), None]
    assert got == {ids[k]: v for k, v in want.items()}
    soon = {r.late for r in frames["line-soon"][0].collect()}
    assert soon and not soon & {r.late for r in frames["line-turned"][1].collect()}


def test_line_dedup_heads_need_no_join(documents, monkeypatch):
    """A word's head comes out of the sum that counts its classes, whose rows are not sorted."""
    plans, real = {}, line_dedup.written

    def kept(df, tag):
        plans.setdefault(tag, df._jdf.queryExecution().executedPlan().toString())
        return real(df, tag)

    monkeypatch.setattr(line_dedup, "written", kept)
    texts = variants()
    assert {r.doc_id: r.removed for r in line_dedup.removed_lines(documents(texts)).collect()} == brute_lines(texts)
    assert "HashAggregate" in plans["line-head"] and "Join" not in plans["line-head"] and "SortAggregate" not in plans["line-head"]


def test_line_dedup_white_space(documents):
    lines = ["", " ", "A b", " a", "a ", "a  b", "a\tb", "a\x0bb", "a\x0cB c", "a\rb", "\t", "\u00a0 \u2003x", "\x1cy \x85"]
    got = documents(lines).select("doc_id", line_dedup.words_of(F.col("text")).alias("w")).collect()
    assert {r.doc_id: r.w for r in got} == {k: re.findall(r"[^\x20\x09-\x0D]+", t.lower()) for k, t in enumerate(lines)}


def test_line_dedup_edges(documents):
    assert line_dedup.removed_lines(documents(["x"]).limit(0)).count() == 0
    rows = line_dedup.removed_lines(documents([(None, "a b", "en", "s"), (7, "a b", "en", "s"), (7, "c", "en", "s"), (8, "c", "en", "s")])).collect()
    assert sorted((r.doc_id or -1, r.removed) for r in rows) == [(-1, [0]), (7, []), (7, []), (8, [0])]


def test_line_dedup_of_one_word_lines(documents):
    """These two have equal parities and 24 equal bits of hash."""
    assert [r.removed for r in line_dedup.removed_lines(documents(["item220255", "item232977"])).collect()] == [[], []]
