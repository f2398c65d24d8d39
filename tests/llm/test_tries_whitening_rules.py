"""op11 to op13: against brute force, on edges, and the pipeline as a whole."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offerlens.llm import prefix_trie, quality, whitening
from offerlens.llm.oracle import SQL
from offerlens.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string, at long, key string, shard long"


# ---- conversation prefix trie ------------------------------------------------------
def brute_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            convs[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + v[h:]
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((m[0], len(p), members[p[:-1]][0] if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in m if len(whole[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def conversations(rng, many=60):
    rows = []
    for c in [*range(many), -7, -5, 1 << 40]:
        hot = rng.random() < 0.4
        for t in range(rng.choice([1, 1, 2, 3, 5, 8, 11])):
            rows.append((c, t, rng.choice(["user", "user", None]), f"hot {t}" if hot else rng.choice(["", None, "é漢", "a", "b" * rng.randrange(4)])))
    long = [(many * 5, t, "user", f"t{t % 3}") for t in range(150)]
    rows += long + [(many * 5 + 1, *r[1:]) for r in long] + [(many * 5 + 5, *r[1:]) for r in long[:90]]
    rows += [(3, 0, "user", "a"), (3, 0, "user", "a"), (4, None, "user", "z"), (4, None, None, None), (None, 1, "user", "lost"), (6, None, None, "x" * 50_000)]
    rng.shuffle(rows)
    return [(*r, k, str(k), 0) for k, r in enumerate(rows)]


@pytest.mark.parametrize("width, cells", [(prefix_trie.SEGMENT, prefix_trie.CELLS), (4, 24), (1, 3), (64, 100)])
def test_trie_is_brute_force(spark, width, cells):
    rows = conversations(random.Random(width))
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    got = prefix_trie.trie(df, width, cells)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(tuple(-1 if x is None else x for x in r) for r in got.collect()) == brute_trie(rows)


def test_trie_edges(spark):
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    # Conversations whose head and rest are both empty are members of the root alone.
    turnless = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:20]
    rows = [(c, 1, "user", "x", 0, "", 0) for c in turnless]
    r, = prefix_trie.trie(spark.createDataFrame(rows, TURNS)).collect()
    assert (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) == (turnless[0], 0, None, 20, 0, 1, 0)
    assert r.ends_sha256 == hashlib.sha256(",".join(map(str, turnless)).encode()).hexdigest()


def test_running_sums_over_shards(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3]), k, rng.randrange(100)) for k in range(3000)]
    df = spark.createDataFrame(rows, "k long, o long, v long").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = {(r.k, r.o): (r.s, r.x) for r in prefix_trie.running(df, "k", [F.col("o")], s="sum:v", x="bit_xor:v").collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    s, x = Counter(), Counter()
    for k, o, v in rows:
        s[k] += v
        x[k] ^= v
        assert got[k, o] == (s[k], x[k])


# ---- whitening -----------------------------------------------------------------------
VECTORS = "vec_id long, embedding array<float>, label int, c long, x long, component long"


def check_whitened(got, rows, components=16):
    """Against an eigendecomposition of the covariance."""
    ok = [(i, v) for i, v, *_ in rows if v is not None and all(e is not None and math.isfinite(e) for e in v)]
    ok = [(i, v) for i, v in ok if len(v) == max(len(w) for _, w in ok)]
    x = np.floor(64 * np.array([v for _, v in ok], np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    a = (n * fit - sums) / n
    e, q = np.linalg.eigh(a.T @ a / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    assert len(got) == k * len(ok)
    seen = defaultdict(list)
    for r in got:
        seen[r.component].append(r)
    clear = [j for j in range(k) if min([abs(e[j] - e[m]) for m in range(len(e)) if m != j], default=1) > 1e-4 * e[0]]
    for j in range(k):
        part = seen[j + 1]
        assert sorted((r.vec_id, r.deviation) for r in part) == sorted((i, int(((n * y - sums) ** 2).sum())) for (i, _), y in zip(ok, x))
        assert {r.n for r in part} == {n} and all(math.isclose(r.explained, e[j] / e.sum(), rel_tol=1e-9) for r in part)
        assert {r.identity_error for r in part} == {got[0].identity_error} and got[0].identity_error < 1e-9
        if j in clear:
            want = sorted((i, w) for (i, _), w in zip(ok, (n * x - sums) / n @ q[:, j] / np.sqrt(e[j])))
            both = [sorted((r.vec_id, sign * r.whitened) for r in part) for sign in (1, -1)]
            assert any(np.allclose([m[1] for m in mine], [w[1] for w in want], atol=1e-8) for mine in both)
    return clear


def test_whitening_is_an_eigendecomposition(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = QUERIES["op11_whitening"](spark, sf).collect()
    assert len(check_whitened(got, rows)) > 8


def test_whitening_edges(spark):
    rng = np.random.default_rng(2)
    base = (rng.normal(size=(40, 6)) * [5, 3, 2, 1, 0.5, 0.2]).astype(np.float32)
    base[:, 5] = base[:, 4]                                     # rank 5
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(100 + k, base[0].tolist()) for k in range(30)] + [(None, base[1].tolist()), (7, base[2].tolist())]
    rows += [(200, None), (201, [1.0] * 5 + [None]), (202, [1.0] * 5 + [float("nan")]), (203, [float("inf")] * 6), (204, [1.0]), (205, [])]
    rows = [(*r, 0, 1, 2, 3) for r in rows]
    got = whitening.whitened(spark.createDataFrame(rows, VECTORS).repartition(4)).collect()
    named = [(-1 if r[0] is None else r[0], *r[1:]) for r in rows]
    got = [type(r)(**{**r.asDict(), "vec_id": -1 if r.vec_id is None else r.vec_id}) for r in got]
    check_whitened(got, named)
    assert {r.component for r in got} == {1, 2, 3, 4, 5}


def test_whitening_finds_repeated_eigenvalues(spark):
    """From one start a repeated eigenvalue shows one vector; the others must not be missed."""
    rows = [(2 * k + s, [(4.0 if k < 9 else 2.0) * (1 - 2 * s) * (j == k) for j in range(12)], 0, 0, 0, 0) for k in range(12) for s in range(2)]
    got = whitening.whitened(spark.createDataFrame(rows, VECTORS), components=10).collect()
    share = {r.component: r.explained for r in got}
    assert all(math.isclose(share[k], 16 / (9 * 16 + 3 * 4), rel_tol=1e-9) for k in range(1, 10)) and math.isclose(share[10], 4 / 156, rel_tol=1e-9)
    assert got[0].identity_error < 1e-9
    y = np.zeros((24, 10))
    for r in got:
        y[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(y.T @ y / 24, np.eye(10), atol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_whitening_of_nothing(spark, rows):
    got = whitening.whitened(spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows], VECTORS))
    assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_a_long():
    x = np.array([[3, 5], [4_000_000_000, 1]])
    assert whitening.deviations(x, 2, np.array([1, 1])) == [25 + 81, None]


# ---- quality rules ------------------------------------------------------------------
def brute_measures(text):
    words, marked = (text or "").encode().split(), set()
    windows = defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k:k + 3])].append(k)
    for places in windows.values():
        if len(places) > 1:
            marked |= {k + j for k in places for j in range(3)}
    lines = [s for s in (text or "").encode().split(b"\n") if s.split()]
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
            sum(s in lines[:k] for k, s in enumerate(lines)), len(marked))


def test_measures_are_brute_force(documents, edges):
    rng = random.Random(4)
    texts = edges + [" ".join(rng.choice(["a", "b", "é#", "C"]) for _ in range(rng.randrange(90))) for _ in range(60)]
    texts += ["x\ny\nx\n\n \nx\n y\n", "a a a a", "a b c", "a b c a b c", "AB!! CD ef <b>"]
    got = {r.doc_id: r for r in quality.judged(documents(texts, clash=True), _labels(documents, []).limit(0)).collect()}
    for k, t in enumerate(texts):
        r, want = got[k], brute_measures(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)


def _labels(documents, rows):
    spark = documents(["x"]).sparkSession
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, marked long")


def test_binomial_tail_is_exact():
    for k, n, p in [(0, 10, 0.05), (3, 40, 0.1), (12, 200, 0.05), (200, 200, 0.5), (30, 300, 0.1), (0, 0, 0.5)]:
        want = math.fsum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(quality.at_most(k, n, p), want, rel_tol=1e-9)


def labelled(rng, n):
    """Plain documents, and bad ones with symbols; a few good ones carry some as well."""
    texts, labels = [], []
    for k in range(n):
        bad, lang = rng.random() < 0.2, rng.choice(["en", "en", "de", None])
        share = rng.uniform(0.2, 0.9) if bad else rng.choice([0, 0, 0, 0.05, 0.3]) if rng.random() < 0.1 else 0
        words = [f"w{rng.randrange(400)}" + ("##" if rng.random() < share else "") for _ in range(60)]
        texts.append((k, " ".join(words), lang, "s"))
        labels.append((k, int(not bad), 0, 0))
    return texts, labels


def test_rules_are_brute_force(documents):
    rng = random.Random(6)
    texts, labels = labelled(rng, 3000)
    labels += [(1, None, 0, 0), (None, 0, 0, 0), (10**9, 0, 0, 0), labels[5], (texts[9][0], 0, 0, 0)]
    got = {r.doc_id: r for r in quality.judged(documents(texts), _labels(documents, labels)).collect()}
    worst = {}
    for i, q, *_ in labels:
        if i is not None and q is not None:
            worst[i] = min(q, worst.get(i, 1))
    values, fold = {}, lambda i: int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) % 2
    for i, text, lang, _ in texts:
        n_words, chars, symbols, dups, repeats = brute_measures(text)
        values[i] = {"symbols": 1000 * symbols // chars, "duplicate_lines": 1000 * dups, "repeated_words": 1000 * repeats // n_words,
                     "capitals": 0, "long_words": 10 * chars // n_words, "short_words": 1000 - 10 * chars // n_words}
    known = [(i, lang, worst[i]) for i, _, lang, _ in texts if i in worst and not got[i].base_failed]
    proposed = {}
    for lang in {d[1] for d in known}:
        for rule in values[0]:
            mine = [(values[i][rule], q) for i, g, q in known if g == lang and fold(i) == 0]
            every = {values[i][rule] for i, g, _ in known if g == lang}
            gain, start = max((sum(1 if q == 0 else -quality.COST for v, q in mine if v >= t), t) for t in every)
            if gain > 0:
                proposed[lang, rule] = start
    per = Counter(lang for lang, _ in proposed)
    cuts = {}
    for (lang, rule), start in proposed.items():
        held = [values[i][rule] for i, g, q in known if g == lang and fold(i) == 1 and q > 0]
        p = quality.LIMIT / per[lang]
        for t in sorted({values[i][rule] for i, g, _ in known if g == lang and values[i][rule] >= start}):
            k = sum(v >= t for v in held)
            if math.fsum(math.comb(len(held), j) * p ** j * (1 - p) ** (len(held) - j) for j in range(k + 1)) <= quality.RISK / len(proposed):
                cuts[lang, rule] = t
                break
    assert cuts
    for i, _, lang, _ in texts:
        failed = sorted(rule for rule in values[i] if (lang, rule) in cuts and values[i][rule] >= cuts[lang, rule])
        assert sorted(got[i].failed) == failed and got[i].kept == (not got[i].base_failed and not failed)
    rejected = [got[i] for i, lang, q in known if q > 0 and not got[i].kept]
    assert len(rejected) <= quality.LIMIT * len(known)
    assert sum(not got[i].kept for i, _, q in known if q == 0) > 100


def test_few_labels_reject_nothing(documents):
    texts, labels = labelled(random.Random(7), 60)
    docs = documents(texts)
    assert all(r.kept != r.base_failed for r in quality.judged(docs, _labels(documents, labels)).collect())
    assert quality.judged(docs.limit(0), _labels(documents, labels)).count() == 0


# ---- the pipeline -------------------------------------------------------------------
def plain_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = text.lower().encode().split() if text.isascii() else text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)]
    hashes = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_pipeline(rows):
    """Rows of run() from the contracts: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    import regex
    from tokenizers import Tokenizer

    from offerlens.llm.queries import vocabulary

    rows = [r for r in rows if r[1] is not None and any(c.isalpha() for c in r[1])]
    least = {}
    for r in rows:
        t = regex.sub(r"[\x20\x09-\x0D]+", " ", r[1])
        least[t] = min(least.get(t, r), r, key=lambda x: x[0])
    rows = list(least.values())
    prints, group = [plain_fingerprint(r[1]) for r in rows], list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                group[root(a)] = root(b)
    first = {}
    for k, r in enumerate(rows):
        first[root(k)] = min(first.get(root(k), r), r, key=lambda x: x[0])
    rows = list(first.values())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r[0], r[1], r[3]) for r in rows])
    times = {i: taken // size for i, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({SQL['op3_mixing']}) t").fetchall()}
    library, out = Tokenizer.from_file(vocabulary()), []
    library.no_truncation()
    library.no_padding()
    for r in rows:
        ids = library.encode(r[1], add_special_tokens=False).ids
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        out += [(r[0], len(ids), *sha)] * times[r[0]]
    return sorted(out)


def test_pipeline_run_is_brute_force(spark, documents, sf, tmp_path):
    rng = random.Random(9)
    real = [tuple(r)[:4] for r in spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60").collect()]
    rows = list(real)
    for r in real[:30]:
        words = (r[1] or "x").split(" ")
        rows.append((len(rows), " ".join(words), r[2], r[3]))                        # an exact copy
        rows.append((len(rows), "  ".join(words) + "\n", r[2], r[3]))                 # alike up to white space
        words[rng.randrange(len(words))] = "changed"
        rows.append((len(rows), " ".join(words), r[2], None if rng.random() < 0.1 else r[3]))   # a near copy
    rows += [(len(rows) + k, t, "en", "s1") for k, t in enumerate([None, "", " \n", "123 456", "one", "One", "ONE two", "é"])]
    documents([(k, *r[1:]) for k, r in enumerate(rows)]).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_pipeline([(k, *r[1:]) for k, r in enumerate(rows)])
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want and len({r[0] for r in want}) < len(rows) - 60
