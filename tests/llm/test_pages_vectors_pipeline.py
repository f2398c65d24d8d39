"""WARC archives, vectors and the pipeline; registered queries against their SQL."""

import base64
import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from offerlens.llm import embeddings, warc
from offerlens.llm.oracle import SQL
from offerlens.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    ours = sorted(map(tuple, df.collect()), key=repr)
    columns = ", ".join(f'"{c}"' for c in df.columns)
    theirs = sorted(con.execute(f"SELECT {columns} FROM ({SQL[name]}) t").fetchall(), key=repr)
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        assert all(x == y or isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12) for x, y in zip(a, b)), (a, b)


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


# ---- WARC ------------------------------------------------------------------------
HTML = [None, "", "<p>é 😀</p>", "<p>é 😀</p>", "x" * 100_000, "long " * 9000, "a\r\n\r\nWARC/1.1\r\n", "x" * 100_000, ""]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, block string, status long")


def test_archive_round_trip(spark):
    rows = [(k, "http://a b\r\nc" if k else None, t, "clash", 1) for k, t in enumerate(HTML)]
    got = {r.page_id: r for r in warc.read(spark, warc.write(pages(spark, rows).repartition(3), segment_bytes=1000)).collect()}
    assert len(got) == len(HTML)
    for k, t in enumerate(HTML):
        body = (t or "").encode()
        first = min(j for j, u in enumerate(HTML) if (u or "") == (t or ""))
        want = (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "ok")
        assert (got[k].payload_bytes, got[k].payload_digest, got[k].status) == want
        assert (got[k].record_type, got[k].refers_to) == (("response", None) if first == k else ("revisit", first))
        assert (got[k].payload is None) == (first != k) and (first != k or bytes(got[k].payload) == body)


def test_archive_edges(spark):
    rows = [(None, "u", "same", "", 0), (5, "u", "same", "", 0), (5, "u", "same", "", 0), (6, "u", "y" * 5000, "", 0), (6, "u", "y" * 5000, "", 0)]
    got = warc.read(spark, warc.write(pages(spark, rows), segment_bytes=500)).collect()
    assert sorted((r.page_id or -1, r.record_type, r.refers_to, r.status) for r in got) == [
        (-1, "revisit", 5, "ok"), (5, "response", None, "ok"), (5, "response", None, "ok"), (6, "response", None, "ok"), (6, "response", None, "ok")]
    least = warc.read(spark, warc.write(pages(spark, rows), least_revisit=100)).collect()
    assert all(r.record_type == "response" for r in least)
    assert warc.read(spark, warc.write(pages(spark, []))).count() == 0


def test_missing_segments_show(spark, tmp_path):
    path = warc.write(pages(spark, [(1, "u", "q" * 5000, "", 0)]), segment_bytes=1000)
    records = [bytes(x) for x in warc.records_of(1, "u", b"q" * 5000, None, False, 1000)]
    for lost, said in ((0, "segment missing"), (2, "segment missing"), (len(records) - 1, "segment missing")):
        folder = str(tmp_path / str(lost))
        value = spark.createDataFrame([(r.decode(),) for k, r in enumerate(records) if k != lost], "value string").coalesce(1)
        value.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)
        r = warc.read(spark, folder).first()
        assert r.status == said and r.payload is None
    assert warc.read(spark, path).first().status == "ok"


def test_chunks():
    for n in (0, 1, 4096, 4097, 20_000):
        assert warc.dechunked(warc.chunked(b"z" * n)) == b"z" * n
    assert warc.dechunked(b"3;name=x\r\nabc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.dechunked(b"3\r\nabcd\r\n0\r\n\r\n")


# ---- vectors ---------------------------------------------------------------------
def brute_vectors(rows):
    ok = {k: (np.array(v, float), lab) for k, v, lab in rows
          if lab is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = {k: set() for k, _, _ in rows}
    for a, (x, la) in ok.items():
        for b, (y, lb) in ok.items():
            if a < b and la == lb and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.98:
                links[a].add(b)
                links[b].add(a)
    return links


def component(links, k):
    seen, todo = {k}, [k]
    while todo:
        for n in links[todo.pop()] - seen:
            seen.add(n)
            todo.append(n)
    return min(seen)


SCHEMA = "vec_id long, embedding array<float>, label int, node long, copies long"


def test_vector_edges(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.001], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [float("nan"), 1.0], 1), (8, [None, 1.0], 1), (9, [], 1), (10, [1.0], 1), (11, [float("inf"), 0.0], 1), (12, [0.0, -1.0], 1)]
    links = brute_vectors(rows)
    got = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame([(*r, 7, 7) for r in rows], SCHEMA)).collect()}
    assert {k: r.n_links for k, r in got.items()} == {k: len(v) for k, v in links.items()}
    assert {k: r.component_id for k, r in got.items()} == {k: component(links, k) for k in links}
    assert {k for k, r in got.items() if r.kept} == {k for k in links if component(links, k) == k}
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_vectors_of_one_id(spark):
    """Rows that share an id are vectors of their own, with their own links."""
    a, near, far, by_far = [1.0, 0.0, 0.0], [1.0, 0.01, 0.0], [0.0, 0.0, 1.0], [0.0, 0.01, 1.0]
    df = spark.createDataFrame([(1, a, "x"), (1, near, "x"), (1, far, "x"), (7, by_far, "x"), (9, [0.0, 1.0, 0.0], "x")],
                               "vec_id long, embedding array<double>, label string")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect())
    assert got == [(1, 1, 1, True)] * 3 + [(7, 1, 1, False), (9, 0, 9, True)]


def test_vector_recall(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(150, 48))
    rows = []
    for x in base:
        for _ in range(rng.integers(1, 9)):
            y = x + rng.normal(size=48) * rng.uniform(0.02, 0.16)
            rows.append((len(rows), y.astype(np.float32).tolist(), int(rng.integers(2)), 0, 0))
    links = brute_vectors([r[:3] for r in rows])
    want = sum(map(len, links.values()))
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[k] <= len(links[k]) for k in links) and sum(got.values()) >= 0.9 * want > 100


# ---- pipeline --------------------------------------------------------------------
def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns
        now = [r.doc_id for r in docs.collect()]
        if k == 0:
            assert len(now) == len(seen)                      # every text has a language
        if k == 1:
            assert len({" ".join(seen[d].split()) for d in now}) == len(now) == len({" ".join(t.split()) for t in seen.values()})
        if k < 3:
            assert len(set(now)) == len(now)
    from tokenizers import Tokenizer

    from offerlens.llm.queries import vocabulary
    library = Tokenizer.from_file(vocabulary())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert len(last) == docs.count() > 100
    for r in last:
        assert r.n_tokens == len(library.encode(seen[r.doc_id], add_special_tokens=False).ids)
        assert r.decoded_sha256 == hashlib.sha256(seen[r.doc_id].encode()).hexdigest()


def test_pipeline_of_no_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
