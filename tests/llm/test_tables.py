"""Nearest vectors, archives, links, the pipeline and the registered queries."""

import base64
import hashlib
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from acervo.llm import archives, links, neighbours
from acervo.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


# --- nearest vectors

def brute_nearest(rows, queries, k):
    out = []
    fit = [(i, v) for i, v in rows if i is not None and v and any(x != 0 for x in v if x is not None)
           and all(x is not None and math.isfinite(x) for x in v)]
    for q, v in {(i, tuple(v)) for i, v in fit if i in queries}:
        far = sorted((float(np.sqrt(np.square(np.array(v) - np.array(w)).sum())), i) for i, w in fit if i != q and len(w) == len(v))
        out += [(q, rank + 1, i, d) for rank, (d, i) in enumerate(far[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [50, 100_000])
def test_nearest_edges(spark, shard_rows):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(600)]
    rows += [(i, [1.0] * 6) for i in range(600, 1000)]                      # a third equal: ties by id
    rows += [(1000, None), (1001, [0.0] * 6), (1002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1003, [float("nan")] * 6), (1004, [float("inf")] * 6),
             (None, [1.0] * 6), (1005, []), (1006, [1.0, 2.0]), (1007, [2.0, 2.0]), (700, [1.0] * 6)]
    rows = [(i, v and [None if c is None else float(c) for c in v]) for i, v in rows]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("id", F.lit("x")).withColumn("v", F.lit(1))
    asked = table.where("vec_id % 50 = 0 or vec_id > 999")
    got = neighbours.nearest(table, asked, shard_rows=shard_rows)
    want = brute_nearest(rows, {i for i, _ in rows if i is not None and (i % 50 == 0 or i > 999)}, 10)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got.collect()) == [w[:3] for w in want]
    np.testing.assert_allclose([r.score for r in got.orderBy("query_id", "rank").collect()], [w[3] for w in want], rtol=1e-12)
    assert neighbours.nearest(table, asked.limit(0)).count() == 0 and neighbours.nearest(table.limit(0), asked).count() == 0


def test_relaxed_pruning_keeps_recall():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 16))
    points = centres[rng.integers(0, 20, 4000)] + 0.2 * rng.normal(size=(4000, 16))
    tree = neighbours.VantageTree(np.arange(4000), points)
    ids, queries = np.arange(0, 4000, 100), points[::100]
    exact, near = tree.search(ids, queries, 10, 1.0)
    for i, q in zip(ids, exact):
        far = np.linalg.norm(points - points[i], axis=1)
        far[i] = np.inf
        assert set(q) == set(np.argsort(far)[:10])
    loose, _ = tree.search(ids, queries, 10, 1.5)
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact, loose)]) >= 0.9


# --- archives

@pytest.mark.parametrize("version", [1, 2])
def test_archives_round_trip(spark, version):
    html = "<p>é</p>\r\n\r\nWARC/1.1\r\n\r\nhttp://x 0.0.0.0 20200101000000 text/html 3\n"
    rows = [(3, "http://a/b c", html), (1, "http://a\n", html), (2, None, None), (5, "", ""), (4, "u", "tail\n\n\r\n"),
            (6, "u", "x" * 300_000), (6, "u", "x" * 300_000), (None, "n", html), (None, "n", "only")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("value", F.lit(1)).withColumn("file", F.lit(1))
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in archives.converted(pages, version).collect()), key=str)
    want = []
    for key, members in {h or "": [p for p, _, x in rows if (x or "") == (h or "")] for _, _, h in rows}.items():
        raw = key.encode()
        members = sorted(members, key=lambda p: (p is None, p))
        for n, p in enumerate(members):
            want.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if n else "response",
                         members[0] if n else None))
    assert got == sorted(want, key=str)
    assert archives.converted(pages.limit(0), version).count() == 0


def test_archives_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id bigint, url string, html string")
    got = {r.page_id: r.record_type for r in archives.converted(pages, least_bytes=4).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


@pytest.mark.parametrize("version", [1, 2])
def test_pages_named_like_file_descriptions_stay(spark, version):
    pages = spark.createDataFrame([(1, "filedesc://a.arc", "abc"), (2, "filedesc:", "de"), (3, "http://filedesc:8/", "f")], "page_id bigint, url string, html string")
    got = {r.page_id: r.payload_bytes for r in archives.converted(pages, version).collect()}
    assert got == {1: 3, 2: 2, 3: 1}


def test_archive_headers():
    raw = b"filedesc://x 0.0.0.0 2001 text/plain 3\nabc\nhttp://a 1.2.3.4 20010203 image/png 4\nGIF8\n"
    (at, header, body), = archives.arc_records(raw)
    assert header["url"] == "http://a" and body == b"GIF8" and raw[at:at + 8] == b"http://a"
    for bad in (b"no header\n", b"u 1 2001 t 99\nshort\n"):
        with pytest.raises(ValueError):
            list(archives.arc_records(bad))
    with pytest.raises(ValueError):
        list(archives.warc_records(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"))


# --- links

def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7), (500, 499)]
    got = {r.node: r.root for r in links.components(spark.createDataFrame(pairs, "a int, b int")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(300)} | {499: 499, 500: 499}
    assert links.components(spark.createDataFrame([], "a int, b int")).count() == 0


# --- pipeline

def test_pipeline_stages(spark, edge_docs):
    docs = edge_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes), name
        docs = spark.createDataFrame(after.collect(), after.schema)
    left = {r.doc_id for r in docs.collect()}
    assert left >= {1, 6, 8, 9, 11, 12, 13} and not left & {2, 3, 4, 5, 10, 14}
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert tokens.count() == docs.count() and tokens.where("n_tokens = 0").count() == 0
    nothing = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF_DIR).count() == 0, name


def test_pipeline_on_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = {r.doc_id: r.class_id for r in QUERIES["op2_neardup"](spark, SF_DIR).collect()}
    out = entry.queries()["pipeline"](spark, SF_DIR).collect()
    assert {r.doc_id for r in out} == set(known.values())
    assert len(out) == len({r.doc_id for r in out}) <= docs.count()


# --- queries

def test_language_on_held_out_documents(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op5_language"](spark, SF_DIR).collect() if r.held_out]
    assert rows and sum(r.lang_pred == docs[r.doc_id] for r in rows) / len(rows) > 0.97


def test_secrets_of_documents(spark):
    import re
    texts = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in QUERIES["op3_secrets"](spark, SF_DIR).collect():
        want = [m.span(1) for m in re.finditer(rb'(?i)token = "([0-9a-f]{40})"', texts[r.doc_id])]
        assert [(s.start, s.end) for s in r.secrets] == want


def test_every_operator_is_registered():
    names = {n.split("_")[0] for n in QUERIES if n != "pipeline"}
    assert names == {f"op{i}" for i in range(1, 11)} and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
