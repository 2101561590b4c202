"""Inner-product search against brute force."""

import random

import numpy as np
import pytest

from acervo.llm import topk
from acervo.llm.topk import MetricTree, highest

SCHEMA = "vec_id bigint, embedding array<double>, rank string, score string, shard string, id string, v string"


def brute(ids, points, own, query, k):
    found = sorted((-min(max(sum(int(a) * int(b) for a, b in zip(query, p)), topk.LEAST), topk.MOST), i)
                   for i, p in zip(ids, points) if i != own)
    return [(-s, i) for s, i in found[:k]]


@pytest.mark.parametrize("n, width, spread, copies", [
    (0, 3, 5, 0), (1, 3, 5, 0), (7, 4, 5, 2), (900, 6, 3, 300), (1500, 16, 90, 40), (600, 2, 1, 500), (500, 0, 1, 0),
    (700, 8, 2 ** 40, 100), (400, 4, 2 ** 61, 0)])
def test_tree(n, width, spread, copies):
    rnd = np.random.default_rng(n + width)
    points = rnd.integers(-spread, spread + 1, (n, width))
    if copies:
        points[rnd.integers(0, n, copies)] = points[0]
    ids = rnd.permutation(n).astype(np.int64)
    tree = MetricTree(ids, points)
    for own in [0, 1, n // 2, n + 5]:
        query = points[np.flatnonzero(ids == own)[0]] if own < n else rnd.integers(-spread, spread + 1, width)
        for k in (1, 5):
            assert tree.search(own, query, k) == brute(ids.tolist(), points, own, query, k)


def test_bounds_avoid_computations():
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(40, 8))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    points = np.floor(256 * (centres[rnd.integers(0, 40, 20_000)] + 0.02 * rnd.normal(size=(20_000, 8)))).astype(np.int64)
    tree = MetricTree(np.arange(20_000), points)
    for own in range(50):
        assert tree.search(own, points[own], 5) == sorted(
            ((int(s), i) for i, s in enumerate(points @ points[own]) if i != own), key=lambda r: (-r[0], r[1]))[:5]
    assert tree.computed < 50 * 20_000 * 0.25


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_tables(spark):
    rnd = random.Random(8)
    rows = [(i, [rnd.choice([-1.5, 0.0, 0.25, 0.001, 0.7]) for _ in range(3)]) for i in range(300)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (4, [9.0, 9.0, 9.0])]  # repeated rows, an id with two vectors
    rows += [(None, [1.0, 1.0, 1.0]), (400, None), (401, [1.0, None, 0.0]), (402, [float("nan"), 0.0, 0.0]),
             (403, [float("inf"), 0.0, 0.0]), (404, []), (405, []), (450, [1e308, -1e308, 1.0]), (500, [2.0, 1.0]), (501, [3.0, 1.0])]
    table = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)
    got = rows_of(highest(table, table.where("vec_id % 50 = 0 or vec_id = 404"), shard_rows=64))

    def whole(v):
        return [min(max(int(np.floor(min(max(256 * x, -1e300), 1e300))), -2 ** 63), 2 ** 63 - 1) for x in v]

    fit = [(i, whole(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for own, query in {(i, tuple(v)) for i, v in fit if i % 50 == 0 or i == 404}:
        near = brute([i for i, v in fit if len(v) == len(query)], [v for _, v in fit if len(v) == len(query)], own, query, 5)
        want += [(own, n + 1, i, s) for n, (s, i) in enumerate(near)]
    assert got == sorted(want)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(0, [1.0], *["x"] * 5)], SCHEMA)
    assert highest(none, none).collect() == [] and highest(some, none).collect() == [] and highest(some, some).collect() == []


def test_one_partition_a_shard(spark):
    table = spark.range(1000).selectExpr("id as vec_id", "array(rand(3), rand(4)) as embedding")
    plan = highest(table, table.where("vec_id < 10"), shard_rows=100)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert topk.QUERY_BLOCK <= 64
