"""Nearest vectors by a vantage-point tree per shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acervo.llm.common import arrow_schema, partitions

LEAF = 128


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances, each from the plain sum of squared differences, so equal vectors have equal distances."""
    out = np.empty((len(queries), len(points)))
    step = max(1, 2_000_000 // max(1, points.size))
    for at in range(0, len(queries), step):
        gap = queries[at:at + step, None, :] - points[None, :, :]
        np.square(gap, out=gap)
        out[at:at + step] = np.sqrt(gap.sum(axis=2))
    return out


class VantageTree:
    """Balanced by rank, so repeated points need no large leaf; each child keeps the range of distances to its parent's point."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, seed: int = 5):
        self.ids, self.points = ids, points
        self.order = np.arange(len(ids))
        self.nodes: list[tuple] = []
        self._picker = np.random.default_rng(seed)
        self.root = self._build(0, len(ids))

    def _build(self, start: int, end: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if end - start <= LEAF:
            self.nodes[at] = (start, end, None)
            return at
        rows = self.order[start:end]
        chosen = int(self._picker.integers(end - start))
        rows[[0, chosen]] = rows[[chosen, 0]]
        far = distances(self.points[rows[:1]], self.points[rows[1:]])[0]
        by = np.argsort(far, kind="stable")
        rows[1:] = rows[1:][by]
        far = far[by]
        half = len(far) // 2
        inner, outer = (float(far[0]), float(far[half - 1])), (float(far[half]), float(far[-1]))
        left = self._build(start + 1, start + 1 + half)
        right = self._build(start + 1 + half, end)
        self.nodes[at] = (start, end, (left, inner, right, outer))
        return at

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest of each query (rows padded with infinity), other rows of the query's own id left out.

        A child is skipped when the triangle inequality puts it farther than the k-th distance divided by `factor`;
        one is exact, more is faster and may miss.
        """
        best = np.full((len(ids), k), np.inf)
        names = np.full((len(ids), k), np.iinfo(np.int64).max)

        def offer(rows, far, points):
            far = np.where(self.ids[points][None, :] == ids[rows][:, None], np.inf, far)
            near = np.concatenate([best[rows], far], axis=1)
            who = np.concatenate([names[rows], np.broadcast_to(self.ids[points], far.shape)], axis=1)
            by = np.lexsort((who, near), axis=1)[:, :k]
            best[rows] = np.take_along_axis(near, by, 1)
            names[rows] = np.take_along_axis(who, by, 1)

        stack = [(self.root, np.arange(len(ids)), np.zeros(len(ids)))]
        while stack:
            at, rows, bound = stack.pop()
            # rounding of distances must not lose a tie
            live = bound <= best[rows, k - 1] / factor * (1 + 1e-9) + 1e-12
            rows = rows[live]
            if not len(rows):
                continue
            start, end, split = self.nodes[at]
            if split is None:
                points = self.order[start:end]
                offer(rows, distances(queries[rows], self.points[points]), points)
                continue
            centre = self.order[start:start + 1]
            far = distances(queries[rows], self.points[centre])
            offer(rows, far, centre)
            left, inner, right, outer = split
            far = far[:, 0]
            to_left = np.maximum(np.maximum(inner[0] - far, far - inner[1]), 0)
            to_right = np.maximum(np.maximum(outer[0] - far, far - outer[1]), 0)
            first = to_left <= to_right
            # pushed last, popped first: each query's nearer child before its farther one
            stack.append((right, rows[first], to_right[first]))
            stack.append((left, rows[~first], to_left[~first]))
            stack.append((left, rows[first], to_left[first]))
            stack.append((right, rows[~first], to_right[~first]))
        return names, best


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0, shard_rows: int = 20_000,
            batch: int = 512, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The k nearest rows of `vectors` to each row of `queries`: query_id, rank, vec_id, score (Euclidean distance).

    Rows are dealt into shards by a hash of id and vector; a task builds one shard's tree, then passes the queries
    through it in batches, so it holds one shard and one batch. Every query visits every shard (a stated query set
    against all rows); its k best of each shard meet in one ranking. Ties go to the smaller id. Vectors that are null,
    zero, or hold null or non-finite components take no part, nor do null ids; only vectors of the same length compare.
    Repeated rows of a query's own id are left out; otherwise repeated rows are candidates of their own. An empty side
    gives no row. Further columns play no part.
    """
    spark = vectors.sparkSession
    doubles = F.col(vector_column).cast("array<double>")
    fit = (F.col(vector_column).isNotNull() & F.col(id_column).isNotNull() & F.exists(doubles, lambda x: x != 0)
           & F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    points = vectors.where(fit).select(F.col(id_column).cast("bigint").alias("id"), doubles.alias("v"))
    asked = queries.where(fit).select(F.col(id_column).cast("bigint").alias("id"), doubles.alias("v")).distinct()
    total = points.count()
    shards = max(1, -(-total // shard_rows))
    length = F.size("v")
    dealt = points.select(F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "*")
    copies = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "*")
    both = dealt.unionByName(copies).withColumn("d", length).repartition(min(shards, 4 * partitions(spark)), "shard", "d")
    types = arrow_schema(spark, "query_id bigint, vec_id bigint, score double")

    def run(batches) -> Iterator[pa.RecordBatch]:
        state: dict = {"key": None, "parts": [], "tree": None}

        def flush(ids, vectors):
            if state["tree"] is None:
                if not state["parts"]:
                    return None
                held = [np.concatenate([p[i] for p in state["parts"]]) for i in (0, 1)]
                state["parts"], state["tree"] = [], VantageTree(*held)
            names, far = state["tree"].search(ids, vectors, k, factor)
            rows, cols = np.nonzero(np.isfinite(far))
            return pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(names[rows, cols]), pa.array(far[rows, cols])],
                                              schema=types)

        for got in batches:
            shard, kind = got.column(0).to_numpy(), got.column(1).to_numpy()
            ids, width = got.column(2).to_numpy(), got.column(4).to_numpy()
            flat = got.column(3)
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1]) | (width[1:] != width[:-1])) + 1
            edges = [0, *cuts.tolist(), len(shard)]
            for a, b in zip(edges, edges[1:]):
                key = (shard[a], width[a])
                if key != state["key"]:
                    state.update(key=key, parts=[], tree=None)
                for at in range(a, b, batch):
                    end = min(b, at + batch)
                    v = flat.slice(at, end - at).flatten().to_numpy().reshape(end - at, int(width[a]))
                    if kind[a] == 0:
                        state["parts"].append((ids[at:end], v))
                    else:
                        out = flush(ids[at:end], v)
                        if out is not None:
                            yield out

    part = both.sortWithinPartitions("shard", "d", "kind").select("shard", "kind", "id", "v", "d").mapInArrow(run, types_ddl())
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def types_ddl() -> str:
    return "query_id bigint, vec_id bigint, score double"
