"""Exact inner-product search by metric trees of pages, best page first.

<q, x> = (|q|^2 + |x|^2 - d(q, x)^2) / 2, so a least distance to a page's points and their greatest norm bound every score
in the page. Each entry of a page keeps its distance to the page's centre: with the query's distance to that centre the
triangle inequality rules entries out before their own distance or score is computed.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.llm.common import arrow_schema

PAGE = 1024
FANOUT = 16
QUERY_BLOCK = 16
FOUND = "query_id bigint, vec_id bigint, score bigint"
#: Bounds are kept by this share of the squared norms, so rounding never rules out a score.
SLACK = 1e-6
LEAST, MOST = -2 ** 63, 2 ** 63 - 1


class Page:
    """Entries below one centre: points (a leaf) or pages; radius and greatest squared norm hold for all points below."""

    __slots__ = ("centre", "radius", "norm", "rows", "pages", "centres", "squares", "parent", "radii", "norms")


class MetricTree:
    """A paged metric tree over distinct vectors of whole numbers; equal vectors share an entry with all their ids."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, seed: int = 11):
        wide = points.astype(np.float64)
        self.width = points.shape[1]
        self.most = float(np.abs(wide).max(initial=0))
        order = np.lexsort((ids, *points.T)) if self.width else np.argsort(ids, kind="stable")
        points, ids = points[order], ids[order]
        new = np.ones(len(ids), bool)
        new[1:] = (points[1:] != points[:-1]).any(axis=1)
        self.first = np.append(np.flatnonzero(new), len(ids))
        self.ids = ids
        self.names = np.unique(ids)
        self.low, self.high = ids[self.first[:-1]], ids[self.first[1:] - 1]
        self.whole = points[new]
        self.points = wide[order][new]
        self.squares = np.einsum("ij,ij->i", self.points, self.points)
        self.computed = 0
        self._picker = np.random.default_rng(seed)
        self.root = self._page(np.arange(len(self.points))) if len(ids) else None

    def _from(self, centre: int, rows: np.ndarray) -> np.ndarray:
        gap = self.points[rows] - self.points[centre]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def _halves(self, rows: np.ndarray) -> list[np.ndarray]:
        """Two parts of equal count, cut across the direction between two points that lie far apart."""
        one = rows[self._from(int(rows[self._picker.integers(len(rows))]), rows).argmax()]
        other = rows[self._from(int(one), rows).argmax()]
        by = rows[np.argsort(self.points[rows] @ (self.points[one] - self.points[other]), kind="stable")]
        return [by[:len(by) // 2], by[len(by) // 2:]]

    def _page(self, rows: np.ndarray) -> Page:
        page = Page()
        mean = self.points[rows].mean(axis=0)
        gap = self.points[rows] - mean
        page.centre = int(rows[np.einsum("ij,ij->i", gap, gap).argmin()])
        far = self._from(page.centre, rows)
        page.radius, page.norm = float(far.max()), float(self.squares[rows].max())
        if len(rows) <= PAGE:
            page.pages, page.rows, page.parent, page.norms = None, rows, far, self.squares[rows]
            page.centres = self.points[rows]
            return page
        parts = [rows]
        while len(parts) < FANOUT and max(map(len, parts)) > PAGE:
            parts = [half for part in parts for half in (self._halves(part) if len(part) > PAGE else [part])]
        page.pages = [self._page(part) for part in parts]
        centres = np.array([p.centre for p in page.pages])
        page.centres, page.squares, page.parent = self.points[centres], self.squares[centres], self._from(page.centre, centres)
        page.radii = np.array([p.radius for p in page.pages])
        page.norms = np.array([p.norm for p in page.pages])
        return page

    def _members(self, row: int, own: int, k: int) -> list[int]:
        """The k smallest ids of a vector's entry, the query's own id left out."""
        held = self.ids[self.first[row]:self.first[row + 1]]
        low, high = np.searchsorted(held, own), np.searchsorted(held, own, side="right")
        return [*held[:min(low, k)].tolist(), *held[high:high + k].tolist()][:k]

    def search(self, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k highest inner products, ties to the smaller id; scores are held within a long."""
        if self.root is None:
            return []
        wide = query.astype(np.float64)
        # while every partial sum is below 2**52 doubles are exact; beyond that Python's integers score
        exact = self.width * max(float(np.abs(wide).max(initial=0)), self.most) ** 2 < 2.0 ** 52
        whole = None if exact else [int(x) for x in query]
        at = np.searchsorted(self.names, own)
        held = at < len(self.names) and self.names[at] == own
        square = float(wide @ wide)
        length = square ** 0.5
        best: list[tuple[int, int]] = []  # (score, -id), the worst first
        worst = -np.inf
        gap = wide - self.points[self.root.centre]
        queue = [(-np.inf, 0, self.root, float(gap @ gap) ** 0.5)]
        pushed, self.computed = 1, self.computed + 1
        while queue:
            bound, _, page, far = heapq.heappop(queue)
            if -bound < worst:
                break
            reach = np.abs(far - page.parent)
            if page.pages is None:
                ceiling = page.norms * (0.5 + SLACK) - reach * reach / 2
                live = np.flatnonzero(ceiling >= worst - square * (0.5 + SLACK)) if worst > LEAST else np.arange(len(page.rows))
                self.computed += len(live)
                rows = page.rows[live]
                if exact:
                    most = 2 * len(live) > len(page.rows)
                    scores = (page.centres @ wide)[live] if most else page.centres[live] @ wide
                else:
                    sums = (sum(a * int(b) for a, b in zip(whole, self.whole[row])) for row in rows)
                    scores = np.array([min(max(s, LEAST), MOST) for s in sums], object)
                if held:
                    # an entry of the query's own id alone offers nothing
                    others = ~((self.low[rows] == own) & (self.high[rows] == own))
                    rows, scores = rows[others], scores[others]
                if len(scores) > k:
                    # each entry offers an id, so what k entries of the page exceed is not among the k best
                    chosen = scores >= max(worst, np.sort(scores)[-k])
                    rows, scores = rows[chosen], scores[chosen]
                for row, score in zip(rows.tolist(), scores.tolist()):
                    if score < worst:
                        continue
                    for name in self._members(row, own, k):
                        if len(best) < k:
                            heapq.heappush(best, (int(score), -name))
                        elif (score, -name) > best[0]:
                            heapq.heapreplace(best, (int(score), -name))
                        else:
                            break
                    if len(best) == k:
                        worst = best[0][0]
                continue
            reach = np.maximum(reach - page.radii, 0)
            ceiling = (square + page.norms - reach * reach) / 2 + SLACK * (square + page.norms)
            live = np.flatnonzero(np.maximum(ceiling, LEAST) >= worst)
            if not len(live):
                continue
            self.computed += len(live)
            gap = page.centres[live] - wide
            away = np.sqrt(np.einsum("ij,ij->i", gap, gap))
            reach = np.maximum(away - page.radii[live], 0)
            norms = page.norms[live]
            ceiling = np.minimum((square + norms - reach * reach) / 2, page.centres[live] @ wide + length * page.radii[live])
            ceiling = np.maximum(ceiling + SLACK * (square + norms), LEAST)
            for at, top, d in zip(live.tolist(), ceiling.tolist(), away.tolist()):
                if top >= worst:
                    heapq.heappush(queue, (-top, pushed, page.pages[at], d))
                    pushed += 1
        return [(score, -name) for score, name in sorted(best, reverse=True)]


def whole_numbers(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double, in the range of a long."""
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def fit_vectors(id_column: str, vector_column: str) -> Column:
    """Rows that take part: an id, and a vector without null or non-finite components."""
    doubles = F.col(vector_column).cast("array<double>")
    return (F.col(vector_column).isNotNull() & F.col(id_column).isNotNull()
            & F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def highest(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, shard_rows: int = 32_768,
            id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The k highest inner products of each query with all rows but its own: query_id, rank, vec_id, score.

    Components become floor(scale * x); sums are exact, and a score beyond a long counts as the nearest long. Rows
    are dealt by a hash of id and vector to shards of about `shard_rows`, one partition each; a task builds its shard's
    tree and passes the queries through it in small blocks, so it holds one shard. Every query visits every shard (a
    stated query set against all rows); its k best of each shard meet in one ranking. Ties go to the smaller id.

    Null ids and vectors that are null or hold null or non-finite components take no part; zero and empty vectors do;
    only vectors of the same length compare. Rows of the query's own id are left out, other repeated rows are candidates
    of their own, repeated queries are answered once. An empty side gives no row; further columns play no part.
    """
    def read(df: DataFrame) -> DataFrame:
        return df.where(fit_vectors(id_column, vector_column)).select(
            F.col(f"`{id_column}`").cast("bigint").alias("id"), whole_numbers(vector_column, scale).alias("v"))

    points, asked = read(vectors), read(queries).distinct()
    shards = max(1, -(-points.count() // shard_rows))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = points.select(F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int").alias("shard"), F.size("v").alias("d"),
                          F.lit(0).alias("kind"), F.array("id").alias("ids"), F.array("v").alias("vs"))
    block = asked.groupBy(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).alias("block"), F.size("v").alias("d")).agg(
        F.collect_list(F.struct("id", "v")).alias("q"))
    copies = block.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "d", F.lit(1).alias("kind"),
                          F.col("q.id").alias("ids"), F.col("q.v").alias("vs"))
    types = arrow_schema(vectors.sparkSession, FOUND)

    def run(batches) -> Iterator[pa.RecordBatch]:
        key, parts, tree = None, [], None
        for batch in batches:
            shard, width, kind = (batch.column(i).to_numpy() for i in range(3))
            changed = (shard[1:] != shard[:-1]) | (width[1:] != width[:-1]) | (kind[1:] != kind[:-1])
            edges = [0, *(np.flatnonzero(changed) + 1).tolist(), len(shard)]
            for a, b in zip(edges, edges[1:]):
                if b == a:
                    continue
                if (shard[a], width[a]) != key:
                    key, parts, tree = (shard[a], width[a]), [], None
                ids = batch.column(3).slice(a, b - a).flatten().to_numpy()
                points = batch.column(4).slice(a, b - a).flatten().flatten().to_numpy().reshape(len(ids), int(width[a]))
                if kind[a] == 0:
                    parts.append((ids, points))
                    continue
                if tree is None and parts:
                    tree, parts = MetricTree(*(np.concatenate(x) for x in zip(*parts))), []
                if tree is None:
                    continue
                out = [(own, name, score) for own, query in zip(ids.tolist(), points) for score, name in tree.search(own, query, k)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], schema=types)

    both = dealt.unionByName(copies).repartitionById(shards, "shard").sortWithinPartitions("shard", "d", "kind")
    found = both.mapInArrow(run, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
