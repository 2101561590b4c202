"""Time-window similarity and greedy leader clustering.

The measure runs inside tasks on bounded blocks: quiet days that follow each
other share a slice, a crowded day is cut into slices by direction and order. A
slice meets the slices of the days it may be compared with, numpy multiplies the
two, and only qualifying pairs (or each row's best) leave the task. A day that
owns a third of the rows is just more slices. No pair that fails the threshold
is ever a row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions import similarity as M
from acervo.functions.text import slugify, title_key
from acervo.operators.ordered import first_k, with_position
from acervo.session import cut_lineage, spread

SLICE_ROWS = 4_000
# rows of a task's side: slices that follow each other share a tile, so that tasks do not outnumber the rows
PAIR_ROWS, LEAD_ROWS = 4_000, 16_000
# quiet days whose titles one task scans: the work grows with the square of a day, so few share a task
TITLE_PACK_ROWS = 500
MAX_PIVOTS = 64
PAIR = "hi string, lo string, sim double, lo_day int, lo_ord long"
COLUMNS = ["id", "day", "ord", "embedding"]
SCAN_ROWS, MEET_ROWS = 512, 4_096
LEADS, OPEN = 1, 0


def _own(df: DataFrame) -> DataFrame:
    """Columns of its own: the two sides of a cogroup may come from one table."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _pivots(df: DataFrame, threshold: float, slice_rows: int) -> np.ndarray | None:
    """A few unit vectors to sort a crowded day by direction; none where days are small.

    They only decide which slices can hold a pair, never the result.
    """
    busiest = df.groupBy("day").count().agg(F.max("count")).first()[0] or 0
    n = min(MAX_PIVOTS, busiest // slice_rows)
    if n < 2 or threshold <= 0:
        return None
    rows = df.select("embedding").orderBy(F.xxhash64("id")).limit(int(n)).collect()
    return M.unit_rows([r["embedding"] for r in rows])


def _with_cell(df: DataFrame, pivots: np.ndarray | None) -> DataFrame:
    """Nearest pivot of each row and the angle to it."""
    if pivots is None:
        return df.withColumns({"cell": F.lit(0), "angle": F.lit(0.0)})

    def nearest(parts):
        for part in parts:
            sims = M.unit_rows(part["embedding"]) @ pivots.T if len(part) else np.zeros((0, len(pivots)))
            cell = sims.argmax(axis=1)
            part["cell"] = cell.astype("int32")
            part["angle"] = np.arccos(np.clip(sims[np.arange(len(part)), cell], -1.0, 1.0))
            yield part

    return df.mapInPandas(nearest, f"id string, day int, ord long, embedding {df.schema['embedding'].dataType.simpleString()}, cell int, angle double")


def _packed(df: DataFrame, slice_rows: int, pack_rows: int | None = None) -> DataFrame:
    """`_crowded`: the day has more than `slice_rows` rows. `_before`: rows of the days before. `_pack`: quiet days that share a slice, joined in date order until it is full (`pack_rows`, else `slice_rows`)."""
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # one row per calendar day
    days = df.groupBy("day").agg(F.count("*").alias("_n")).withColumn("_crowded", F.col("_n") > slice_rows)
    quiet = F.coalesce(F.sum(F.when(~F.col("_crowded"), F.col("_n"))).over(before), F.lit(0))
    packs = days.select("day", "_crowded", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.concat(F.lit("q"), F.floor(quiet / (pack_rows or slice_rows)).cast("string")).alias("_pack"))
    return df.join(packs, "day")


def _sliced(df: DataFrame, slice_rows: int, pivots: np.ndarray | None, tile_rows: int, whole_days: bool = False) -> DataFrame:
    """Tile (`slice`) and, in crowded days, cell and angle of each row (else null).

    A crowded day is cut by cell, and a larger cell along the scan order, so that
    a chain of documents that follow each other stays in few slices. Slices and
    quiet days that follow each other share a tile of about `tile_rows`. With
    `whole_days` a day of no more rows than that stays in one tile.
    """
    tile_rows = max(slice_rows, tile_rows)
    celled = _with_cell(df, pivots)
    # read several times: the days' counts, the cuts, the tiles and the rows themselves
    placed = _packed(celled if pivots is None else cut_lineage(celled), slice_rows)
    cuts = placed.filter("_crowded").groupBy("day", "cell").agg(
        F.ceil(F.count("*") / slice_rows).cast("int").alias("_parts"),
        F.percentile_approx("ord", [i / 64 for i in range(1, 64)], 1000).alias("_points"))
    found = placed.join(cuts, ["day", "cell"], "left")
    # every k-th of the 64 quantiles; with more than 64 parts a hash cuts on
    rank = F.size(F.filter("_points", lambda x: x <= F.col("ord")))
    part = F.floor(rank * F.least("_parts", F.lit(64)) / 64)
    more = F.when(F.col("_parts") > 64, F.pmod(F.xxhash64("id"), F.ceil(F.col("_parts") / 64))).otherwise(0)
    cut = found.withColumns({"_part": F.when(F.col("_crowded"), part).otherwise(0), "_more": F.when(F.col("_crowded"), more).otherwise(0),
                             "cell": F.when(F.col("_crowded"), F.col("cell")), "angle": F.when(F.col("_crowded"), F.col("angle"))})
    at = ["day", F.coalesce("cell", F.lit(-1)).alias("_cell"), "_part", "_more"]
    before = Window.partitionBy("day").orderBy("_cell", "_part", "_more").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    inside = F.coalesce(F.sum("_n").over(before), F.lit(0))
    if whole_days:
        inside = F.when(F.sum("_n").over(Window.partitionBy("day")) > tile_rows, inside).otherwise(0)
    tiles = cut.groupBy(*at, "_before").agg(F.count("*").alias("_n")).select(
        "day", "_cell", "_part", "_more", F.floor((F.col("_before") + inside) / tile_rows).cast("string").alias("slice"))
    return cut.withColumn("_cell", F.coalesce("cell", F.lit(-1))).join(
        tiles, ["day", "_cell", "_part", "_more"]).select(*COLUMNS, "slice", "cell", "angle")


def _grid(left: DataFrame, right: DataFrame, window_days: int, threshold: float, pivots: np.ndarray | None,
          other: bool) -> DataFrame:
    """(l, r): tiles that may hold a qualifying pair, one row each. `other` leaves a tile and itself out."""
    def spans(df: DataFrame, side: str, reach: int) -> DataFrame:
        found = df.groupBy(F.col("slice").alias(side), F.col("cell").alias(f"{side}_c")).agg(
            F.min("day").alias("a"), F.max("day").alias("b"), F.max("angle").alias(f"{side}_a"))
        return found.select(side, f"{side}_c", f"{side}_a", F.explode(F.sequence(F.col("a") - reach, "b")).alias("d"))

    met = spans(left, "l", window_days).join(spans(right, "r", 0), "d").drop("d")
    if other:
        met = met.filter("l <> r")
    if pivots is not None:
        # triangle inequality on angles: cells too far apart hold no pair
        apart = np.arccos(np.clip(pivots @ pivots.T, -1.0, 1.0)).ravel()
        # one literal: thousands of them take the optimizer seconds
        table = F.split(F.lit(",".join(repr(float(x)) for x in apart)), ",").cast("array<double>")
        gap = F.get(table, F.col("l_c") * len(pivots) + F.col("r_c")) - F.col("l_a") - F.col("r_a")
        met = met.filter(F.coalesce(gap <= float(np.arccos(threshold)) + 1e-6, F.lit(True)))
    return met.select("l", "r").distinct()


def _meet(left: DataFrame, right: DataFrame, window_days: int, score: Callable, threshold: float,
          pivots: np.ndarray | None = None, other: bool = False) -> DataFrame:
    """Slices of `left` against the slices of `right` of the same days and the days before them."""
    grid = _grid(left, right, window_days, threshold, pivots, other)
    left_g = spread(_own(left.select(*COLUMNS, F.col("slice").alias("l")).join(grid, "l")), "l", "r")
    right_g = spread(_own(right.select(*COLUMNS, F.col("slice").alias("r")).join(grid, "r")), "l", "r")
    return left_g.groupBy("l", "r").cogroup(right_g.groupBy("l", "r")).applyInPandas(
        lambda a, b: score(a, b) if len(a) and len(b) else pd.DataFrame(columns=["hi", "lo", "sim", "lo_day", "lo_ord"]), PAIR)


def _in_parts(a: pd.DataFrame, b: pd.DataFrame, window_days: int):
    """Cosines of a few hundred left rows at a time, the mask of earlier right rows in the window, and the first row's place."""
    unit_a, unit_b = M.unit_rows(a["embedding"]), M.unit_rows(b["embedding"])
    day_a, day_b = a["day"].to_numpy()[:, None], b["day"].to_numpy()[None, :]
    ord_a, ord_b = a["ord"].to_numpy()[:, None], b["ord"].to_numpy()[None, :]
    for at in range(0, len(a), SCAN_ROWS):
        rows = slice(at, at + SCAN_ROWS)
        gap = day_a[rows] - day_b
        yield at, unit_a[rows] @ unit_b.T, ((gap > 0) | ((gap == 0) & (ord_b < ord_a[rows]))) & (gap <= window_days)


def _rows(a: pd.DataFrame, b: pd.DataFrame, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pd.DataFrame:
    i, j, sims = (np.concatenate(x) for x in zip(*found))
    return pd.DataFrame({
        "hi": a["id"].to_numpy()[i], "lo": b["id"].to_numpy()[j], "sim": sims,
        "lo_day": b["day"].to_numpy()[j].astype("int32"), "lo_ord": b["ord"].to_numpy()[j],
    })


def _pairs(threshold: float, window_days: int) -> Callable:
    def score(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        for at, sims, earlier in _in_parts(a, b, window_days):
            i, j = np.nonzero(earlier & (sims >= threshold))
            found.append((i + at, j, sims[i, j]))
        return _rows(a, b, found)
    return score


def _best(threshold: float, window_days: int) -> Callable:
    """Best earlier right row per left row, the earliest among equals."""
    def score(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["day", "ord"], ignore_index=True)
        found = []
        for at, sims, earlier in _in_parts(a, b, window_days):
            sims = np.where(earlier, sims, -2.0)
            j = sims.argmax(axis=1)
            i = np.nonzero(sims[np.arange(len(j)), j] >= threshold)[0]
            found.append((i + at, j[i], sims[i, j[i]]))
        return _rows(a, b, found)
    return score


def _ranked(*sides: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places of rows in the scan order of all sides together, as rows that ask for earlier ones and as rows that are asked for.

    Rows of one day and order have the same place. Without an order a row asks at the
    begin of its day and is asked for at the end: it neither follows nor precedes others of the day.
    """
    day, order = (np.concatenate([side[c].to_numpy() for side in sides]) for c in ("day", "ord"))
    by = np.lexsort((order, day))
    fresh, new = np.ones(len(by), bool), np.ones(len(by), bool)
    fresh[1:] = day[by][1:] != day[by][:-1]
    new[1:] = fresh[1:] | (order[by][1:] != order[by][:-1])
    place, begin = np.empty(len(by), np.int64), np.empty(len(by), np.int64)
    place[by] = np.cumsum(new)
    begin[by] = np.maximum.accumulate(np.where(fresh, place[by], 0))
    cuts = np.cumsum([len(side) for side in sides])[:-1]
    return list(zip(np.split(np.where(pd.isna(order), begin, place), cuts), np.split(place, cuts)))


def _first_near(a: tuple, b: tuple, threshold: float, window_days: int) -> np.ndarray:
    """For each row of `a` the first earlier row of `b` in the window at the threshold or above, else -1.

    Both are unit vectors, days and places in the scan order, `b` in that order (`_ranked`). Rows
    of `b` come a few hundred at a time, and a row of `a` that has found one is done.
    """
    (unit_a, day_a, place_a), (unit_b, day_b, place_b) = a, b
    low, high = np.searchsorted(day_b, day_a - window_days), np.searchsorted(place_b, place_a)
    found = np.full(len(unit_a), -1, np.int64)
    for at in range(0, len(unit_b), SCAN_ROWS):
        end = min(at + SCAN_ROWS, len(unit_b))
        asked = np.nonzero((found < 0) & (low < end) & (high > at))[0]
        columns = np.arange(at, end)
        for part in np.split(asked, range(MEET_ROWS, len(asked), MEET_ROWS)):
            near = unit_a[part] @ unit_b[at:end].T >= threshold
            if len(part) and (high[part].min() < end or low[part].max() > at):
                near &= (columns >= low[part, None]) & (columns < high[part, None])
            hit = near.any(axis=1)
            found[part[hit]] = at + near[hit].argmax(axis=1)
    return found


def _waits(threshold: float, window_days: int) -> Callable:
    """Left rows with any earlier right row at the threshold or above."""
    def score(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["day", "ord"], ignore_index=True)
        (place_a, _), (_, place_b) = _ranked(a, b)
        j = _first_near((M.unit_rows(a["embedding"]), a["day"].to_numpy(), place_a),
                        (M.unit_rows(b["embedding"]), b["day"].to_numpy(), place_b), threshold, window_days)
        i = np.nonzero(j >= 0)[0]
        return _rows(a, b, [(i, j[i], np.full(len(i), np.nan))])
    return score


def _prepared(docs: DataFrame, key: str, day: str, order: str, vector: str) -> DataFrame:
    return docs.select(
        F.col(key).cast("string").alias("id"),
        F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).alias("day"),
        F.col(order).cast("long").alias("ord"), F.col(vector).alias("embedding"),
    )


def similar_pairs(docs: DataFrame, key: str, day: str, order: str, vector: str,
                  threshold: float = P.CLUSTER_COSINE, window_days: int = P.CLUSTER_WINDOW_DAYS,
                  slice_rows: int = SLICE_ROWS, tile_rows: int = PAIR_ROWS) -> DataFrame:
    """(hi, lo, sim): pairs at most `window_days` apart with cosine at or above the threshold.

    Documents without a day or a vector are in no pair.
    """
    rows = _prepared(docs, key, day, order, vector).filter("day is not null and embedding is not null")
    pivots = _pivots(rows, threshold, slice_rows)
    # read four times: both sides and their spans
    sliced = cut_lineage(_sliced(rows, slice_rows, pivots, tile_rows))
    return _meet(sliced, sliced, window_days, _pairs(threshold, window_days), threshold, pivots).select("hi", "lo", "sim")


def _scan(threshold: float, window_days: int) -> Callable:
    """Scan of one slice in order: which rows lead, and which stay open; rows that follow a leader are left out.

    A row near an earlier leader follows. One near an earlier open row, or that
    waits for an open row of another slice, stays open. Any other row leads, at
    once for the rows after it: a chain inside the slice is settled in this pass.
    """
    def scan(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["day", "ord"], ignore_index=True)
        unit, day, ((asks, place),) = M.unit_rows(part["embedding"]), part["day"].to_numpy(), _ranked(part)
        leads, opened = np.zeros(len(part), bool), part["outside"].to_numpy().astype(bool)
        some_open = np.zeros(len(part), bool)

        def near_any(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
            return _first_near((unit[rows], day[rows], asks[rows]), (unit[others], day[others], place[others]), threshold, window_days) >= 0

        for at in range(0, len(part), SCAN_ROWS):
            rows = np.arange(at, min(at + SCAN_ROWS, len(part)))
            rows = rows[~near_any(rows, np.nonzero(leads)[0])]
            free = rows[~opened[rows]]
            opened[free] = near_any(free, np.nonzero(some_open)[0])
            # the rows of this block among themselves, in order
            near = (unit[rows] @ unit[rows].T >= threshold) & (place[rows][None, :] < asks[rows][:, None]) & (
                day[rows][:, None] - day[rows][None, :] <= window_days)
            some = near.any(axis=1)
            for i, row in enumerate(rows.tolist()):
                if some[i] and (near[i] & leads[rows]).any():
                    continue
                stays = opened[row] or (some[i] and (near[i] & some_open[rows]).any())
                (some_open if stays else leads)[row] = True
        part["state"] = np.where(leads, LEADS, OPEN).astype("int32")
        return part[leads | some_open].drop(columns="outside")
    return scan


def leader_clusters(docs: DataFrame, key: str, day: str, order: str, vector: str,
                    threshold: float = P.CLUSTER_COSINE, window_days: int = P.CLUSTER_WINDOW_DAYS,
                    slice_rows: int = SLICE_ROWS, tile_rows: int = LEAD_ROWS) -> DataFrame:
    """(id, leader_id): the sequential leader scan, computed in parallel, same result.

    Scan order is (day, order). A document joins the most similar earlier leader
    within the window, the earliest among equals, else it becomes a leader.
    Documents without a day, without a vector or with a zero vector lead themselves.

    Rounds: each slice (a tile of about `tile_rows`) is scanned in order by one task, which settles every
    document that does not depend on an open one of another slice; documents near
    a new leader of another slice are then decided. The first open slice is
    settled whole, so rounds follow the slices that a chain of documents crosses,
    not its length, and few documents take one round. Copies of one vector on one
    day are represented by the first of them, because a later copy always has that
    one, or its leader, to join.
    """
    rows = _prepared(docs, key, day, order, vector)
    alone = F.coalesce(F.col("day").isNull() | F.col("embedding").isNull() | (F.aggregate(
        "embedding", F.lit(0.0), lambda s, x: s + F.abs(x.cast("double"))) == 0) & F.lit(threshold > 0), F.lit(True))
    distinct = cut_lineage(rows.filter(~alone).groupBy("day", "embedding").agg(
        F.min(F.struct("ord", "id")).alias("f")).select("f.id", "day", "f.ord", "embedding"))
    pivots = _pivots(distinct, threshold, slice_rows)
    # documents of a day in two tiles would wait for each other, back and forth
    undecided = cut_lineage(_sliced(distinct, slice_rows, pivots, tile_rows, whole_days=True))
    waits = _waits(threshold, window_days)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in undecided.schema.fields) + ", state int"
    leaders = rows.filter(alone).select(*COLUMNS)
    while True:
        slices = undecided.select("slice").distinct().limit(2).count()
        if not slices:
            break
        opened = undecided.withColumn("outside", F.lit(False))
        if slices > 1:
            outside = _meet(undecided, undecided, window_days, waits, threshold, pivots, other=True).select(F.col("hi").alias("id")).distinct()
            outside = cut_lineage(outside)
            # semi and anti joins: the optimizer takes the size of an outer join for a product, which from round to round
            # becomes a number that it cannot reckon with any more
            opened = undecided.join(outside, "id", "left_semi").withColumn("outside", F.lit(True)).unionByName(
                undecided.join(outside, "id", "left_anti").withColumn("outside", F.lit(False)))
        scanned = cut_lineage(spread(opened.select(*undecided.columns, "outside"), "slice").groupBy("slice").applyInPandas(
            _scan(threshold, window_days), schema))
        fresh, rest = (scanned.filter(F.col("state") == state).drop("state") for state in (LEADS, OPEN))
        leaders = leaders.unionByName(fresh.select(*COLUMNS))
        if slices == 1:
            break
        near = _meet(rest, fresh, window_days, waits, threshold, pivots, other=True).select(F.col("hi").alias("id"))
        undecided = cut_lineage(rest.join(near.distinct(), "id", "left_anti").select(*undecided.columns))
    leaders = cut_lineage(leaders)
    others = rows.filter(~alone).join(leaders.select("id"), "id", "left_anti").select(*COLUMNS)
    targets = leaders.filter("day is not null and embedding is not null")
    best = _meet(cut_lineage(_sliced(others, slice_rows, pivots, PAIR_ROWS)), cut_lineage(_sliced(targets, slice_rows, pivots, PAIR_ROWS)), window_days,
                 _best(threshold, window_days), threshold, pivots).groupBy("hi").agg(
        F.max_by("lo", F.struct("sim", -F.col("lo_day"), -F.col("lo_ord"))).alias("leader_id"))
    # callers join the assignment several times (names, sizes, members)
    return cut_lineage(best.select(F.col("hi").alias("id"), "leader_id").unionByName(
        leaders.select("id", F.col("id").alias("leader_id"))))


class TitleLeaders:
    """Leaders of one day in scan order, and the first that a title is close to.

    At ratios near one half two titles need not share any gram, so nothing short
    of all leaders is sure to hold the first. Common subsequences bound the ratio
    from above; the bounds against all leaders are a few array expressions, and
    only leaders that pass are compared, until the first fits.
    """

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.ids: list[str] = []
        self.matchers: list[M.TitleMatcher] = []
        self.banks: dict[int, M.TitleBank] = {}

    def add(self, name: str, title: str) -> None:
        words = 0 if len(title) >= M.LONG_TITLE else max(1, -(-len(title) // M.WORD_BITS))
        if words not in self.banks:
            self.banks[words] = M.TitleBank(words)
        self.banks[words].add(len(self.ids), title)
        self.ids.append(name)
        self.matchers.append(M.TitleMatcher(title))

    def first(self, title: str) -> str | None:
        near = [bank.near(title, self.threshold) for bank in self.banks.values()]
        for i in np.sort(np.concatenate(near)).tolist() if near else ():
            if self.matchers[i].fits(title, self.threshold):
                return self.ids[i]
        return None


def title_clusters(docs: DataFrame, key: str, day: str, order: str, title: str,
                   threshold: float = P.TITLE_RATIO, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(id, leader_id): per day, each document joins the first leader whose title is close enough.

    Equal titles of a day are one row, the first of them: its leader is theirs.
    Quiet days share a slice, which one task scans in order. Of a crowded day each
    round scans the first `slice_rows` open titles, and all others of the day, in
    slices, look for their first match among the new leaders; so titles meet
    leaders only. Documents without a day are a day of their own.
    """
    rows = cut_lineage(docs.select(
        F.col(key).cast("string").alias("id"), F.coalesce(F.col(day).cast("string"), F.lit("\0")).alias("day"),
        F.col(order).cast("long").alias("ord"), title_key(F.col(title)).alias("title")))
    columns = ["id", "leader_id", "title", "ord", "day"]
    schema = "id string, leader_id string, title string, ord long, day string"

    def scan(part: pd.DataFrame) -> pd.DataFrame:
        out, today, leaders = [], None, TitleLeaders(threshold)
        for row in part.sort_values(["day", "ord"]).itertuples():
            if row.day != today:
                today, leaders = row.day, TitleLeaders(threshold)
            leader = leaders.first(row.title)
            if leader is None:
                leaders.add(row.id, row.title)
            out.append((row.id, leader or row.id, row.title, row.ord, row.day))
        return pd.DataFrame(out, columns=columns)

    def match(part: pd.DataFrame, fresh: pd.DataFrame) -> pd.DataFrame:
        leaders = TitleLeaders(threshold)
        for row in fresh.sort_values("ord").itertuples() if len(fresh) else ():
            leaders.add(row.id, row.title)
        found = [(row.id, leaders.first(row.title), row.title, row.ord, row.day) for row in part.itertuples()]
        return pd.DataFrame([f for f in found if f[1] is not None], columns=columns)

    undecided = cut_lineage(rows.groupBy("day", "title").agg(F.min(F.struct("ord", "id")).alias("f")).select("f.id", "day", "f.ord", "title"))
    decided = None
    while not undecided.isEmpty():
        placed = _packed(undecided, slice_rows, min(slice_rows, TITLE_PACK_ROWS))
        heads = placed.filter("not _crowded").select("id", "day", "ord", "title", F.col("_pack").alias("slice")).unionByName(
            first_k(placed.filter("_crowded"), ["day"], [F.col("ord")], slice_rows).select(
                "id", "day", "ord", "title", F.concat(F.lit("d"), "day").alias("slice")))
        scanned = cut_lineage(spread(heads, "slice").groupBy("slice").applyInPandas(scan, schema))
        decided = scanned if decided is None else decided.unionByName(scanned)
        left = undecided.join(scanned.select("id"), "id", "left_anti")
        if left.isEmpty():
            break
        sizes = left.groupBy("day").agg(F.ceil(F.count("*") / slice_rows).cast("int").alias("slices"))
        rest = left.join(sizes, "day").withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int"))
        targets = scanned.filter("id = leader_id").join(sizes, "day").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        matched = cut_lineage(spread(_own(rest), "day", "slice").groupBy("day", "slice").cogroup(
            spread(_own(targets), "day", "slice").groupBy("day", "slice")).applyInPandas(match, schema))
        decided = decided.unionByName(matched)
        undecided = cut_lineage(left.join(matched.select("id"), "id", "left_anti").select("id", "day", "ord", "title"))
    if decided is None:
        return rows.select("id", F.col("id").alias("leader_id"))
    return rows.join(decided.select("day", "title", "leader_id"), ["day", "title"]).select("id", "leader_id")


def name_clusters(assigned: DataFrame, docs: DataFrame, key: str, title: str, captured: str, order: str,
                  restart_daily: bool = False) -> DataFrame:
    """(id, leader_id, cluster_id): `cl_{capture date}_{slug}_{NN}`, NN the opening order of the leader."""
    leaders = assigned.filter("id = leader_id").select(F.col("id").alias("_id")).join(
        docs.select(F.col(key).cast("string").alias("_id"), F.col(title).alias("_title"),
                    F.col(captured).cast("string").alias("_day"), F.col(order).cast("long").alias("_ord")), "_id")
    numbered = with_position(leaders, ["_day"] if restart_daily else [], "_ord", "_n")
    named = numbered.select(F.col("_id").alias("leader_id"), F.concat(
        F.lit("cl_"), F.col("_day"), F.lit("_"), slugify(F.col("_title"), 40), F.lit("_"),
        F.format_string("%02d", F.col("_n") + 1)).alias("cluster_id"))
    return assigned.join(named, "leader_id").select("id", "leader_id", "cluster_id")


def cluster_stats(members: DataFrame, cluster: str, source: str) -> DataFrame:
    """Size and sorted distinct non-empty sources; sources are made distinct before they are collected."""
    sizes = members.groupBy(cluster, source).agg(F.count("*").alias("_n"))
    return sizes.groupBy(cluster).agg(
        F.sum("_n").alias("cluster_size"),
        F.array_sort(F.collect_list(F.when(F.col(source) != "", F.col(source)))).alias("cluster_sources"),
    )


def with_cluster_stats(docs: DataFrame, stats: DataFrame, cluster: str, source: str) -> DataFrame:
    own = F.when(F.coalesce(F.col(source), F.lit("")) != "", F.array(F.col(source))).otherwise(
        F.array().cast("array<string>"))
    return docs.join(stats, cluster, "left").withColumns({
        "cluster_size": F.coalesce("cluster_size", F.lit(1)),
        "cluster_sources": F.coalesce("cluster_sources", own),
    })


def corroboration(members: DataFrame, cluster: str, source: str) -> DataFrame:
    """Clusters with the number of distinct sources that report them."""
    return members.groupBy(cluster).agg(
        F.countDistinct(F.when(F.col(source) != "", F.col(source))).alias("n_sources"),
        F.count("*").alias("n_items"))
