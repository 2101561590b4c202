"""Suffix-array dedup: shards' Burrows-Wheeler transforms merged by refining their interleave, never sorting all suffixes.

Segments of text around repeated anchors are dealt to batches in which every repeated string has all its occurrences. A
batch is cut into shards, each with its own transform; two transforms are merged by refining blocks of rows alike in 1, 2,
4, 8 ... bytes. A shard's rows stay in their order, so a round merges two ascending runs, and the blocks of all rounds give
the common prefix of any two neighbours. Intervals of suffixes alike in `window` bytes fall out without comparing suffixes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import arrow_pass, staged, unsqueezed
from acervo.llm.repeats import aligned, anchored, assembled, candidates, contexts, cut, firsts, seeded, settled, with_texts

SEED_BYTES = 32
BATCH_BYTES = 1 << 19
#: different segments of one anchor, which one task holds: about 1.5 MB at a window of 100
MOST_CONTEXTS = 10000


class Transform:
    """Burrows-Wheeler transform of strings, each with an end mark of its own: symbols 0 (end) and byte + 1.

    `places` holds each row's place in the strings; `shared`, of a merged transform, its common prefix with the row before.
    """

    def __init__(self, last: np.ndarray, places: np.ndarray, strings: int, shared: np.ndarray | None = None):
        self.last, self.places, self.strings, self.shared = last, places, strings, shared

    @classmethod
    def of(cls, parts: list[bytes], offset: int) -> Transform:
        """Transform of one shard; places count from `offset`, each string followed by its end mark."""
        text = np.frombuffer(b"\0".join([*parts, b""]), np.uint8).astype(np.int16) + 1
        text[np.cumsum([len(p) + 1 for p in parts]) - 1] = 0
        order = marked_order(text)
        return cls(text[order - 1], order + offset, len(parts))

    def following(self) -> np.ndarray:
        """For each row the row of its suffix without the first byte; an end mark's is its own."""
        rows = np.argsort(self.last, kind="stable").astype(np.int32)
        rows[:self.strings] = np.arange(self.strings)
        return rows


def marked_order(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of strings that end in 0; each end is a symbol of its own, the first string's the smallest.

    The first four symbols are sorted at once, then twice as many a round; suffixes still tied are the only ones sorted again.
    """
    n, bits = len(text), max(1, len(text).bit_length())
    key, within = np.zeros(n, np.int64), np.ones(n, bool)
    padded = np.append(text, np.zeros(3, np.int64))
    for i in range(4):
        symbol = padded[i:i + n]
        key = (key << 9) | np.where(within, symbol, 0)
        within &= symbol > 0
    # a suffix that ends here is told from its like by its place, which follows the strings' order
    ordered = np.sort((key << bits) | np.arange(n))
    order = ordered & ((1 << bits) - 1)
    ordered >>= bits
    first = np.ones(n, bool)
    first[1:] = (ordered[1:] != ordered[:-1]) | ~within[order[1:]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    step = 4
    tied = np.arange(n)
    while True:
        begins = first[tied]
        tied = tied[~(begins & np.append(begins[1:], True))]
        if not len(tied):
            return order
        rows = order[tied]
        key = rank[rows] * n + rank[rows + step]
        by = np.argsort(key)
        rows, key = rows[by], key[by]
        order[tied] = rows
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first[tied] = new
        rank[rows] = np.maximum.accumulate(np.where(new, tied, 0))
        step *= 2


def merge(a: Transform, b: Transform) -> Transform:
    """Merged transform of both shards' strings, `shared` holding each row's common prefix with the row before.

    Rows are numbered shard after shard. Rows alike in `depth` bytes are a block; a row's block and the block of the row
    `depth` bytes on tell its block at twice the depth. Inside a shard both ascend, so a round merges two ascending runs.
    Rows alone in their block are placed and left out of later rounds.
    """
    n, marks = len(a.last) + len(b.last), a.strings + b.strings
    after = np.concatenate([a.following(), b.following() + np.int32(len(a.last))])
    # end marks are all different and stand first, the first shard's before the second's
    symbol = np.concatenate([np.sort(a.last), np.sort(b.last)]).astype(np.int64) + marks
    symbol[:a.strings] = np.arange(a.strings)
    symbol[len(a.last):len(a.last) + b.strings] = np.arange(a.strings, marks)
    bits = (marks + 257).bit_length()
    depth = 4 if 4 * bits < 64 else 2
    opening, step = symbol, after
    for _ in range(depth - 1):
        opening = (opening << bits) | symbol[step]
        step = after[step]
    place, block, levels = np.empty(n, np.int32), np.empty(n, np.int32), []
    rows, spots, key = np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32), opening
    while True:
        by = np.argsort(key, kind="stable")
        ordered, moved = key[by], rows[by]
        first = np.ones(len(key), bool)
        first[1:] = ordered[1:] != ordered[:-1]
        block, place[spots] = block.copy(), moved
        block[moved] = spots[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        levels.append((depth, block, step))
        alone = first & np.append(first[1:], True)
        if alone.all():
            break
        # a shard's rows are taken in their order again
        tied = np.zeros(n, bool)
        tied[moved[~alone]] = True
        rows, spots = np.flatnonzero(tied).astype(np.int32), spots[~alone]
        ahead = step[rows]
        key = block[rows].astype(np.int64) * n + block[ahead]
        step = step.copy()
        step[rows] = step[ahead]
        depth *= 2
    shared = np.zeros(n, np.int32)
    left, right = place[:-1].copy(), place[1:].copy()
    for depth, block, step in reversed(levels):
        same = np.flatnonzero(block[left] == block[right])
        shared[1:][same] += depth
        left[same], right[same] = step[left[same]], step[right[same]]
    differ = opening[left] ^ opening[right]
    for i in range(1, levels[0][0]):
        shared[1:] += (differ >> (i * bits)) == 0
    return Transform(np.concatenate([a.last, b.last])[place], np.concatenate([a.places, b.places])[place], marks, shared)


def repeats(parts: list[bytes], window: int, shards: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the strings laid end to end, one mark after each) of suffixes alike in `window` bytes with another, and the
    number of each one's interval, ascending."""
    offset, level = 0, []
    for mine in np.array_split(np.arange(len(parts)), min(shards, len(parts))):
        strings = [parts[i] for i in mine]
        level.append(Transform.of(strings, offset))
        offset += sum(len(p) + 1 for p in strings)
    if len(level) == 1:
        level.append(Transform(np.empty(0, np.int16), np.empty(0, np.int64), 0))
    while len(level) > 1:
        level = [merge(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    whole = level[0]
    begins = whole.shared < window
    repeated = ~(begins & np.append(begins[1:], True))
    return whole.places[repeated], np.cumsum(begins)[repeated]


def repeated_intervals(parts: list[bytes], window: int, shards: int = 2) -> Iterator[np.ndarray]:
    """The places of `repeats`, interval by interval."""
    places, interval = repeats(parts, window, shards)
    if len(places):
        yield from np.split(places, np.flatnonzero(np.diff(interval)) + 1)


def segments(held: DataFrame, window: int) -> DataFrame:
    """The bytes of segments by document (d, x, raw, got): h, d, x, a, m, seg. Of repeated rows that meet, one goes on."""
    def run(batches) -> Iterator[dict[str, list]]:
        names = ["h", "d", "x", "a", "m", "seg"]
        last = None
        for batch in batches:
            rows = []
            for d, x, raw, got in zip(*[c.to_pylist() for c in batch.columns]):
                if (d, x) == last:
                    continue
                last = d, x
                raw = unsqueezed(raw)
                rows += [(g["h"], d, x, g["a"], g["m"], raw[g["a"]:g["a"] + g["m"] + window - 1]) for g in got]
            if rows:
                yield dict(zip(names, map(list, zip(*rows))))

    return arrow_pass(held, run, "h bigint, d bigint, x bigint, a int, m int, seg binary", rows=32)


def merged_repeats(dealt: DataFrame, window: int) -> DataFrame:
    """Windows that start earlier in another segment of their anchor, as ranges of starts: d, x, s, e.

    `dealt` is sorted by h, d, x and a; a segment that repeated rows bring several times is taken once.
    """
    def solve(rows):
        d, x, a, m = (np.array(c, np.int64) for c in zip(*[r[1:5] for r in rows]))
        parts = [r[5] for r in rows]
        begins = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        rank = np.empty(len(rows), np.int64)
        rank[np.lexsort((a, x, d))] = np.arange(len(rows))
        places, interval = repeats(parts, window)
        part = np.searchsorted(begins, places, side="right") - 1
        inside = places - begins[part]
        own = inside < m[part]
        part, inside, interval = part[own], inside[own], interval[own]
        by = np.lexsort((inside, rank[part], interval))
        later = by[1:][interval[by[1:]] == interval[by[:-1]]]
        part, inside = part[later], inside[later]
        by = np.lexsort((inside, part))
        part, start = part[by], inside[by]
        opens = np.ones(len(part), bool)
        opens[1:] = (part[1:] != part[:-1]) | (start[1:] != start[:-1] + 1)
        ends = np.append(opens[1:], True)[:len(part)]
        own = part[opens]
        return {"d": d[own], "x": x[own], "s": a[own] + start[opens], "e": a[own] + start[ends] + 1}

    def run(batches) -> Iterator[dict[str, list]]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
        held, size = [], 0
        for _, group in groupby(rows, key=lambda row: row[0]):
            mine = [next(same) for _, same in groupby(group, key=lambda row: row[:4])]
            length = sum(len(row[5]) for row in mine)
            if held and size + length > BATCH_BYTES:
                yield solve(held)
                held, size = [], 0
            held += mine
            size += length
        if held:
            yield solve(held)

    return arrow_pass(dealt, run, "d bigint, x bigint, s int, e int", rows=2048)


def deduplicated(docs: DataFrame, window: int = 100, seed: int = SEED_BYTES) -> DataFrame:
    """Bytes covered by a string of `window` bytes that also starts earlier are removed: doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256.

    Texts are UTF-8 bytes (null: empty), matches never cross documents. Earlier means a smaller doc_id (null first), or the same
    document and a smaller place; strings are judged on the input and may overlap. Rows that share doc_id and text are
    one document, each row getting its result; of rows that share doc_id alone the smaller text hash comes first. A copy
    of a whole document of `window` bytes or more is removed whole. An empty table gives no row; other columns play no
    part.

    Segments alike in all their bytes are settled by an aggregate, so only an anchor's different segments reach the
    merge; anchors with more than MOST_CONTEXTS of these are settled window by window, so no task
    holds an unbounded group.
    """
    found = anchored(docs, "byte", seed, window)
    first = staged(firsts(found, window), "firsts")
    texts = contexts(candidates(docs, seeded(found, first)), "byte", window, seed)
    copies, different = settled(texts)
    bound = F.lit(MOST_CONTEXTS)
    few = segments(with_texts(texts, different.where(F.col("of") <= bound)), window)
    merged = merged_repeats(few.repartition("h").sortWithinPartitions("h", "d", "x", "a"), window)
    hot = aligned(with_texts(texts, different.where(F.col("of") > bound)), "byte", window)
    removed = cut(texts, copies.union(merged).union(hot), "byte", window)
    return assembled(found, first, removed, window).withColumnRenamed("n", "n_bytes").withColumnRenamed("sha", "kept_sha256")
