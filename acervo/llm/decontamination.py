"""Benchmark decontamination: an FM-index per training shard, searched backwards for the benchmark's word windows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import arrow_pass, utf8, worker_store

# lower-cases A-Z; every ASCII byte that is no letter or digit becomes a blank
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SEPARATOR = 1


def fold_words(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


class BitRank:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words)[:-1], out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """Ranks of any symbol in a sequence; one bit vector per level, nodes found by their symbols' counts."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.depth = max(1, (sigma - 1).bit_length())
        self.less = np.zeros((1 << self.depth) + 1, np.int64)
        np.cumsum(np.bincount(values, minlength=1 << self.depth), out=self.less[1:])
        self.levels = []
        for level in range(self.depth):
            shift = self.depth - 1 - level
            self.levels.append(BitRank((values >> shift & 1).astype(bool)))
            values = values[np.argsort(values >> shift, kind="stable")]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        place = at.copy()
        for level, bits in enumerate(self.levels):
            shift = self.depth - 1 - level
            start = self.less[symbol >> (shift + 1) << (shift + 1)]
            ones = bits.ones(start + place) - bits.ones(start)
            place = np.where(symbol >> shift & 1, ones, place - ones)
        return place


def suffix_order(values: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; suffixes still tied are the only ones sorted again."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    rank = np.empty(n, np.int64)
    ordered = values[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    step = 1
    while not first.all():
        group_end = np.concatenate([first[1:], [True]])
        tied = np.flatnonzero(~(first & group_end))
        rows = order[tied]
        following = rows + step
        second = np.where(following < n, rank[np.minimum(following, n - 1)], -1)
        key = rank[rows] * (n + 1) + second + 1
        by = np.argsort(key, kind="stable")
        rows, key = rows[by], key[by]
        order[tied] = rows
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first[tied] = new
        rank[rows] = np.maximum.accumulate(np.where(new, tied, 0))
        step *= 2
    return order


class FMIndex:
    """Index of runs of symbols (2 and above), parted by separators; positions sampled at run starts and every `sample`."""

    def __init__(self, runs: np.ndarray, sigma: int, sample: int = 16):
        n = len(runs)
        parted = runs == SEPARATOR
        # each separator sorts as a symbol of its own, so no comparison crosses it
        keys = runs.astype(np.int64) + parted.sum()
        keys[parted] = np.arange(parted.sum())
        order = suffix_order(keys)
        self.last = runs[order - 1]
        self.tree = WaveletTree(self.last, sigma)
        self.n, self.less = n, self.tree.less
        previous = np.concatenate([[True], parted[:-1]])
        keep = ((np.arange(n) % sample == 0) | previous)[order]
        self.marked = BitRank(keep)
        self.is_marked = keep
        self.positions = order[keep]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals of the patterns, read from their last symbols (patterns are right-aligned)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for back in range(1, patterns.shape[1] + 1):
            live = live[(lengths[live] >= back) & (low[live] < high[live])]
            symbols = patterns[live, -back]
            low[live] = self.less[symbols] + self.tree.rank(symbols, low[live])
            high[live] = self.less[symbols] + self.tree.rank(symbols, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back to a sampled one."""
        rows = rows.copy()
        steps = np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.is_marked[rows])
        while len(walking):
            at = rows[walking]
            symbols = self.last[at]
            rows[walking] = self.less[symbols] + self.tree.rank(symbols, at)
            steps[walking] += 1
            walking = walking[~self.is_marked[rows[walking]]]
        return self.positions[self.marked.ones(rows)] + steps


class Phrases:
    """The windows of one block of benchmark items, coded by the block's own vocabulary."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.codes: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, raw in items:
            coded = [self.codes.setdefault(w, len(self.codes) + 2) for w in fold_words(raw)]
            for at in range(max(1, len(coded) - window + 1)) if coded else ():
                owners.setdefault(tuple(coded[at:at + window]), set()).add(item)
        self.owners = list(owners.values())
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.patterns = np.zeros((len(owners), window), np.int64)
        for row, pattern in enumerate(owners):
            self.patterns[row, window - len(pattern):] = pattern
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0

    def hits(self, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, word place and window of each occurrence in a shard's documents."""
        none = np.empty(0, np.int64)
        counts = np.fromiter(map(len, words), np.int64, len(words))
        if not len(self.owners) or not counts.sum():
            return none, none, none
        get = self.codes.get
        coded = np.fromiter((get(w, 0) for w in chain.from_iterable(words)), np.int32, int(counts.sum()))
        document = np.repeat(np.arange(len(words)), counts)
        # words outside the phrases' vocabulary end a run, and runs shorter than every window hold none
        known = coded > 0
        starts = np.flatnonzero(known & np.concatenate([[True], ~known[:-1] | (document[1:] != document[:-1])]))
        ends = np.flatnonzero(known & np.concatenate([~known[1:] | (document[1:] != document[:-1]), [True]])) + 1
        long = ends - starts >= self.shortest
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return none, none, none
        sizes = ends - starts + 1
        begins = np.cumsum(sizes) - sizes
        runs = np.full(int(sizes.sum()), SEPARATOR, np.int32)
        inside = np.arange(len(runs)) - np.repeat(begins, sizes)
        source = np.repeat(starts, sizes) + inside
        body = inside < np.repeat(sizes - 1, sizes)
        runs[body] = coded[source[body]]
        index = FMIndex(runs, len(self.codes) + 2)
        low, high = index.search(self.patterns, self.lengths)
        found = np.flatnonzero(high > low)
        many = high[found] - low[found]
        rows = np.repeat(low[found] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        at = source[index.locate(rows)]
        first = np.cumsum(counts) - counts
        return document[at], at - first[document[at]], np.repeat(found, many)


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined; starts are sorted."""
    out: list[list[int]] = []
    for a, b in zip(starts.tolist(), ends.tolist()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_words(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from each span's first word to its last."""
    places = [(m.start(), m.end()) for m in re.finditer(rb"[^ ]+", raw.translate(FOLD))]
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, raw[at:]])


def benchmark_spans(docs: DataFrame, items: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = 10,
                    clean: bool = False, block_bytes: int = 8_000_000, shard_bytes: int = 6_000_000) -> DataFrame:
    """Spans of document words that lie in a benchmark window.

    Words are runs of ASCII letters, digits and all characters beyond ASCII, with A-Z lower-cased. A window is `window`
    consecutive words of an item; an item of fewer words, but not none, is one window. Columns: those of `keep`,
    n_words, spans (array of [start, end) in words, merged), items (sorted ids as strings), and with `clean` the text
    without its spans. Null texts have no words (and stay null when cleaned); items of null text hold no window; repeated
    items count once; a null item id reads "null". Repeated documents give repeated rows, empty tables no rows.
    The items reach the tasks in blocks of `block_bytes` (or one item); a shard is `shard_bytes` of text (or one document).
    """
    spark = docs.sparkSession
    texts = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), utf8().alias("raw"))
    total = texts.agg(F.sum(F.length("raw"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    sent = []
    for block in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).where("raw is not null").collect()
        sent.append(spark.sparkContext.broadcast([(r.item, bytes(r.raw)) for r in sorted(rows)]))
    types, version = dict(docs.dtypes), uuid.uuid4().hex
    schema = ", ".join([f"_k{i} {types[c]}" for i, c in enumerate(keep)] + [
        "n_words bigint, spans array<struct<s:bigint,e:bigint>>, items array<string>"] + (["text string"] if clean else []))

    def run(batches) -> Iterator[dict[str, list]]:
        phrases = worker_store("phrases", version, lambda: [Phrases(sent[0].value, window)]) if len(sent) == 1 else None

        def finish(kept, raws):
            words = [fold_words(raw or b"") for raw in raws]
            spans: list[list[tuple[int, int]]] = [[] for _ in raws]
            owners: list[set[str]] = [set() for _ in raws]
            for block in phrases or (Phrases(b.value, window) for b in sent):
                document, start, pattern = block.hits(words)
                by = np.lexsort((start, document))
                document, start, pattern = document[by], start[by], pattern[by]
                at = np.flatnonzero(np.concatenate([[True], document[1:] != document[:-1]])) if len(document) else []
                for a, b in zip(at, [*at[1:], len(document)]):
                    d = int(document[a])
                    spans[d] += merged(start[a:b], start[a:b] + block.lengths[pattern[a:b]])
                    for p in np.unique(pattern[a:b]).tolist():
                        owners[d] |= block.owners[p]
            if len(sent) > 1:
                spans = [merged(*np.array(sorted(s), np.int64).reshape(-1, 2).T) for s in spans]
            out = {f"_k{i}": kept[i] for i in range(len(keep))} | {
                "n_words": [len(w) for w in words],
                "spans": [[{"s": a, "e": b} for a, b in s] for s in spans],
                "items": [sorted(o) for o in owners]}
            if clean:
                out["text"] = [raw if not s else without_words(raw, s) for raw, s in zip(raws, spans)]
                out["text"] = [None if t is None else t.decode() for t in out["text"]]
            return out

        kept, raws, size = [[] for _ in keep], [], 0
        for batch in batches:
            for i in range(len(keep)):
                kept[i] += batch.column(i).to_pylist()
            new = batch.column(len(keep)).to_pylist()
            raws += new
            size += sum(len(r) for r in new if r)
            if size >= shard_bytes:
                yield finish(kept, raws)
                kept, raws, size = [[] for _ in keep], [], 0
        if raws:
            yield finish(kept, raws)

    found = arrow_pass(docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], utf8().alias("_raw")),
                       run, schema)
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
                        *[c for c in found.columns if not c.startswith("_k")])


def span_length(column: str = "spans") -> Column:
    return F.aggregate(column, F.lit(0).cast("bigint"), lambda total, s: total + s["e"] - s["s"])
