"""Periodic runs of words by seed and extend along diagonals.

A stretch with period q matches itself q words on. Lags fall into classes [p, 2p); a run of a class matches itself over a
guaranteed number of words, so it holds a whole aligned gram of half that length. Grams are indexed, an aligned gram is
paired with its occurrences at the lags of the class only (at most two pairs a word and class, however often a word
repeats), and pairs that follow each other on a diagonal are one seed: only its ends are extended.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import SPACE, arrow_schema

LEAST_WORDS = 12
SLICE_BYTES = 2_000_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def guaranteed(p: int, least: int) -> int:
    """Fewest words over which a run whose period is in [p, 2p) matches itself one period on."""
    return min(max(least - q, q) for q in range(p, 2 * p)) if p < least else p


def gram_of(p: int, least: int) -> int:
    """Largest power of two such that any stretch of the guaranteed length holds an aligned gram of it."""
    size = 1
    while 4 * size - 1 <= guaranteed(p, least):
        size *= 2
    return size


class Grams:
    """Exact names of all grams whose length is a power of two: equal grams have equal names."""

    def __init__(self, words: np.ndarray):
        self.levels = {1: words}

    def of(self, size: int, end: int) -> np.ndarray:
        """Names of the grams of `size` words within the first `end` words; a larger size is never asked for a larger end."""
        if size not in self.levels:
            half = self.of(size // 2, end)
            n = max(0, end - size + 1)
            keys = half[:n] * (int(half.max(initial=0)) + 1) + half[size // 2:size // 2 + n]
            self.levels[size] = pd.factorize(keys)[0].astype(np.int64)
        return self.levels[size][:max(0, end - size + 1)]


def seeds(names: np.ndarray, size: int, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lag, start and end of the aligned grams that match at a lag in [p, 2p), those in a row on one diagonal as one."""
    again = np.flatnonzero(np.bincount(names)[names] > 1) if len(names) else np.empty(0, np.int64)
    span = 2 * len(names) + 4 * p + 2
    index = np.sort(names[again] * span + again)
    at = again[again % size == 0]
    keys = names[at] * span + at
    low, high = np.searchsorted(index, keys + p), np.searchsorted(index, keys + 2 * p)
    n = high - low
    first = np.repeat(at, n)
    other = index[np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(first))] % span
    pairs = np.sort((other - first) * span + first)
    lag, first = pairs // span, pairs % span
    opens = np.ones(len(pairs), bool)
    opens[1:] = (lag[1:] != lag[:-1]) | (first[1:] != first[:-1] + size)
    closes = np.append(opens[1:], True)[:len(opens)]
    return lag[opens], first[opens], first[closes] + size


def extended(grams: Grams, lag: np.ndarray, start: np.ndarray, end: np.ndarray, size: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Both ends moved as far as the diagonal matches; less than one gram each way, or the next gram were in the seed."""
    start, end = start.copy(), end.copy()
    step = size // 2
    while step:
        names = grams.of(step, limit)
        last = len(names) - 1
        right = (end + lag <= last) & (names[np.minimum(end, last)] == names[np.minimum(end + lag, last)])
        left = (start >= step) & (names[np.maximum(start - step, 0)] == names[np.maximum(start - step, 0) + lag])
        end[right] += step
        start[left] -= step
        step //= 2
    return start, end


def find_runs(words: np.ndarray, lengths: np.ndarray, least: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs in documents that stand one after the other by falling length, each followed by
    a word of its own that occurs nowhere else."""
    grams = Grams(words)
    ends = np.cumsum(lengths + 1)
    found = [np.empty((3, 0), np.int64)]
    reached = (np.empty(0, np.int64), np.empty(0, np.int64))
    p = 1
    while True:
        # only documents that can hold a run of this class
        live = int(np.searchsorted(-lengths, -max(least, 2 * p), side="right"))
        if not live:
            break
        limit = int(ends[live - 1])
        size = gram_of(p, least)
        lag, start, end = seeds(grams.of(size, limit), size, p)
        if len(lag):
            start, end = extended(grams, lag, start, end, size, limit)
            end = end + lag
            # a smaller period of the stretch divides the lag, so its run is of an earlier class and covers the stretch
            at = np.searchsorted(reached[0], start, side="right") - 1
            covered = np.zeros(len(lag), bool)
            if len(reached[0]):
                covered = (at >= 0) & (reached[1][np.maximum(at, 0)] >= end)
            new = (end - start >= np.maximum(least, 2 * lag)) & ~covered
            found.append(np.stack([start[new], end[new], lag[new]]))
            every = np.concatenate(found, axis=1)
            by = np.argsort(every[0], kind="stable")
            reached = every[0][by], np.maximum.accumulate(every[1][by])
        p *= 2
    start, end, period = np.concatenate(found, axis=1)
    return start, end, period


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of all texts together: each word's number in a dictionary, the dictionary, and where each text's words begin."""
    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = ~SPACE[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    border[-1] = True
    before = np.append(False, inside)[:-1] & ~border[:-1]
    after = np.append(inside, False)[1:] & ~border[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    bounds = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.empty(0, np.int64), pa.array([], pa.binary()), bounds
    # words and the gaps between them by turns, so no byte is copied
    edges = np.stack([starts, ends], axis=1).ravel().astype(np.int32)
    parts = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
    coded = parts.dictionary_encode()
    return coded.indices.to_numpy()[::2].astype(np.int64), coded.dictionary, bounds


def read_slice(texts: pa.Array, least: int) -> list[pa.Array]:
    """n_words, runs and collapsed text of each text."""
    ids, dictionary, bounds = words_of(texts)
    n = np.diff(bounds)
    order = np.argsort(-n, kind="stable")
    lengths = n[order]
    base = np.cumsum(lengths + 1) - lengths - 1
    place = np.empty(len(n), np.int64)
    place[order] = base
    at = np.repeat(place - bounds[:-1], n) + np.arange(len(ids))
    line = np.empty(len(ids) + len(n), np.int64)
    line[at] = ids
    line[base + lengths] = len(dictionary) + np.arange(len(n))
    start, end, period = find_runs(line, lengths, least)
    change = np.zeros(len(line) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change)[at] == 0
    doc = np.searchsorted(base, start, side="right") - 1
    start, doc, length = start - base[doc], order[doc], end - start
    by = np.lexsort((period, start, doc))
    items = pa.StructArray.from_arrays([pa.array(x[by]) for x in (start, length, period)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[by], np.arange(len(n) + 1)).astype(np.int32)), items)
    counts = np.append(0, np.cumsum(kept))[bounds].astype(np.int32)
    words = pa.ListArray.from_arrays(pa.array(counts), dictionary.take(pa.array(ids[kept])))
    joined = pc.binary_join(words, b" ")
    return [pa.array(n.astype(np.int64)), runs, pa.Array.from_buffers(pa.string(), len(joined), joined.buffers())]


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of `keep`, n_words, runs (start, length, period, by start, then period) and the collapsed text.

    Words are parted by ASCII white space and numbered from 0. A run is a stretch with smallest period q of at least
    `least` and 2q words that cannot grow by a word with that period. The collapsed text holds the words that no run
    covers after its first period, joined by one blank. A null or blank text has no word, no run and an empty collapsed
    text; repeated rows repeat, null ids are values like any other, an empty table gives none; other columns play no part.
    Nothing is shuffled; a task holds a slice of about 2 MB of texts, or one longer text, and per word and doubling of
    the lag a bounded number of pairs, however often a word or passage repeats.
    """
    types = dict(docs.dtypes)
    schema = ", ".join([f"_k{i} {types[c]}" for i, c in enumerate(keep)] + [f"n_words bigint, runs {RUNS}, collapsed string"])
    arrow = arrow_schema(docs.sparkSession, schema)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep))
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, side="right")))
                part = batch.slice(at, end - at)
                found = read_slice(part.column(len(keep)), least)
                columns = [part.column(i) for i in range(len(keep))] + [x.cast(arrow.types[len(keep) + i]) for i, x in enumerate(found)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
                at = end

    found = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)],
                        F.col("text").cast("string").alias("_text")).mapInArrow(run, schema)
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "runs", "collapsed")
