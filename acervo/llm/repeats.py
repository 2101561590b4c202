"""Winnowed anchors: where a document may repeat a passage of another, or of itself, found by one equi join."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import (
    GRAM_P, WORD_P, Rolling, arrow_pass, byte_values, mix, squeezed, staged, unsqueezed, utf8, winnow, word_spans,
)

_BYTES, _UNITS, _OTHER = Rolling(WORD_P), Rolling(GRAM_P), Rolling(WORD_P)
NO_ID = -(1 << 63)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


class Units:
    """A text as a sequence of units (words or bytes), each with a 64-bit value."""

    def __init__(self, raw: bytes, unit: str):
        self.raw, self.unit, self.grams = raw, unit, {}
        if unit == "word":
            self.data, self.starts, self.ends = word_spans(raw)
        self.n = len(self.starts) if unit == "word" else len(raw)

    @cached_property
    def values(self) -> np.ndarray:
        if self.unit == "word":
            return _BYTES.ranges(_BYTES.sums(byte_values(self.data)), self.starts, self.ends)
        return byte_values(np.frombuffer(self.raw, np.uint8))

    @cached_property
    def sums(self) -> np.ndarray:
        return _UNITS.sums(self.values)

    def anchors(self, seed: int, window: int) -> np.ndarray:
        """For each run of `window` units the place of the run of `seed` units in it with the smallest hash.

        Equal runs have their anchor at equal offsets, so every repeated run shares an anchor with its repeat.
        """
        return winnow(mix(self.seeds(seed)), window - seed + 1)

    def seeds(self, seed: int) -> np.ndarray:
        if seed not in self.grams:
            self.grams[seed] = _UNITS.grams(self.sums, seed)
        return self.grams[seed]

    def keys(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each range's units, as two arrays of signed 64-bit integers."""
        other = _OTHER.sums(self.values)
        return _UNITS.ranges(self.sums, starts, ends).view(np.int64), _OTHER.ranges(other, starts, ends).view(np.int64)

    def kept(self, spans: list[tuple[int, int]]) -> bytes:
        """What is left without the spans: words joined by one blank, or bytes."""
        if self.unit == "byte":
            out, at = [], 0
            for a, b in spans:
                out.append(self.raw[at:a])
                at = b
            return b"".join([*out, self.raw[at:]])
        keep = np.ones(self.n, bool)
        for a, b in spans:
            keep[a:b] = False
        return b" ".join([w for w, k in zip(self.raw.split(), keep.tolist()) if k])


def keyed(docs: DataFrame) -> DataFrame:
    """d (doc_id, null as the smallest long), x (text hash) and the text's bytes; null texts are empty."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("d"),
                       F.xxhash64("text").alias("x"), F.coalesce(utf8(), F.lit(b"")).alias("raw"))


def anchored(docs: DataFrame, unit: str, seed: int, window: int) -> DataFrame:
    """d, x, n (units), sha (of all units kept), whole (key of the sequence), h and p (anchors' hashes and places)."""
    import xxhash

    def run(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            d, x, raws = (c.to_pylist() for c in batch.columns)
            out: dict[str, list] = {"d": d, "x": x, "n": [], "sha": [], "whole": [], "h": [], "p": []}
            for raw in raws:
                text = Units(raw, unit)
                joined = text.kept([])
                places = np.unique(text.anchors(seed, window))
                out["n"].append(text.n)
                out["sha"].append(hashlib.sha256(joined).hexdigest())
                out["whole"].append(xxhash.xxh3_128_digest(joined))
                out["h"].append(text.seeds(seed)[places].view(np.int64))
                out["p"].append(places.astype(np.int32))
            yield out

    return staged(arrow_pass(keyed(docs), run, "d bigint, x bigint, n bigint, sha string, whole binary, "
                             "h array<bigint>, p array<int>", rows=128), "anchored")


def firsts(found: DataFrame, window: int) -> DataFrame:
    """Of documents with equal sequences of `window` units or more, the first: whole, fd, fx."""
    return found.where(F.col("n") >= window).groupBy("whole").agg(F.min(F.struct("d", "x")).alias("f")).select(
        "whole", F.col("f.d").alias("fd"), F.col("f.x").alias("fx"))


def seeded(found: DataFrame, first: DataFrame) -> DataFrame:
    """Documents with anchors that occur again, copies of whole documents left out: k (hash of d and x), seeds (places).

    Counts are summed before they are shuffled; only the repeated anchors' documents go on. Should two documents share k,
    each gets the other's places as well, where it has no anchor or one more to look into.
    """
    own = found.join(first, "whole").where("d = fd and x = fx").select(
        F.xxhash64("d", "x").alias("k"), F.explode(F.arrays_zip("h", "p")).alias("s")).select("k", F.col("s.h").alias("h"), F.col("s.p").alias("p"))
    # a table of its own, so that the join can split an anchor with very many rows
    again = staged(own.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "again")
    return own.join(again, "h", "left_semi").groupBy("k").agg(F.collect_set("p").alias("seeds"))


def candidates(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """The seeded documents' texts: d, x, raw (compressed), seeds."""
    def run(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            d, x, raws = (c.to_pylist() for c in batch.columns)
            yield {"d": d, "x": x, "raw": [squeezed(r) for r in raws]}

    found = arrow_pass(keyed(docs), run, "d bigint, x bigint, raw binary").join(
        seeds, F.xxhash64("d", "x") == F.col("k"))
    return found.select("d", "x", "raw", "seeds")


def contexts(texts: DataFrame, unit: str, window: int, seed: int) -> DataFrame:
    """Per document its repeated anchors' segments: h (anchor), k1 and k2 (128 bits of the segment), a (start), m (windows).

    A segment grows from its seed both ways as far as the windows reach whose own smallest anchor the seed is. So each
    window lies in one segment, and equal windows lie in segments of equal anchors.
    """
    def run(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            d, x, raws, seeds = (c.to_pylist() for c in batch.columns)
            out: dict[str, list] = {"d": d, "x": x, "raw": raws, "h": [], "k1": [], "k2": [], "a": [], "m": []}
            for raw, places in zip(raws, seeds):
                text = Units(unsqueezed(raw), unit)
                owner = text.anchors(seed, window)
                starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                counts = np.diff(np.append(starts, len(owner)))
                mine = np.isin(owner[starts], np.array(places))
                starts, counts = starts[mine], counts[mine]
                spot = owner[starts]
                one, two = text.keys(starts, starts + counts + window - 1)
                shape = mix(((spot - starts).astype(np.uint64) << np.uint64(32)) | counts.astype(np.uint64)).view(np.int64)
                out["h"].append(text.seeds(seed)[spot].view(np.int64))
                out["k1"].append(one ^ shape)
                out["k2"].append(two)
                out["a"].append(starts.astype(np.int32))
                out["m"].append(counts.astype(np.int32))
            yield out

    return staged(arrow_pass(texts, run, "d bigint, x bigint, raw binary, h array<bigint>, k1 array<bigint>, k2 array<bigint>, "
                             "a array<int>, m array<int>", rows=64), "contexts")


def settled(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segments alike in all their units, settled at once, and those to look into.

    The first: windows of every copy of an earlier segment, as ranges of starts (d, x, s, e). The second: each different
    segment's first copy (h, of, d, x, a, m), where its anchor has several (`of`).
    """
    each = texts.select("d", "x", F.explode(F.arrays_zip("h", "k1", "k2", "a", "m")).alias("c")).select(
        "d", "x", "c.h", "c.k1", "c.k2", "c.a", "c.m")
    alike = staged(each.groupBy("h", "k1", "k2").agg(F.min(F.struct("d", "x", "a", "m")).alias("f"),
                                                     F.count("*").alias("n")), "alike")
    earlier = alike.where("n > 1").select("h", "k1", "k2", F.struct("f.d", "f.x", "f.a").alias("g"))
    copies = each.join(earlier, ["h", "k1", "k2"]).where(F.struct("d", "x", "a") > F.col("g")).select(
        "d", "x", F.col("a").alias("s"), (F.col("a") + F.col("m")).alias("e"))
    many = staged(alike.groupBy("h").agg(F.count("*").alias("of")).where("of > 1"), "many")
    return copies, alike.join(many, "h").select("h", "of", "f.d", "f.x", "f.a", "f.m")


def with_texts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted segments by document: d, x, raw, got (array of h, a, m)."""
    got = wanted.groupBy("d", "x").agg(F.collect_list(F.struct("h", "a", "m")).alias("got"))
    return texts.select("d", "x", "raw").join(got, ["d", "x"]).select("d", "x", "raw", "got")


def aligned(held: DataFrame, unit: str, window: int) -> DataFrame:
    """Windows of segments that start earlier in another: every alignment of `window` units around the seed is matched,
    the earliest of equal ones by an aggregate. Result: d, x, s, e (ranges of starts)."""
    def run(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            out: dict[str, list] = {"d": [], "x": [], "w": [], "v": [], "s": []}
            for d, x, raw, got in zip(*[c.to_pylist() for c in batch.columns]):
                text = Units(unsqueezed(raw), unit)
                starts = np.concatenate([np.arange(g["a"], g["a"] + g["m"]) for g in got])
                one, two = text.keys(starts, starts + window)
                out["d"].append(np.full(len(starts), d))
                out["x"].append(np.full(len(starts), x))
                out["w"].append(one)
                out["v"].append(two)
                out["s"].append(starts.astype(np.int32))
            yield {k: np.concatenate(v) if v else [] for k, v in out.items()}

    each = arrow_pass(held, run, "d bigint, x bigint, w bigint, v bigint, s int", rows=64)
    first = staged(each.groupBy("w", "v").agg(F.min(F.struct("d", "x", "s")).alias("f"), F.count("*").alias("n"))
                   .where("n > 1").select("w", "v", "f"), "earliest")
    return each.join(first, ["w", "v"]).where(F.struct("d", "x", "s") > F.col("f")).select(
        "d", "x", "s", (F.col("s") + 1).alias("e"))


def covered(ranges: list[tuple[int, int]], window: int) -> list[tuple[int, int]]:
    """Units covered by windows whose starts lie in the ranges, as maximal spans."""
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e - 1 + window)
        else:
            out.append([s, e - 1 + window])
    return [(a, b) for a, b in out]


def cut(texts: DataFrame, ranges: DataFrame, unit: str, window: int) -> DataFrame:
    """Documents without the windows in `ranges`: d, x, n_removed, n_spans, kept (sha-256)."""
    def run(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            d, x, raws, got = (c.to_pylist() for c in batch.columns)
            out: dict[str, list] = {"d": d, "x": x, "n_removed": [], "n_spans": [], "kept": []}
            for raw, ranges in zip(raws, got):
                spans = covered([(r["s"], r["e"]) for r in ranges], window)
                out["n_removed"].append(sum(b - a for a, b in spans))
                out["n_spans"].append(len(spans))
                out["kept"].append(hashlib.sha256(Units(unsqueezed(raw), unit).kept(spans)).hexdigest())
            yield out

    mine = ranges.groupBy("d", "x").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    return arrow_pass(texts.select("d", "x", "raw").join(mine, ["d", "x"]).select("d", "x", "raw", "ranges"), run,
                      "d bigint, x bigint, n_removed bigint, n_spans bigint, kept string", rows=64)


def assembled(docs_rows: DataFrame, first: DataFrame, removed: DataFrame, window: int) -> DataFrame:
    """One row per document: doc_id, n, n_removed, n_spans, sha; `removed` holds d, x, n_removed, n_spans, kept."""
    mine = removed.select(F.col("d").alias("_d"), F.col("x").alias("_x"), "n_removed", "n_spans", "kept").dropDuplicates(["_d", "_x"])
    rows = docs_rows.select("d", "x", "n", "sha", "whole").join(first, "whole", "left").join(
        mine, (F.col("d") == F.col("_d")) & (F.col("x") == F.col("_x")), "left")
    copy = (F.col("n") >= window) & ~((F.col("d") == F.col("fd")) & (F.col("x") == F.col("fx")))
    return rows.select(
        F.when(F.col("d") != NO_ID, F.col("d")).alias("doc_id"), "n",
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept", "sha")).alias("sha"))
