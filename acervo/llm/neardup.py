"""Near duplicates by weighted Jaccard similarity: BagMinHash signatures, bands, and an exact check of shingle counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.llm.common import GRAM_P, WORD_P, Rolling, arrow_pass, byte_values, mix, staged, utf8, word_spans
from acervo.llm.links import components

BANDS, ROWS = 30, 5
SLOTS = BANDS * ROWS
_BYTES, _WORDS = Rolling(WORD_P), Rolling(GRAM_P)


def shingles(raw: bytes, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the runs of `size` words (all words, if fewer) and how often each occurs."""
    data, starts, ends = word_spans(raw.lower())
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    words = _BYTES.ranges(_BYTES.sums(byte_values(data)), starts, ends)
    sums = _WORDS.sums(words)
    return np.unique(_WORDS.grams(sums, min(size, len(words))), return_counts=True)


def uniform(seeds: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) fixed by seed and salt."""
    return ((mix(seeds ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """BagMinHash signatures of bags of (hashes, counts), none empty: for each slot the time of its first point.

    Weights are whole numbers, parted into the levels (0,1], (1,2], (2,4], (4,8] ... A Poisson process of the level's
    width runs on each level of each element; its points fall on random slots and, within the level, on random weights,
    and count where the element's weight reaches them. Two signatures agree in a slot with the weighted Jaccard
    similarity as probability. Points are made in order of time up to a bound that fills nearly every bag's slots;
    bags with an empty slot go on to a later bound.
    """
    out = np.full((len(bags), SLOTS), np.inf)
    flat = out.reshape(-1)
    sizes = np.array([len(h) for h, _ in bags])
    elements = np.concatenate([h for h, _ in bags])
    weights = np.concatenate([c for _, c in bags])
    owner = np.repeat(np.arange(len(bags)), sizes)
    total = np.bincount(owner, weights)
    bound = (np.log(SLOTS) + 3) / total
    todo = np.ones(len(bags), bool)
    while todo.any():
        level, low = 0, 0
        while True:
            live = (weights > low) & todo[owner]
            if not live.any():
                break
            width = max(1, low)
            bag, most = owner[live], weights[live]
            seeds = mix(elements[live] + np.uint64(level * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
            times, step = np.zeros(len(bag)), 0
            while len(bag):
                times = times - np.log(uniform(seeds, 3 * step)) / (SLOTS * width)
                soon = times < bound[bag]
                bag, most, seeds, times = bag[soon], most[soon], seeds[soon], times[soon]
                place = bag * SLOTS + (mix(seeds + np.uint64(3 * step + 1)) % np.uint64(SLOTS)).astype(np.int64)
                if width > 1:
                    reached = low + np.floor(uniform(seeds, 3 * step + 2) * width) < most
                    np.minimum.at(flat, place[reached], times[reached])
                else:
                    np.minimum.at(flat, place, times)
                step += 1
            level, low = level + 1, max(1, 2 * low) if low else 1
        todo = np.isinf(out).any(axis=1)
        bound = np.where(todo, bound * 2, bound)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each signature."""
    bits = signature.view(np.uint64).reshape(len(signature), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bits.shape[:2])
    for i in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, i])
    return keys


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags (hashes sorted)."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][left], b[1][right]).sum())
    return both / max(1, int(a[1].sum()) + int(b[1].sum()) - both)


def pack(bag: tuple[np.ndarray, np.ndarray]) -> bytes:
    return bag[0].tobytes() + (bag[1].astype("<u4").tobytes() if len(bag[1]) else b"")


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 12
    return np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, "<u4", n, 8 * n).astype(np.int64)


def elements(bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Each occurrence of a shingle as 32 bits, sorted: sets that meet nearly as the bags do, in a third of the room."""
    hashes, counts = bag
    turn = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort((mix(np.repeat(hashes, counts) + turn.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32))


def text_key(raw: bytes) -> bytes | None:
    """128-bit hash of the folded words; null where there is none."""
    import xxhash
    words = raw.lower().split()
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, x (hash of the text as it is), t (key of its words), sketch (low byte of each slot), bands."""
    def run(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            raws = batch.column(2).to_pylist()
            keys = [text_key(r) if r else None for r in raws]
            rows = [i for i, k in enumerate(keys) if k is not None]
            sketches, bands = [None] * len(raws), [None] * len(raws)
            if rows:
                drawn = signatures([shingles(raws[i]) for i in rows])
                low = (mix(drawn.view(np.uint64)) & np.uint64(255)).astype(np.uint8)
                for i, s, b in zip(rows, low, band_keys(drawn).view(np.int64)):
                    sketches[i], bands[i] = s.tobytes(), b
            yield {"doc_id": batch.column(0).to_pylist(), "x": batch.column(1).to_pylist(), "t": keys,
                   "sketch": sketches, "bands": bands}

    return arrow_pass(docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("x"), utf8().alias("raw")), run,
                      "doc_id bigint, x bigint, t binary, sketch binary, bands array<bigint>", rows=128)


def bags_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingle counts (t, bag, elements) of the texts in `wanted` (d: their first doc_id, t)."""
    def run(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            rows = [(k, shingles(r)) for r in batch.column(0).to_pylist() if (k := text_key(r)) is not None]
            if rows:
                yield {"t": [k for k, _ in rows], "bag": [pack(b) for _, b in rows],
                       "elements": [elements(b).tobytes() for _, b in rows]}

    ids = wanted.select(F.col("d").alias("_d")).distinct()
    some = docs.where("text is not null").select(F.col("doc_id").cast("bigint").alias("d"), utf8().alias("raw")).join(
        ids, F.col("d").eqNullSafe(F.col("_d")), "left_semi")
    found = arrow_pass(some.select("raw"), run, "t binary, bag binary, elements binary", rows=64)
    return found.groupBy("t").agg(F.first("bag").alias("bag"), F.first("elements").alias("elements"))


def verified(pairs: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose similarity is `least` or more, with it."""
    def run(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            a, b, left, right = [c.to_pylist() for c in batch.columns]
            far = [similarity(unpack(x), unpack(y)) for x, y in zip(left, right)]
            hit = [i for i, s in enumerate(far) if s >= least]
            yield {"a": [a[i] for i in hit], "b": [b[i] for i in hit], "similarity": [far[i] for i in hit]}

    left = bags.select(F.col("t").alias("a"), F.col("bag").alias("left"))
    right = bags.select(F.col("t").alias("b"), F.col("bag").alias("right"))
    return arrow_pass(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right"), run,
                      "a binary, b binary, similarity double", rows=64)


def likely_pairs(members: DataFrame, least: float, estimate: float, block: int = 512) -> DataFrame:
    """Pairs of one band's members from different components that may be `least` similar: sketches agree in a share of
    `estimate` slots, and then the sets of elements nearly reach `least`.

    members: band, t, root, sketch, bands, elements. A pair is taken in the first band it shares, so it leaves once. A
    band of many members is cut into blocks of about `block` by a hash; blocks meet pairwise, each meeting in one task.
    """
    counts = members.groupBy(F.col("band").alias("_band")).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    cut = members.join(counts, F.col("band") == F.col("_band")).withColumn("mine", F.pmod(F.xxhash64("t"), F.col("blocks")).cast("int"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
        (F.col("mine") <= F.col("other")).alias("first"), "t", "root", "sketch", "bands", "elements")
    dealt = met.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def pairs_of(rows):
        band, same = rows[0][0], rows[0][1] == rows[0][2]
        names = {r: k for k, r in enumerate({r[5] for r in rows})}
        if len(names) < 2:
            return
        left = rows if same else [r for r in rows if r[3]]
        right = rows if same else [r for r in rows if not r[3]]
        if not left or not right:
            return
        roots = np.array([names[r[5]] for r in right])
        sketches = np.frombuffer(b"".join(r[6] for r in right), np.uint8).reshape(len(right), SLOTS)
        bands = np.array([r[7] for r in right], np.int64)
        held = [np.frombuffer(r[8], np.uint32) for r in right]
        for k, row in enumerate(left):
            start = k + 1 if same else 0
            other = start + np.flatnonzero(roots[start:] != names[row[5]])
            other = other[(sketches[other] == np.frombuffer(row[6], np.uint8)).mean(axis=1) >= estimate]
            own = np.array(row[7], np.int64)
            shared = bands[other] == own
            other = other[own[shared.argmax(axis=1)] == band] if len(other) else other
            if not len(other):
                continue
            mine = np.frombuffer(row[8], np.uint32)
            sizes = np.array([len(held[n]) for n in other])
            flat = np.concatenate([held[n] for n in other])
            at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
            common = np.add.reduceat((mine[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
            for n in other[common >= (least - 0.01) * (sizes + len(mine) - common)].tolist():
                yield (row[4], right[n][4]) if row[4] < right[n][4] else (right[n][4], row[4])

    def run(batches) -> Iterator[dict[str, list]]:
        held = []

        def flush():
            pairs = list(pairs_of(held)) if held else []
            return {"a": [p[0] for p in pairs], "b": [p[1] for p in pairs]}

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and row[:3] != held[0][:3]:
                    yield flush()
                    held = []
                held.append(row)
        yield flush()

    return arrow_pass(dealt, run, "a binary, b binary", rows=256).distinct()


def classes(docs: DataFrame, least: float = 0.8, estimate: float = 0.65) -> DataFrame:
    """Class of every document: doc_id, x, class_id, class_x, the class being a component of pairs of `least` similarity or more.

    Similarity is the weighted Jaccard of five-word shingles with their counts (a text of fewer words is one shingle of
    them all); words are parted by ASCII white space, A-Z folded. class_id is the smallest doc_id of the class (nulls
    last) and class_x that row's text hash; a document without near copies is its own class. Null texts and texts
    without words stand alone, repeated rows and texts of equal words share a class, an empty table gives no row;
    other columns play no part.

    Equal word sequences are one text throughout. Bands meet by an aggregate; each text is checked exactly against its
    band's first text; after the components of these, members of one band that are still apart are compared in blocks, by
    sketch and then by 32-bit elements, and those that may reach `least` are checked exactly. A pair at 0.8 shares no
    band of 30 with a chance of seven in a million, and is missed by the sketch with one of two in a million.
    """
    rows = staged(signed(docs), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("d"), F.col("x").alias("x"))
    texts = staged(rows.where("t is not null").groupBy("t").agg(
        F.min(order).alias("first"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")), "texts")
    bands = texts.select("t", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.min("t").alias("a"), F.max("t").alias("z")).where("a <> z")
    members = staged(bands.join(shared.select("band", "a"), "band"), "members")
    star = members.where("a <> t").select("a", F.col("t").alias("b")).distinct()
    wanted = members.select("t").distinct().join(texts, "t").select("t", F.col("first.d").alias("d"))
    bags = staged(bags_of(docs, wanted).join(wanted.select("t"), "t", "left_semi"), "bags")
    sure = staged(verified(star, bags, least), "verified")
    first = components(sure)
    placed = members.join(first.withColumnRenamed("node", "t"), "t", "left").select(
        "band", "t", F.coalesce("root", "t").alias("root"))
    apart = placed.groupBy("band").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p <> q").select("band")
    open_members = placed.join(apart, "band", "left_semi").join(
        texts.select("t", "sketch", "bands"), "t").join(bags.select("t", "elements"), "t")
    more = verified(likely_pairs(open_members, least, estimate), bags, least)
    links = sure.select("a", "b").union(more.select("a", "b"))
    roots = components(links).withColumnRenamed("node", "t")
    rooted = texts.join(roots, "t", "left").select("t", "first", F.coalesce("root", "t").alias("root"))
    heads = rooted.groupBy("root").agg(F.min("first").alias("head"))
    named = rooted.join(heads, "root").select(F.col("t").alias("_t"), "head")
    return rows.select("doc_id", "x", "t").join(named, F.col("t") == F.col("_t"), "left").select(
        "doc_id", "x", F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.d")).alias("class_id"),
        F.coalesce("head.x", "x").alias("class_x"))


def deduplicated(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """One document of each class: the row with the smallest doc_id (of rows that repeat, one), all columns as they are."""
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    # the whole row in one column: none of its names can meet a helper's
    mine = docs.select(F.struct(*columns).alias("_row"), F.col("doc_id").cast("bigint").alias("_id"), F.xxhash64("text").alias("_h"))
    found = classes(docs.select("doc_id", "text"), least)
    heads = staged(found.where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("x") == F.col("class_x"))).groupBy(
        F.col("doc_id").alias("_d"), F.col("x").alias("_x")).agg(F.count("*").alias("_n")), "heads")
    kept = mine.join(heads, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_x")))
    # only rows that repeat are compared with each other; the texts of all others move once
    again = kept.where("_n > 1").dropDuplicates(["_id", "_h"])
    return kept.where("_n = 1").union(again).select(*[F.col("_row.`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns])
