"""Similarity measures: cosine as a column, text ratios as small Python helpers."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where either vector has no length."""
    length = norm(a) * norm(b)
    return F.when(length == 0, 0.0).otherwise(dot(a, b) / length)


def unit_rows(vectors) -> np.ndarray:
    """Matrix of unit rows; a zero vector stays zero, so its cosine is 0."""
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


LETTERS = 37
_PLACES = np.full(128, LETTERS, np.int64)
_PLACES[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz0123456789 "]] = np.arange(LETTERS)
WORD_BITS = 63  # the top bit of a word holds what it carries to the next
_LOW = np.uint64((1 << WORD_BITS) - 1)
LONG_TITLE = 200  # from here on SequenceMatcher leaves frequent characters out


def letter_places(title: str) -> np.ndarray:
    """Each character of a title key (letters, digits, blanks) as a number below `LETTERS`."""
    return _PLACES[np.frombuffer(title.encode("ascii"), np.uint8)]


class TitleBank:
    """Numbered titles of like length as arrays, and a bound on the characters that another title matches in each.

    The characters that SequenceMatcher matches are a common subsequence, so the
    longest one bounds them. It is found bit-parallel, against all titles at once:
    `words` integers tell where in a title each letter stands. Long titles (`words`
    0) are bounded by how often each letter occurs in both.
    """

    def __init__(self, words: int):
        self.words, self.size = words, 0
        self.numbers, self.lengths = np.zeros(64, np.int64), np.zeros(64, np.int64)
        self.letters = np.zeros((max(words, 1), LETTERS, 64), np.uint64)

    def add(self, number: int, title: str) -> None:
        n, places = self.size, letter_places(title)
        if n == len(self.lengths):
            self.numbers, self.lengths, self.letters = (
                np.concatenate([x, np.zeros_like(x)], axis=-1) for x in (self.numbers, self.lengths, self.letters))
        self.numbers[n], self.lengths[n], self.size = number, len(title), n + 1
        if self.words:
            word, bit = np.divmod(np.arange(len(title)), WORD_BITS)
            np.bitwise_or.at(self.letters[:, :, n], (word, places), np.uint64(1) << bit.astype(np.uint64))
        else:
            self.letters[0, :, n] = np.bincount(places, minlength=LETTERS)

    def _common(self, places: np.ndarray) -> np.ndarray:
        n = self.size
        if not self.words:
            return np.minimum(self.letters[0, :, :n], np.bincount(places, minlength=LETTERS).astype(np.uint64)[:, None]).sum(axis=0).astype(np.int64)
        rows = [np.full(n, _LOW if word < self.words - 1 else ~np.uint64(0)) for word in range(self.words)]
        hit, total, carry = np.empty(n, np.uint64), np.empty(n, np.uint64), np.zeros(n, np.uint64)
        for place in places.tolist():
            for word, row in enumerate(rows):
                np.bitwise_and(row, self.letters[word, place, :n], out=hit)
                np.add(row, hit, out=total)
                if word:
                    total += carry
                row ^= hit
                row |= total
                if word < self.words - 1:
                    np.right_shift(total, np.uint64(WORD_BITS), out=carry)
                    row &= _LOW
        return sum(np.bitwise_count(~row & _LOW).astype(np.int64) for row in rows)

    def near(self, title: str, threshold: float) -> np.ndarray:
        """Numbers of the titles whose ratio may reach the threshold."""
        lengths = self.lengths[:self.size]
        least = threshold * (lengths + len(title)) - 1e-9
        if not (2 * np.minimum(lengths, len(title)) >= least).any():
            return np.empty(0, np.int64)
        return self.numbers[:self.size][2 * self._common(letter_places(title)) >= least]


class TitleMatcher:
    """Compares titles with one title; true exactly where `SequenceMatcher(None, other, title).ratio()` reaches the threshold.

    The table of equal characters is one integer, a row of bits for each character
    of the other title. Its bits that go on along the diagonal, step by step, are
    the ends of ever longer common runs; the lowest bit left ends the run that
    SequenceMatcher takes first. What lies before and after it is searched in turn,
    as long as the threshold can be reached.
    """

    def __init__(self, title: str):
        self.size, self.width = len(title), len(title) // 8 + 1  # bytes of a row: one bit at least stays free
        self.matcher = SequenceMatcher(None, "", title) if len(title) >= LONG_TITLE else None
        found: dict[str, int] = {}
        for i, ch in enumerate(title):
            found[ch] = found.get(ch, 0) | (1 << i)
        self.rows = {ch: bits.to_bytes(self.width, "little") for ch, bits in found.items()}

    def fits(self, other: str, threshold: float) -> bool:
        if self.matcher:
            self.matcher.set_seq1(other)
            return self.matcher.ratio() >= threshold
        total = len(other) + self.size
        if not total:
            return 1.0 >= threshold
        bits, none = 8 * self.width, bytes(self.width)
        table = int.from_bytes(b"".join([self.rows.get(ch, none) for ch in other]), "little")
        most = min(len(other), self.size)  # matched so far, and what the open parts can add
        parts = [(0, len(other), 0, self.size)]
        while parts and 2.0 * most / total >= threshold:
            a, a_end, b, b_end = parts.pop()
            most -= min(a_end - a, b_end - b)
            columns = ((1 << b_end) - (1 << b)).to_bytes(self.width, "little")
            run, size = (table >> bits * a) & int.from_bytes(columns * (a_end - a), "little"), 1
            if not run:
                continue
            while longer := run & (run << bits + 1):
                run, size = longer, size + 1
            row, column = divmod((run & -run).bit_length() - 1, bits)
            i, j = a + row + 1 - size, column + 1 - size
            most += size
            for part in ((a, i, b, j), (i + size, a_end, j + size, b_end)):
                if room := min(part[1] - part[0], part[3] - part[2]):
                    most += room
                    parts.append(part)
        return 2.0 * most / total >= threshold


def _common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    if not a or not b:
        return 0
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    row = full = (1 << len(a)) - 1
    for ch in b:
        hits = row & masks.get(ch, 0)
        row = ((row + hits) | (row - hits)) & full
    return len(a) - bin(row).count("1")


def name_tokens(name: str) -> tuple[frozenset[str], int]:
    """Distinct tokens and the length of the distinct tokens joined by blanks."""
    tokens = frozenset(name.split())
    return tokens, sum(map(len, tokens)) + max(0, len(tokens) - 1)


def tokens_ratio(a: tuple[frozenset[str], int], b: tuple[frozenset[str], int], at_least: float = 0.0) -> float:
    """0..100: shared tokens against shared plus remaining tokens, best of three.

    Two names where one holds all tokens of the other score 100. A pair that
    cannot reach `at_least` may get 0 without being compared.
    """
    (left, len_left), (right, len_right) = a, b
    if not left or not right:
        return 0.0
    common = left & right
    if not common and 200.0 * min(len_left, len_right) < at_least * (len_left + len_right):
        return 0.0
    shared = " ".join(sorted(common))
    rest_a, rest_b = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    if shared and (not rest_a or not rest_b):
        return 100.0

    def score(distance: int, total: int) -> float:
        return 100.0 - 100.0 * distance / total if total else 100.0

    gap = 1 if shared else 0
    len_a, len_b = len(shared) + gap + len(rest_a), len(shared) + gap + len(rest_b)
    distance = len(rest_a) + len(rest_b) - 2 * _common_subsequence(rest_a, rest_b)
    best = score(distance, len_a + len_b)
    if shared:
        best = max(best, score(gap + len(rest_a), len(shared) + len_a), score(gap + len(rest_b), len(shared) + len_b))
    return best


def token_set_ratio(a: str, b: str) -> float:
    return tokens_ratio(name_tokens(a), name_tokens(b))


def _numbered_grams(names: list[frozenset[str]], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, number): all grams of `size` letters (three at most) inside the tokens, by row; equal grams of a row are numbered."""
    joined = [" ".join(tokens) for tokens in names]
    letters = np.frombuffer("".join(f"{text} " for text in joined).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    n = max(0, len(letters) - size + 1)
    grams, inside = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(size):
        grams = grams << 21 | letters[i:i + n]
        inside &= letters[i:i + n] != 32
    rows = np.repeat(np.arange(len(joined)), [len(text) + 1 for text in joined])[:n][inside]
    grams = grams[inside]
    order = np.lexsort((grams, rows))
    rows, grams = rows[order], grams[order]
    at = np.arange(len(rows))
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    return rows, grams, at - np.maximum.accumulate(np.where(first, at, 0))


class GramIndex:
    """Names of a dictionary by their grams of letters, and those of them that may reach a ratio with other names.

    Two names that reach the threshold differ by at most (1 - threshold) of both lengths. What they have in common falls
    into at most one piece more than there are differences, so a least number of grams is common to both, but for those
    that a blank may cut. All common grams are counted, equal ones as often as both have them, and a name with fewer
    cannot reach the threshold (two thirds or more). A name is sought by the longest grams of which one is sure to be
    common: three letters, two, or single ones. Lengths are bounded by the threshold as well.
    """

    def __init__(self, names: list[str], threshold: float):
        self.threshold, self.nearest = threshold, threshold / (2 - threshold)
        known = sorted(((*name_tokens(name), name) for name in names), key=lambda x: x[1])
        self.tokens, self.names = [(tokens, length) for tokens, length, _ in known], [name for *_, name in known]
        self.lengths = np.array([length for _, length in self.tokens], np.int64)
        self.blanks = np.array([max(0, len(tokens) - 1) for tokens, _ in self.tokens], np.int64)
        self.postings: dict[int, tuple] = {}

    def _posted(self, size: int) -> tuple:
        """The different grams, the most of one kind in a name, the numbered grams as integers, their first places, and the names by them."""
        if size not in self.postings:
            rows, grams, numbers = _numbered_grams([tokens for tokens, _ in self.tokens], size)
            different, kind = np.unique(grams, return_inverse=True)
            most = int(numbers.max(initial=0)) + 1
            slots = kind * most + numbers
            order = np.argsort(slots, kind="stable")
            found, first = np.unique(slots[order], return_index=True)
            self.postings[size] = different, most, found, np.append(first, len(rows)), rows[order]
        return self.postings[size]

    def _kept(self, size: int, both: np.ndarray | float, blanks: np.ndarray | int) -> np.ndarray | float:
        """Grams that names of `both` lengths have in common at least."""
        return max(0.0, 0.5 - (size - 0.5) * (1 - self.threshold)) * both - (size - 1) - size * blanks - 1e-6

    def near(self, names: list[str]):
        """Place in `names` and places in the dictionary that may reach the threshold, for each name with any."""
        parted = [name_tokens(name) for name in names]
        size = [next((s for s in (3, 2) if self._kept(s, length * (1 + self.nearest), max(0, len(tokens) - 1)) > 0), 1) for tokens, length in parted]
        for s in sorted(set(size)):
            places = [i for i, own in enumerate(size) if own == s and parted[i][0]]
            different, most, found, first, by_gram = self._posted(s)
            if not places or not len(found):
                continue
            rows, grams, numbers = _numbered_grams([parted[i][0] for i in places], s)
            kind = np.minimum(np.searchsorted(different, grams), len(different) - 1)
            slots = kind * most + numbers
            slot = np.minimum(np.searchsorted(found, slots), len(found) - 1)
            held = (different[kind] == grams) & (numbers < most) & (found[slot] == slots)
            rows, starts, ends = rows[held], first[slot[held]].tolist(), first[slot[held] + 1].tolist()
            cuts = np.searchsorted(rows, np.arange(len(places) + 1)).tolist()
            for n, i in enumerate(places):
                length, blanks = parted[i][1], len(parted[i][0]) - 1
                low, high = np.searchsorted(self.lengths, [length * self.nearest - 1e-6, length / self.nearest + 1e-6]).tolist()
                if low >= high or cuts[n] == cuts[n + 1]:
                    continue
                hits = np.concatenate([by_gram[a:b] for a, b in zip(starts[cuts[n]:cuts[n + 1]], ends[cuts[n]:cuts[n + 1]])])
                counts = np.bincount(hits, minlength=len(self.names))[low:high]
                some = np.flatnonzero(counts >= max(1.0, self._kept(s, length + int(self.lengths[low]), blanks)))
                kept = self._kept(s, length + self.lengths[low + some], np.minimum(blanks, self.blanks[low + some]))
                some = some[counts[some] >= kept]
                if len(some):
                    yield i, low + some

    def scored(self, names: list[str]):
        """(name, name of the dictionary, 0..100) of the pairs that reach the threshold."""
        floor = 100 * self.threshold
        for i, places in self.near(names):
            own = name_tokens(names[i])
            for place in places.tolist():
                score = tokens_ratio(own, self.tokens[place], floor)
                if score >= floor:
                    yield names[i], self.names[place], score
