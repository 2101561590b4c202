"""Byte-level BPE: merges by rank from a priority queue over a linked list of symbols, and decoding by concatenation."""

from __future__ import annotations

import hashlib
import json
import sys
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.llm.common import arrow_pass, worker_store

# The split of the published byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, as letter -> byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Codec:
    """One vocabulary file, loaded where it is used."""

    def __init__(self, path: str, words: int = 200_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocabulary.values(), *self.special.values()])
        self.strings = [b""] * size
        for token, at in vocabulary.items():
            self.strings[at] = bytes(letters[c] for c in token)
        for token, at in self.special.items():
            self.strings[at] = token.encode()
        self.single = [0] * 256
        for letter, byte in letters.items():
            self.single[byte] = vocabulary[letter]
        # pair (left << 20 | right) -> rank << 32; what each rank makes
        self.ranks: dict[int, int] = {}
        self.made = []
        for pair in spec["model"]["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocabulary[left] << 20 | vocabulary[right]] = len(self.made) << 32
            self.made.append(vocabulary[left + right])
        self.pieces = regex.compile(SPLIT).findall
        marks = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.marks = regex.compile(f"({marks})") if marks else None
        self.crowded = regex.compile(r"\s |^ | \s| $").search
        self.bound = words
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the lowest rank first, the leftmost of equal ranks first."""
        symbols = list(map(self.single.__getitem__, piece))
        n = len(symbols)
        if n < 2:
            return symbols
        rank = self.ranks.get
        # at each place the rank of the pair that starts there, moved up so that one integer orders the queue: rank, then place
        pairs = [rank(a << 20 | b, -1) for a, b in zip(symbols, symbols[1:])]
        queue = [found | i for i, found in enumerate(pairs) if found >= 0]
        if not queue:
            return symbols
        heapify(queue)
        pairs.append(-1)
        made = self.made
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while queue:
            entry = heappop(queue)
            i = entry & 0xFFFFFFFF
            found = entry ^ i
            # stale: one of the two symbols has been merged since
            if pairs[i] != found:
                continue
            j = after[i]
            symbols[i] = merged = made[found >> 32]
            symbols[j] = pairs[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pairs[i] = found = rank(merged << 20 | symbols[k], -1)
                if found >= 0:
                    heappush(queue, found | i)
            else:
                pairs[i] = -1
            k = before[i]
            if k >= 0:
                pairs[k] = found = rank(symbols[k] << 20 | merged, -1)
                if found >= 0:
                    heappush(queue, found | k)
        return [s for s in symbols if s >= 0]

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a run that no blank crosses, piece by piece."""
        pieces = self.pieces(chunk)
        if len(pieces) == 1:
            return self._remembered(chunk)
        known = self.recent.get
        return b"".join([known(p) or self._remembered(p) for p in pieces])

    def _remembered(self, piece: str) -> bytes:
        """Ids of a piece, looked up among those of a generation before, else merged; pieces of up to 64 letters are kept."""
        out = self.older.get(piece) or packed(self.merge(piece.encode()))
        if len(piece) <= 64:
            if len(self.recent) >= self.bound:
                self.recent, self.older = {}, self.recent
            self.recent[piece] = out
        return out

    def _plain(self, text: str, out: list[bytes]) -> None:
        if self.crowded(text):
            chunks = self.pieces(text)
        else:  # a single blank always starts a piece
            first, *rest = text.split(" ")
            chunks = [first] if first else []
            chunks += [" " + part for part in rest]
        chunk = self._chunk
        for at in range(0, len(chunks), 4096):  # a full cache is swapped between these
            known = self.recent.get
            out.extend([known(c) or chunk(c) for c in chunks[at:at + 4096]])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special strings in the text become their ids."""
        out: list[bytes] = []
        if self.marks is None or not any(s in text for s in self.special):
            self._plain(text, out)
        else:
            for part in self.marks.split(text):
                if part in self.special:
                    out.append(packed([self.special[part]]))
                elif part:
                    self._plain(part, out)
        return b"".join(out)

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        """The vocabulary's strings one after the other; bytes that are no UTF-8 are for the reader to replace."""
        return b"".join(map(self.strings.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def encoded(docs: DataFrame, vocabulary: str, column: str = "text", keep: tuple[str, ...] = ("doc_id",),
            ids: bool = False) -> DataFrame:
    """Encode every whole text and decode it again.

    Columns: those of `keep`, n_tokens, ids_sha256, decoded_sha256, and with `ids` also token_ids (the ids as
    little-endian unsigned 32-bit integers).
    A null text is encoded as the empty text. Rows that repeat give rows that repeat; a table without rows gives none.
    Columns of the input that are not in `keep` play no part, whatever their names. A very long run without a split
    costs n log n. `vocabulary` is the path of the file on every executor.
    """
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    types = dict(docs.dtypes)
    schema = ", ".join([f"_k{i} {types[c]}" for i, c in enumerate(keep)]
                       + ["n_tokens bigint, ids_sha256 string, decoded_sha256 string"]
                       + (["token_ids binary"] if ids else []))

    def run(batches) -> Iterator[dict[str, list]]:
        codec = None
        for batch in batches:
            codec = codec or worker_store("bpe", vocabulary, lambda: Codec(vocabulary))
            out: dict[str, list] = {f"_k{i}": batch.column(i).to_pylist() for i in range(len(keep))}
            rows = []
            for text in batch.column(len(keep)).to_pylist():
                raw = codec.encode(text or "")
                back = codec.decode_bytes(np.frombuffer(raw, "<u4").tolist())
                if not back.isascii():
                    back = back.decode("utf-8", "replace").encode()
                row = (len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(back).hexdigest())
                rows.append((*row, raw) if ids else row)
            names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["token_ids"] if ids else [])]
            out |= {n: [r[i] for r in rows] for i, n in enumerate(names)}
            yield out

    found = arrow_pass(docs.select(*kept, F.col(column).cast("string").alias("_text")), run, schema)
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
                        *[c for c in found.columns if not c.startswith("_k")])


def decoded(tokens: DataFrame, vocabulary: str, column: str = "token_ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Texts of packed token ids: the columns of `keep` and text. Null ids give a null text; an id beyond the vocabulary
    is an error."""
    types = dict(tokens.dtypes)
    schema = ", ".join([f"_k{i} {types[c]}" for i, c in enumerate(keep)] + ["text string"])

    def run(batches) -> Iterator[dict[str, list]]:
        codec = None
        for batch in batches:
            codec = codec or worker_store("bpe", vocabulary, lambda: Codec(vocabulary))
            yield {f"_k{i}": batch.column(i).to_pylist() for i in range(len(keep))} | {"text": [
                None if raw is None else codec.decode(np.frombuffer(raw, "<u4").tolist())
                for raw in batch.column(len(keep)).to_pylist()]}

    found = arrow_pass(tokens.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], column), run, schema)
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "text")


def vocabulary_path(spark: SparkSession) -> str:
    """The published vocabulary file: the session's setting, else the installed package's."""
    chosen = spark.conf.get("spark.acervo.vocabulary", None)
    if chosen:
        return chosen
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
