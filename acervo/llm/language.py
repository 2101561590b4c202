"""Language identification by unigrams over a fixed vocabulary of pieces, summed over all segmentations of each word."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.llm.common import GRAM_P, Rolling, arrow_pass, mix, staged, worker_store

WORDS = re.compile(r"[^\W\d_]+")
START = "▁"
FLOOR = 1e-9
#: Sums below LOW are raised by LIFT, and the logarithm of the lift is kept beside them.
LOW, LIFT = 1e-100, 1e100
#: Letters times words of one array of sums.
CELLS = 400_000
MOST_LANGUAGES = 1000


def words_of(text: str | None) -> list[str]:
    """Runs of letters, folded to lower case."""
    return WORDS.findall(text.lower()) if text else []


def portions(words: list[str]) -> Iterator[list[str]]:
    """Words by falling length, in lists whose array of sums is bounded; a very long word is a list of its own."""
    words = sorted(words, key=len, reverse=True)
    at = 0
    while at < len(words):
        n = max(1, min(8192, CELLS // (len(words[at]) + 2)))
        yield words[at:at + n]
        at += n


def pieces_of(path: str) -> list[str]:
    """The vocabulary's pieces that can occur in a folded word, in the file's order."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kept = {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        body = piece[1:] if piece.startswith(START) else piece
        if (body == "" and piece == START) or (WORDS.fullmatch(body) and body == body.lower()):
            kept[piece] = None
    return list(kept)


class Pieces:
    """Finds pieces at every place of many words at once."""

    def __init__(self, pieces: list[str]):
        self.n = len(pieces)
        self.rolling = Rolling(GRAM_P)
        self.longest = max(map(len, pieces), default=1)
        flat, starts, lengths = self._flat(pieces)
        hashes = self.rolling.ranges(self.rolling.sums(mix(flat)), starts, starts + lengths)
        order = np.argsort(hashes)
        self.hashes, self.piece = hashes[order], order
        self.bits = np.uint64(64 - 18)
        bucket = (self.hashes >> self.bits).astype(np.int64)
        self.first = np.searchsorted(bucket, np.arange((1 << 18) + 1))
        self.most = int(np.diff(self.first).max(initial=0))

    @staticmethod
    def _flat(words: list[str]):
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
        return flat, np.cumsum(lengths) - lengths, lengths

    def find(self, hashes: np.ndarray) -> np.ndarray:
        at = self.first[(hashes >> self.bits).astype(np.int64)]
        out = np.full(len(hashes), self.n, np.int64)
        for _ in range(self.most):
            inside = np.minimum(at, self.n - 1)
            hit = self.hashes[inside] == hashes
            out[hit] = self.piece[inside[hit]]
            at = at + 1
        return out

    def lattice(self, words: list[str]):
        """Words by falling length: their starts and lengths, and per piece length the piece that begins at each place."""
        marked = sorted((START + w for w in words), key=len, reverse=True)
        flat, starts, lengths = self._flat(marked)
        sums = self.rolling.sums(mix(flat))
        found = {}
        for size in range(1, min(self.longest, int(lengths.max(initial=0))) + 1):
            at = np.arange(len(flat) - size + 1)
            found[size] = self.find(self.rolling.ranges(sums, at, at + size))
        return [w[1:] for w in marked], starts, lengths, found


def _lifted(sums: np.ndarray, logs: np.ndarray, lift: np.ndarray, live: int, at: int, window: slice) -> None:
    """Raise the sums of the words and languages that run low at a place, with all places that are still added up from."""
    low = sums[:live, at] < LOW
    if low.any():
        rows, langs = np.nonzero(low & (sums[:live, at] > 0))
        sums[rows, window, langs] *= LIFT
        logs[rows, window, langs] -= np.log(LIFT)
        lift[rows, langs] -= np.log(LIFT)


def forward(starts, lengths, found, table: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all segmentations of each prefix, (words, places, languages), and the logarithms they are to be raised by."""
    most = int(lengths.max(initial=0))
    longest = max(found, default=1)
    alpha = np.zeros((len(starts), most + 1, table.shape[1]))
    logs, lift = np.zeros_like(alpha), np.zeros((len(starts), table.shape[1]))
    alpha[:, 0] = 1
    for i in range(1, most + 1):
        live = int(np.searchsorted(-lengths, -i, side="right"))
        for size in range(1, min(i, longest) + 1):
            piece = found[size][starts[:live] + i - size]
            use = single if size == 1 else table
            hit = np.flatnonzero(piece < len(table) - 1) if size > 1 else slice(0, live)
            alpha[hit, i] += alpha[hit, i - size] * use[piece[hit]]
        logs[:live, i] = lift[:live]
        _lifted(alpha, logs, lift, live, i, slice(max(0, i - longest + 1), i + 1))
    return alpha, logs


def expected(starts, lengths, found, counts: np.ndarray, table: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words (one language)."""
    alpha, up = forward(starts, lengths, found, table, single)
    most, longest = alpha.shape[1] - 1, max(found, default=1)
    beta, down, lift = np.zeros_like(alpha), np.zeros_like(alpha), np.zeros((len(starts), 1))
    rows = np.arange(len(starts))
    beta[rows, lengths] = 1
    whole, total = alpha[rows, lengths, 0], up[rows, lengths, 0]
    uses = np.zeros(len(table))
    for i in range(most, 0, -1):
        live = int(np.searchsorted(-lengths, -i, side="right"))
        down[:live, i] = lift[:live]
        _lifted(beta, down, lift, live, i, slice(max(0, i - longest), i + 1))
        for size in range(1, min(i, longest) + 1):
            piece = found[size][starts[:live] + i - size]
            step = (single if size == 1 else table)[piece, 0] * beta[:live, i, 0]
            beta[:live, i - size, 0] += step
            share = np.exp(up[:live, i - size, 0] + down[:live, i, 0] - total[:live])
            uses += np.bincount(piece, alpha[:live, i - size, 0] * step * counts[:live] / whole[:live] * share, minlength=len(table))
    return uses


class Model:
    """Languages and, for each piece (and none), its probability in each language."""

    def __init__(self, pieces: list[str], languages: list[str], table: np.ndarray, name: str | None = None):
        self.pieces, self.languages, self.table = pieces, languages, table
        self.name = name or uuid.uuid4().hex

    def single(self) -> np.ndarray:
        """Like the table; a letter without a piece counts alike in every language."""
        out = self.table.copy()
        out[-1] = FLOOR
        return np.maximum(out, FLOOR)


class Scorer:
    """Word scores of one model, kept for the words met lately."""

    def __init__(self, model: Model, letters: int = 2_000_000):
        self.model, self.bound, self.letters = model, letters, 0
        self.find = Pieces(model.pieces)
        self.single = model.single()
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.rows]
        if self.letters + sum(map(len, new)) > self.bound:
            self.rows, self.scores, self.letters, new = {}, self.scores[:0], 0, list(words)
        self.letters += sum(map(len, new))
        tables = [self.scores]
        for portion in portions(new):
            part, starts, lengths, found = self.find.lattice(portion)
            alpha, logs = forward(starts, lengths, found, self.model.table, self.single)
            for w in part:
                self.rows[w] = len(self.rows)
            rows = np.arange(len(part))
            tables.append(np.log(alpha[rows, lengths]) + logs[rows, lengths])
        self.scores = np.concatenate(tables)

    def __call__(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        parts = [words_of(t) for t in texts]
        self.learn(set().union(*parts))
        labels, scores = [], []
        get = self.rows.__getitem__
        for words in parts:
            if not words or not self.model.languages:
                labels.append("und")
                scores.append(0.0)
                continue
            total = self.scores[np.fromiter(map(get, words), np.int64, len(words))].sum(axis=0)
            share = np.exp(total - total.max())
            share /= share.sum()
            best = int(share.argmax())
            labels.append(self.model.languages[best])
            scores.append(float(share[best]))
        return labels, scores


def fit(docs: DataFrame, vocabulary: str, rows_per_language: int = 400, rounds: int = 4, seed: int = 3) -> Model:
    """Piece probabilities of each language in `lang`, by expectation maximisation over all segmentations.

    `docs` holds the labelled rows (doc_id, text, lang). The fit reads a bounded sample: about `rows_per_language` rows
    of each language, chosen by a hash of id and text, however many there are. Rows without text or language teach
    nothing; without any, the model knows no language.
    """
    named = docs.where("lang is not null and text is not null").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    counts = {r.lang: r.n for r in named.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(counts)
    pieces = pieces_of(vocabulary)
    if not languages:
        return Model(pieces, [], np.zeros((len(pieces) + 1, 0)))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, rows_per_language / counts[lang]))])
    sample = named.where(F.col("h") / F.lit(2.0 ** 64) + 0.5 <= F.element_at(share, F.col("lang")))

    def count(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            seen: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.update((lang, w) for w in words_of(text))
            if seen:
                yield {"lang": [k[0] for k in seen], "word": [k[1] for k in seen], "n": list(seen.values())}

    words = staged(arrow_pass(sample.select("lang", "text"), count, "lang string, word string, n bigint")
                   .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    table = np.full((len(pieces) + 1, len(languages)), 1.0 / len(pieces))
    table[-1] = 0
    for _ in range(rounds):
        model = Model(pieces, languages, table)

        def uses(batches) -> Iterator[dict[str, list]]:
            find, single = Pieces(model.pieces), model.single()
            total = np.zeros_like(model.table)
            for batch in batches:
                by: dict[str, dict[str, int]] = {}
                for lang, word, n in zip(*[c.to_pylist() for c in batch.columns]):
                    by.setdefault(lang, {})[word] = n
                for lang, seen in by.items():
                    k = model.languages.index(lang)
                    for portion in portions(list(seen)):
                        marked, starts, lengths, found = find.lattice(portion)
                        total[:, k] += expected(starts, lengths, found, np.array([seen[w] for w in marked], float),
                                                model.table[:, [k]], single[:, [k]])
            piece, lang = np.nonzero(total)
            yield {"piece": piece, "lang": lang, "n": total[piece, lang]}

        # at most one row per piece and language reaches the driver
        got = arrow_pass(words, uses, "piece int, lang int, n double", rows=8192).groupBy("piece", "lang").agg(
            F.sum("n").alias("n")).collect()
        table = np.full((len(pieces) + 1, len(languages)), 0.01)
        for r in got:
            if r.piece < len(pieces):
                table[r.piece, r.lang] += r.n
        table[-1] = 0
        table /= table.sum(axis=0)
    return Model(pieces, languages, table)


def identified(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Language of every whole text: the columns of `keep`, lang_pred and score (the language's share, all being equally
    likely beforehand). `und` with score 0 where the text is null or has no letter, or the model knows no language.

    Only the text is read; other columns play no part. Repeated rows repeat; an empty table gives none.
    """
    # plain values: a broadcast class would have to be imported by the workers
    sent = docs.sparkSession.sparkContext.broadcast((model.pieces, model.languages, model.table, model.name))
    types = dict(docs.dtypes)
    schema = ", ".join([f"_k{i} {types[c]}" for i, c in enumerate(keep)] + ["lang_pred string, score double"])

    def run(batches) -> Iterator[dict[str, list]]:
        scorer = None
        for batch in batches:
            if scorer is None:
                known = Model(*sent.value)
                scorer = worker_store("language", known.name, lambda: Scorer(known))
            labels, scores = scorer(batch.column(len(keep)).to_pylist())
            yield {f"_k{i}": batch.column(i).to_pylist() for i in range(len(keep))} | {"lang_pred": labels, "score": scores}

    found = arrow_pass(docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                                   F.col("text").cast("string").alias("_text")), run, schema)
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def vocabulary_path(spark: SparkSession) -> str:
    chosen = spark.conf.get("spark.acervo.pieces", None)
    if chosen:
        return chosen
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def remainder():
    """Remainder that parts learning rows from held-out ones."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
