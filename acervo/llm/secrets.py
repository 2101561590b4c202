"""Secret scan: candidates by shape, judged by a random forest trained from labelled findings."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from math import log2

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.llm.common import arrow_pass, utf8

KEYWORDS = ["token", "secret", "passw", "api_key", "apikey", "api-key", "access_key", "auth", "credential", "private"]
DECOYS = ["example", "test", "dummy", "sample", "placeholder", "changeme", "your", "xxxx", "fake", "todo"]
CHECKSUMS = ["commit", "sha1", "sha256", "md5", "checksum", "digest", "etag", "revision", "integrity", "uuid", "base64"]
SHAPE = set((string.ascii_letters + string.digits + "+/=_-").encode())
BLANKED = bytes(b if b in SHAPE else 32 for b in range(256))
LONG = re.compile(rb"[A-Za-z0-9+/=_\-]{16,}")
ASSIGNED = re.compile(rb"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key|access_key|auth|credential|private)[\w-]{0,16}[\"'`]?"
                      rb"[ \t]{0,3}[:=]{1,2}>?[ \t]{0,3}(?:\"([^\s\"]{8,})|'([^\s']{8,})|`([^\s`]{8,})|([^\s\"'`]{8,}))")
#: values known by their own form: private key blocks, signed tokens in three parts, passwords in addresses
FORMED = re.compile(rb"-----BEGIN[A-Z ]* PRIVATE KEY-----(?:(?!-----BEGIN)[\s\S])*?-----END[A-Z ]* PRIVATE KEY-----"
                    rb"|(?<![\w-])eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]*|(?<=://)[^\s:/@\"']{0,64}:([^\s/@\"']{6,})(?=@)")
SPELT = [k.encode() for k in KEYWORDS]
FEATURES = ["length", "entropy", "letter_digit", "case_change", "coverage", "digits", "hex", "symbols", "keyword_before",
            "assigned", "quoted", "decoy_value", "decoy_near", "checksum_near", "address_near", "path_test", "path_code", "issued"]
#: a short name of letters, perhaps a version or kind, and one long run
ISSUED = re.compile(r"[A-Za-z]{2,8}[_-](?:[A-Za-z0-9]{1,5}[_-])?[A-Za-z0-9]{16,}")


def ordinary(token: bytes) -> bool:
    """A plain word: letters alone, in one case or capitalised."""
    return token.isalpha() and (token.islower() or token.isupper() or token.istitle())


def spans(raw: bytes) -> list[tuple[int, int]]:
    """Candidate byte ranges in order, not overlapping: long runs that are no plain word, and values given to a credential.

    A value runs to its closing quote or to a blank, however long it is; its name may be quoted. A run that holds such a
    value ends at the value's name and goes on after the value, so that a candidate starts where the value does. Private
    key blocks, signed tokens and passwords in addresses are candidates as a whole; of two that overlap the longer stays.
    """
    low = raw.lower()
    found = [(m.start(), *m.span(m.lastindex)) for m in ASSIGNED.finditer(raw)] if any(k in low for k in SPELT) else []
    if b"PRIVATE KEY" in raw or b"eyJ" in raw or b"://" in raw:
        found += [(m.start(m.lastindex or 0), *m.span(m.lastindex or 0)) for m in FORMED.finditer(raw)]
    given: list[tuple[int, int, int]] = []
    for name, a, b in sorted(found, key=lambda f: f[1:]):
        if given and a < given[-1][2]:
            if b - a <= given[-1][2] - given[-1][1]:
                continue
            given.pop()
        given.append((name, a, b))
    out = [(a, b) for _, a, b in given]
    if any(len(t) >= 16 and not ordinary(t) for t in raw.translate(BLANKED).split()):
        i = 0
        for m in LONG.finditer(raw):
            start, end = m.span()
            parts = []
            while i < len(given) and given[i][1] < end:
                name, a, b = given[i]
                if b > start:
                    parts.append((start, name))
                    start = b
                if b > end:
                    break
                i += 1
            for a, b in [*parts, (start, end)]:
                while a < b and raw[a] in b"=-_/+":
                    a += 1
                if b - a >= 16 and not ordinary(raw[a:b]):
                    out.append((a, b))
    return sorted(out)


def entropy(value: str) -> float:
    counts = np.unique(list(value), return_counts=True)[1] / len(value)
    return float(-(counts * np.log2(counts)).sum())


def coverage(value: str, dictionary: frozenset[str]) -> float:
    """Share of the letters and digits that dictionary words of four letters and more cover, longest first."""
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        size = next((n for n in range(min(16, len(low) - at), 3, -1) if low[at:at + n] in dictionary), 0)
        covered += size
        at += size or 1
    return covered / max(1, sum(c.isalnum() for c in low))


def features(raw: bytes, a: int, b: int, path: str, dictionary: frozenset[str]) -> list[float]:
    """Numbers about a candidate: its length, character transitions and dictionary words, neighbouring words and path."""
    value = raw[a:b].decode("utf-8", "replace")
    before = raw[max(0, a - 60):a].decode("utf-8", "replace").lower()
    after = raw[b:b + 20].decode("utf-8", "replace").lower()
    line = before.rsplit("\n", 1)[-1]
    near = line[-32:]
    n = len(value)
    pairs = list(zip(value, value[1:]))
    kind = [0 if c.isalpha() else 1 if c.isdigit() else 2 for c in value]
    path = path.lower()
    return [
        log2(n), entropy(value),
        sum({x, y} == {0, 1} for x, y in zip(kind, kind[1:])) / max(1, n - 1),
        sum(x.isalpha() and y.isalpha() and x.isupper() != y.isupper() for x, y in pairs) / max(1, n - 1),
        coverage(value, dictionary), sum(k == 1 for k in kind) / n,
        float(all(c in string.hexdigits for c in value)), sum(k == 2 for k in kind) / n,
        float(any(k in near for k in KEYWORDS)), float(bool(re.search(r"[:=]>?\s{0,3}[\"'`]?$", near))),
        float(near[-1:] in "\"'`" and after[:1] in "\"'`" and bool(near)),
        float(any(k in value.lower() for k in DECOYS) or len(set(value)) <= 4),
        float(any(k in line or k in after for k in DECOYS)), float(any(k in near for k in CHECKSUMS)),
        float(near.endswith(("@", "://", ".", "/")) or after.startswith(("@", "://", "."))),
        float(any(k in path for k in ("test", "example", "doc", "sample"))),
        float(any(path.endswith(k) for k in (".py", ".js", ".env", ".yml", ".yaml", ".json", ".cfg"))),
        float(bool(ISSUED.fullmatch(value))),
    ]


class Forest:
    """Random forest of binary trees on numeric features: bootstrap rows, a random third of features per split, Gini."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 9, least: int = 2, seed: int = 11):
        self.trees = []
        rng = np.random.default_rng(seed)
        width = max(1, int(np.ceil(np.sqrt(x.shape[1]))))
        for _ in range(trees):
            rows = rng.integers(0, len(x), len(x))
            nodes: list[tuple] = []
            self._grow(x[rows], y[rows], depth, least, width, rng, nodes)
            self.trees.append([np.array(c) for c in zip(*nodes)])

    @classmethod
    def of(cls, trees: list) -> Forest:
        """A forest from another's trees, which are plain arrays and can be sent to workers without this package."""
        forest = cls.__new__(cls)
        forest.trees = trees
        return forest

    def _grow(self, x, y, depth, least, width, rng, nodes) -> int:
        at = len(nodes)
        share = float(y.mean())
        nodes.append((-1, 0.0, 0, 0, share))
        if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
            return at
        best = None
        for f in rng.permutation(x.shape[1])[:width]:
            order = np.argsort(x[:, f], kind="stable")
            values, marks = x[order, f], y[order]
            left = np.arange(1, len(y))
            ones = np.cumsum(marks)[:-1]
            right_ones = marks.sum() - ones
            gini = 2 * (ones * (left - ones) / left + right_ones * (len(y) - left - right_ones) / (len(y) - left))
            gini[(values[1:] == values[:-1]) | (left < least) | (len(y) - left < least)] = np.inf
            cut = int(gini.argmin())
            if np.isfinite(gini[cut]) and (best is None or gini[cut] < best[0]):
                best = (gini[cut], f, (values[cut] + values[cut + 1]) / 2)
        if best is None:
            return at
        low = x[:, best[1]] <= best[2]
        a = self._grow(x[low], y[low], depth - 1, least, width, rng, nodes)
        b = self._grow(x[~low], y[~low], depth - 1, least, width, rng, nodes)
        nodes[at] = (int(best[1]), float(best[2]), a, b, share)
        return at

    def score(self, x: np.ndarray) -> np.ndarray:
        """Mean share of secrets in the leaves reached."""
        total = np.zeros(len(x))
        for feature, cut, low, high, share in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                rows = np.flatnonzero(inner)
                node = at[rows]
                at[rows] = np.where(x[rows, feature[node]] <= cut[node], low[node], high[node])
            total += share[at]
        return total / max(1, len(self.trees))


def published_findings(n: int = 1500, seed: int = 23) -> list[tuple[bytes, str, int]]:
    """Labelled findings in shapes that public scanners document: (line with the value between \\x01 marks, path, label)."""
    rng = np.random.default_rng(seed)
    pick = lambda letters, k: "".join(rng.choice(list(letters), k))
    hexes, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    words = ["config", "session", "handler", "manager", "number", "article", "section", "reference", "document", "update"]
    names = ["token", "secret", "password", "api_key", "apikey", "access_key", "auth_token", "client_secret", "private_key"]
    paths = ["src/app.py", "config/prod.env", "deploy/site.yml", "src0", "src7", "notes.txt", "docs/guide.md", "tests/test_a.py"]
    out = []
    for _ in range(n):
        name, quote = rng.choice(names), rng.choice(['"', "'", ""])
        value = [lambda: pick(hexes, int(rng.choice([32, 40, 64]))), lambda: "AKIA" + pick(string.ascii_uppercase + "234567", 16),
                 lambda: "ghp_" + pick(alnum, 36), lambda: pick(alnum, int(rng.integers(16, 48))),
                 lambda: pick(alnum + "+/", 40) + "==", lambda: "xoxb-" + pick(string.digits, 12) + "-" + pick(alnum, 24),
                 lambda: pick(hexes, 40).upper()][rng.integers(7)]()
        sep = rng.choice([" = ", "=", ": "])
        out.append((f"{rng.choice(words)} {name}{sep}{quote}\x01{value}\x01{quote} {rng.choice(words)}", str(rng.choice(paths[:6])), 1))
        word = lambda: str(rng.choice(words))
        line = [
            lambda: f"{name} = {quote}\x01your_{name}_goes_here\x01{quote}", lambda: f"{name}={quote}\x01{'x' * int(rng.integers(16, 40))}\x01{quote}",
            lambda: f"{rng.choice(CHECKSUMS)} \x01{pick(hexes, int(rng.choice([32, 40, 64])))}\x01 {word()}",
            lambda: f"write to {word()}.{rng.integers(99)}@\x01mail{rng.integers(9)}-{word()}-{word()}\x01.example.com",
            lambda: f"see https://host/\x01{word()}/{word()}-{word()}_{rng.integers(999)}\x01.html",
            lambda: f"the \x01{word()}-{word()}-{word()}\x01 of {word()}", lambda: f"call \x01{pick(string.digits, int(rng.integers(16, 22)))}\x01 {word()}",
            lambda: f"{word()} \x01{word().title()}{word().title()}{word().title()}\x01({word()})",
            lambda: f"id \x01{pick(hexes, 8)}-{pick(hexes, 4)}-{pick(hexes, 4)}-{pick(hexes, 4)}-{pick(hexes, 12)}\x01 {word()}",
            lambda: f"{word()}\n\x01{rng.choice(['=', '-', '_']) * int(rng.integers(16, 60))}\x01\n{word()}",
            lambda: f"auth: \x01{word()}{word()}\x01, then",
        ][rng.integers(11)]()
        out.append((line, str(rng.choice(paths)), 0))
    return [(line.encode(), path, label) for line, path, label in out]


def unnamed_findings(n: int = 3000, seed: int = 31) -> list[tuple[bytes, str, int]]:
    """Labelled findings that no name precedes, known by their own form, and ordinary text of like lengths."""
    rng = np.random.default_rng(seed)
    pick = lambda letters, k: "".join(rng.choice(list(letters), k))
    size = lambda a, b: int(rng.integers(a, b))
    hexes, lower, upper, alnum = "0123456789abcdef", string.ascii_lowercase, string.ascii_uppercase, string.ascii_letters + string.digits
    words = ["config", "session", "handler", "manager", "number", "article", "section", "reference", "document", "update"]
    short = ["how", "to", "the", "of", "own", "in", "a", "is", "new", "for"]
    word = lambda: str(rng.choice(words))
    slug = lambda: "-".join(rng.choice([*words, *short], size(5, 11))) + str(rng.choice(["", f"-{size(0, 999)}"]))
    paths = ["src/app.py", "config/prod.env", "deploy/site.yml", "src0", "src7", "notes.txt"]
    secret = [
        lambda: f"{word()} \x01AKIA{pick(upper + '234567', 16)}\x01 {word()}",
        lambda: f"{word()} \x01{pick(alnum, size(20, 64))}\x01 {word()}",
        lambda: f"{word()} \x01xoxb-{pick(string.digits, 12)}-{pick(alnum, 24)}\x01 {word()}",
        lambda: f"{word()} \x01{pick(lower, size(2, 6))}{rng.choice(['_', '-'])}{pick(alnum, size(20, 64))}\x01, {word()}",
        lambda: f"{word()}: \x01{pick(lower, size(3, 6))}_{pick(hexes, int(rng.choice([32, 40, 64])))}\x01 {word()}",
        lambda: f"{word()} \x01{pick(lower, size(2, 9))}{rng.choice(['_', '-'])}{pick(hexes, int(rng.choice([24, 32, 48])))}\x01 {word()}",
        lambda: f"https://{word()}.example.net/{word()}/\x01{pick(alnum, size(20, 48))}\x01 {word()}",
        lambda: f"https://{word()}.example.net/\x01{word()}/{pick(upper + string.digits, 9)}/{pick(alnum, size(20, 32))}\x01 {word()}",
        lambda: f"{word()} \x01{pick(alnum, size(16, 28))}.{pick(alnum + '_-', size(24, 48))}\x01 {word()}",
        lambda: f"{word()} \x01eyJ{pick(alnum, 33)}.{pick(alnum + '_-', size(40, 300))}.{pick(alnum + '_-', 43)}\x01 {word()}",
        lambda: f"{word()}://{word()}:\x01{pick(alnum + '!#$%', size(8, 24))}\x01@{word()}.example.org/{word()}",
        lambda: f"{word()}\n\x01-----BEGIN PRIVATE KEY-----\n{pick(alnum + '+/', 64)}\n{pick(alnum + '+/', 64)}\n-----END PRIVATE KEY-----\x01\n",
    ]
    plain = [
        lambda: f"{word()} \x01{pick(hexes, int(rng.choice([24, 32, 40, 64])))}\x01 {word()}",
        lambda: f"id \x01{pick(hexes, 8)}-{pick(hexes, 4)}-{pick(hexes, 4)}-{pick(hexes, 4)}-{pick(hexes, 12)}\x01 {word()}",
        lambda: f"data base64,\x01{pick(alnum + '+/', size(40, 200))}\x01 {word()}",
        lambda: f"{word()} \x01{word()}_{word()}_{size(0, 9999)}_{word()}\x01 {word()}",
        lambda: f"{word()} \x01{word()}{word().title()}{size(0, 99)}{word().title()}\x01 {word()}",
        lambda: f"{word()} \x01{pick(lower, size(16, 40))}\x01 {word()}",
        lambda: f"https://{word()}.example.net\x01/{word()}/{size(1990, 2030)}/0{size(1, 10)}/{slug()}\x01{rng.choice([' ', '.html '])}{word()}",
        lambda: f"https://{word()}.example.net/\x01{slug()}/{slug()}\x01 {word()}",
        lambda: f"{word()} \x01{slug()}\x01 {word()}",
    ]
    out = []
    for _ in range(n):
        out.append((secret[size(0, len(secret))](), str(rng.choice(paths)), 1))
        out.append((plain[size(0, len(plain))](), str(rng.choice(paths)), 0))
    return [(line.encode(), path, label) for line, path, label in out]


def marked(line: bytes) -> tuple[bytes, int, int]:
    """A labelled line without its marks, and the value's place."""
    a, b = line.index(b"\x01"), line.rindex(b"\x01") - 1
    return line.replace(b"\x01", b""), a, b


def found_lines(findings: list[tuple[bytes, str, int]]) -> list[tuple[bytes, str, int]]:
    """Labelled lines with the marks around what the scan finds of the value; lines where it finds nothing are left out."""
    out = []
    for line, path, label in findings:
        raw, start, end = marked(line)
        out += [(raw[:a] + b"\x01" + raw[a:b] + b"\x01" + raw[b:], path, label) for a, b in spans(raw) if a < end and b > start]
    return out


def context(docs: DataFrame, share: float, seed: int = 29) -> DataFrame:
    """Candidates of a hashed share of the documents, each as a labelled line would be: line, path."""
    def run(batches) -> Iterator[dict[str, list]]:
        for batch in batches:
            lines, paths = [], []
            for raw, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (raw or b"").replace(b"\x01", b" ")
                for a, b in spans(raw):
                    lines.append(raw[max(0, a - 60):a] + b"\x01" + raw[a:b] + b"\x01" + raw[b:b + 20])
                    paths.append(path)
            if lines:
                yield {"line": lines, "path": paths}

    some = docs.where(F.xxhash64(F.lit(seed), "doc_id", "text") / F.lit(2.0 ** 64) + 0.5 < share)
    return arrow_pass(some.select(utf8().alias("raw"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("path")),
                      run, "line binary, path string")


def rule_label(line: bytes, path: str, dictionary: frozenset[str]) -> int | None:
    """A finding's label where it is beyond doubt: given to a credential's name and random, or plainly ordinary; else none."""
    x = dict(zip(FEATURES, features(*marked(line), path, dictionary)))
    random_looking = x["entropy"] >= 3.0 and x["coverage"] < 0.5 and 2 ** x["length"] >= 16
    if x["keyword_before"] and x["assigned"] and random_looking and not (x["decoy_value"] or x["decoy_near"]):
        return 1
    formed = random_looking and x["letter_digit"] + x["case_change"] >= 0.25
    if not x["keyword_before"] and (x["address_near"] and not formed or x["coverage"] >= 0.6 or x["entropy"] < 2.5 or x["digits"] == 1):
        return 0
    return None


def dictionary_of(vocabulary: str) -> frozenset[str]:
    """Words of four letters and more of a public vocabulary file, folded."""
    import json
    with open(vocabulary, encoding="utf-8") as file:
        pieces = json.load(file)["model"]["vocab"]
    return frozenset(w.lower() for w in (p.lstrip("Ġ") for p in pieces) if len(w) >= 4 and w.isascii() and w.isalpha())


def fit(findings: list[tuple[bytes, str, int]], dictionary: frozenset[str]) -> Forest:
    """Forest from labelled findings (line with the value between \\x01 marks, path, label); with none, all score 0."""
    rows = sorted(set(findings))
    x = np.array([features(*marked(line), path, dictionary) for line, path, _ in rows]).reshape(len(rows), len(FEATURES))
    return Forest(x, np.array([label for *_, label in rows], float), trees=40 if rows else 0)


def corpus_findings(docs: DataFrame, dictionary: frozenset[str], sample_docs: int = 4000, most: int = 8000) -> list:
    """Labelled findings of about `sample_docs` documents (`most` findings at most), chosen by hash."""
    total = docs.count()
    found = context(docs, min(1.0, sample_docs / max(1, total))).distinct().orderBy(F.xxhash64("line"), "line", "path").limit(most)
    rows = [(bytes(r.line), r.path) for r in found.collect()]
    labelled = [(line, path, rule_label(line, path, dictionary)) for line, path in rows]
    return [row for row in labelled if row[2] is not None]


def scanned(docs: DataFrame, forest: Forest, dictionary: frozenset[str], keep: tuple[str, ...] = ("doc_id",),
            threshold: float = 0.5, mask: str = "[secret]") -> DataFrame:
    """Whole texts scanned in one pass: the columns of `keep`, findings and redacted.

    findings: array of (start, end, score, secret), byte offsets in UTF-8, for every candidate; redacted: the text with
    each secret replaced by `mask` (null stays null). The path is the column `source` (null: empty). Repeated rows
    repeat, an empty table gives none; other columns play no part.
    """
    sent = docs.sparkSession.sparkContext.broadcast((forest.trees, dictionary))
    types = dict(docs.dtypes)
    schema = ", ".join([f"_k{i} {types[c]}" for i, c in enumerate(keep)] + [
        "findings array<struct<start:bigint,end:bigint,score:double,secret:boolean>>, redacted string"])
    n = len(keep)

    def run(batches) -> Iterator[dict[str, list]]:
        trees, dictionary = sent.value
        forest = Forest.of(trees)
        for batch in batches:
            raws, paths = batch.column(n).to_pylist(), batch.column(n + 1).to_pylist()
            places = [(row, a, b) for row, raw in enumerate(raws) if raw for a, b in spans(raw)]
            x = np.array([features(raws[row], a, b, paths[row], dictionary) for row, a, b in places])
            scores = forest.score(x.reshape(len(places), len(FEATURES))).tolist()
            findings: list[list[dict]] = [[] for _ in raws]
            for (row, a, b), score in zip(places, scores):
                findings[row].append({"start": a, "end": b, "score": score, "secret": score >= threshold})
            redacted = []
            for raw, found in zip(raws, findings):
                out, at = [], 0
                for f in found:
                    if f["secret"]:
                        out += [raw[at:f["start"]], mask.encode()]
                        at = f["end"]
                redacted.append(None if raw is None else b"".join([*out, raw[at:]]).decode("utf-8", "replace"))
            yield {f"_k{i}": batch.column(i).to_pylist() for i in range(n)} | {"findings": findings, "redacted": redacted}

    found = arrow_pass(docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], utf8().alias("_raw"),
                                   F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_path")), run, schema)
    return found.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "findings", "redacted")


def trained(spark: SparkSession, docs: DataFrame, vocabulary: str) -> tuple[Forest, frozenset[str]]:
    dictionary = dictionary_of(vocabulary)
    return fit(found_lines(published_findings() + unnamed_findings()) + corpus_findings(docs, dictionary), dictionary), dictionary
