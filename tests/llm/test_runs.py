"""Periodic runs against brute force."""

import random
import time

import pyarrow as pa
import pytest

from acervo.llm.runs import gram_of, guaranteed, periodic_runs, read_slice


def brute(words, least=12):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - s + q >= max(least, 2 * q):
                found.append((s, i - s + q, q))
    runs = sorted((c for c in found if not any(d[2] < c[2] and d[0] <= c[0] and d[0] + d[1] >= c[0] + c[1] for d in found)),
                  key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def check(texts, least=12):
    n, runs, collapsed = (x.to_pylist() for x in read_slice(pa.array(texts, pa.string()), least))
    for i, text in enumerate(texts):
        words = (text or "").split()
        assert (n[i], [(r["start"], r["length"], r["period"]) for r in runs[i]], collapsed[i]) == (len(words), *brute(words, least))


def made(rnd):
    n, words = rnd.choice([0, 1, 11, 12, 13, 24, 60, 150]), rnd.choice([1, 2, 3, 6, 40])
    out = [f"w{rnd.randrange(words)}" for _ in range(n)]
    kind = rnd.random()
    if kind < 0.5 and n > 12:
        a = rnd.randrange(n)
        p = rnd.randint(1, max(1, (n - a) // 2))
        out = [out[i] if i < a else out[a + (i - a) % p] for i in range(n)]
    if kind < 0.2 and n > 12:
        out[rnd.randrange(n)] = "odd"
    if 0.5 < kind < 0.6:
        a, b = ["a"], ["a", "b"]
        while len(b) < n:
            a, b = b, b + a
        out = b[:n]
    return rnd.choice([" ", " \t", "\n"]).join(out) if rnd.random() < 0.97 else None


@pytest.mark.parametrize("seed", range(6))
def test_slices(seed):
    rnd = random.Random(seed)
    for _ in range(25):
        check([made(rnd) for _ in range(rnd.randint(0, 12))], rnd.choice([12, 12, 5, 2, 30]))


def test_a_run_of_runs():
    unit = " ".join(["a", "b"] * 9 + ["a"])
    check([f"{unit} {unit}", f"x {unit} {unit} {unit}", "a " * 40 + "x " + "a " * 40 + "x " + "a " * 40, "", None])


def test_guaranteed_grams_are_within_every_match():
    for least in (2, 5, 12, 30):
        for p in (1, 2, 4, 8, 16, 32):
            assert all(max(least - q, q) >= guaranteed(p, least) for q in range(p, 2 * p))
            assert 2 * gram_of(p, least) - 1 <= guaranteed(p, least)


def test_very_long_texts_stay_cheap():
    started = time.time()
    for text, period in (("a " * 300_000, 1), ("x y z u v w " * 40_000, 6), (("x y z " + "q " * 9) * 20_000, 12)):
        n, runs, _ = read_slice(pa.array([text]), 12)
        assert [r["period"] for r in runs.to_pylist()[0]][:1] == [period]
    assert time.time() - started < 60


def test_tables(edge_docs, no_docs):
    got = periodic_runs(edge_docs, keep=("doc_id", "_row", "d"))
    assert got.columns == ["doc_id", "_row", "d", "n_words", "runs", "collapsed"]
    rows = got.collect()
    texts = edge_docs.select("doc_id", "text").collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").split()), *map(str, brute((r.text or "").split()))) for r in texts
                  if len(r.text or "") < 30_000)
    have = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, str([tuple(x) for x in r.runs]), r.collapsed) for r in rows if r.n_words < 3000)
    assert have == want and len(rows) == len(texts)
    assert periodic_runs(no_docs).count() == 0


def test_plan_has_no_shuffle(edge_docs):
    assert "Exchange" not in periodic_runs(edge_docs)._jdf.queryExecution().executedPlan().toString()
