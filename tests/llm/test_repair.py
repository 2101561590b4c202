"""Conversation repair against all edits of short conversations."""

import hashlib
import itertools
import random
import re

import pytest

from acervo.llm.repair import digests, joined, parsed, repaired, row_table, segments_of

SCHEMA = "conv_id bigint, turn bigint, role string, text string, seg string, n string, c string, rows string, `key` string, at string"
LEGAL = re.compile("(s?(ua)+)?")


def ordered(rows):
    return sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = re.sub("[\x20\x09-\x0D]", "", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """Every way to keep, rerole or delete each row and to insert up to two turns before, between and after."""
    rows = ordered(rows)
    found = faults(rows)
    best = None
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    edits = []
    for (_, role, text), fault in zip(rows, found):
        own = [("D", 4, None)]
        if fault not in ("blank", "duplicate"):
            more = 3 * (fault == "truncated")
            own += [("K", more, (role, text)), ("R", 3 + more, ("user", text)), ("R", 3 + more, ("assistant", text))]
        edits.append(own)
    for chosen in itertools.product(*edits):
        cost = sum(c for _, c, _ in chosen)
        if best is not None and cost > best[0]:
            continue
        for added in itertools.product(inserts, repeat=len(rows) + 1):
            total = cost + 3 * sum(map(len, added))
            if best is not None and total > best[0]:
                continue
            names = {"u": ("user", ""), "a": ("assistant", "")}
            turns, audit = [names[x] for x in added[0]], "I" * len(added[0])
            for (letter, _, turn), extra in zip(chosen, added[1:]):
                turns += ([turn] if turn else []) + [names[x] for x in extra]
                audit += letter + "I" * len(extra)
            if LEGAL.fullmatch("".join(role[:1] or "?" for role, _ in turns)):
                best = min(best or (1e9,), (total, audit, turns))
    numbered = [t for t, _, _ in rows if t is not None]
    gap = max(numbered) - min(numbered) + 1 - len(set(numbered)) if numbered else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    lines = "\n".join(f"{r}:{t}" for r, t in best[2])
    return (gap, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, best[0], best[1],
            hashlib.sha256(lines.encode()).hexdigest())


def results(spark, rows, segment_turns):
    table = spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA)
    report, turns = repaired(table, segment_turns)
    sums = {r.conv_id: r.sha256 for r in digests(turns).collect()}
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, sums[r.conv_id]) for r in report.collect()}


TEXTS = ["Yes.", "No!", "cut off", "Why? ", "", " \n\t", None, "\xa0", "été…", "Done.)"]
ROLES = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "ubiquitous"]


@pytest.mark.parametrize("segment_turns", [4096, 2])
def test_short_conversations(spark, segment_turns):
    rnd = random.Random(5)
    by = {}
    for conv in [None, *range(60)]:
        rows = [(rnd.choice([0, 1, 2, 3, 5, None, -4]), rnd.choice(ROLES), rnd.choice(TEXTS)) for _ in range(rnd.randint(1, 4))]
        if rnd.random() < 0.4:
            rows.append(rnd.choice(rows))
        by[conv] = rows[:4]
    got = results(spark, [(conv, *r) for conv, rows in by.items() for r in rows], segment_turns)
    assert got == {conv: brute(rows) for conv, rows in by.items()}


def test_long_conversation_in_segments(spark):
    """A third of all rows in one conversation, with a row that repeats hundreds of times."""
    rnd = random.Random(6)
    rows = [(1, i, rnd.choice(["user", "assistant", "system"]), f"text {i}{rnd.choice(['.', '', '?'])}") for i in range(700)]
    rows += [(1, 350, "user", "again.")] * 400 + [(1, 9 * i, "assistant", "same.") for i in range(60)]
    rows += [(2 + i % 300, i, "user", "hi.") for i in range(900)]
    whole, cut = results(spark, rows, 4096), results(spark, rows, 16)
    assert whole == cut and len(whole) == 301
    table = spark.createDataFrame([(*r, *["x"] * 6) for r in rows], SCHEMA)
    assert segments_of(table, 16).where("conv_id = 1").count() > 40
    assert segments_of(table, 16).where("size(rows) > 32").count() == 0


def test_every_split_gives_the_same_table():
    rnd = random.Random(7)
    for _ in range(200):
        tables = [row_table(rnd.choice(["s", "u", "a", "x", ""]), rnd.random() < 0.2, rnd.random() < 0.3, rnd.randint(1, 3))
                  for _ in range(rnd.randint(1, 9))]
        want = tables[0]
        for t in tables[1:]:
            want = joined(want, t)
        assert parsed(tables) == want
        assert parsed(tables, lambda n: rnd.randint(1, n - 1)) == want


def test_empty_tables(spark):
    report, turns = repaired(spark.createDataFrame([], SCHEMA))
    assert report.collect() == [] and digests(turns).collect() == []
