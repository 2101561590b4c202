"""Operators on small fixtures with the boundary rows, and against sequential restatements."""

import datetime as dt
import random
import unicodedata

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from acervo.functions import similarity as M
from acervo.functions.html import Page, page_links, page_text, read_pages
from acervo.operators import capture as C
from acervo.operators import catalogue as K
from acervo.operators import clusters as G
from acervo.operators import dedup, digest, entities, filters, ordered
from acervo.operators.feeds import rating_actions
from acervo.operators.themes import macro_themes, merge_labels


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


# --- HTML -------------------------------------------------------------------

JUNK = frozenset(["script", "style", "nav", "footer"])


def text_of(html, **kw):
    options = {"article_mode": "min", "min_article": 500, "selectors": ["#content", ".a .b"], "min_selector": 300}
    return page_text(Page(html, JUNK), **{**options, **kw})


def test_html_text_nodes_split_at_inline_tags():
    assert text_of("<p>um <b>dois</b> três<!-- x -->quatro</p>") == "um\ndois\ntrês\nquatro"
    assert text_of('<script>var t="</p><p>não";</script><p>sim &amp; não') == "sim & não"
    assert text_of("<title>T</title><nav>menu</nav><p>x<br>y") == "T\nx\ny"


def test_html_thresholds():
    at, over = "x" * 300, "x" * 301
    assert text_of(f"<div id=content>{at}</div>fora") == f"{at}\nfora"
    assert text_of(f"<div id=content>{over}</div>fora") == over
    assert text_of(f"<div class='a'><i class='z b'>{over}</i></div>fora") == over
    assert text_of(f"<article>{'y' * 500}</article>fora").endswith("fora")
    assert text_of(f"<article>{'y' * 501}</article>fora") == "y" * 501
    two = f"<article>{'y' * 501}</article><article>z</article>"
    assert text_of(two) == "y" * 501 and text_of(two, article_mode="single").endswith("z")
    assert text_of("<article>a</article>b", article_mode="always") == "a"
    assert text_of(f"<article>{'y' * 501}</article>fora", article_mode="never").endswith("fora")


def test_html_links_and_base():
    page = Page('<h2><a href=" ../x?y#z ">a <b>b</b></a></h2><a>sem</a><a href="mailto:q">m</a>', JUNK)
    links = page_links(page, "https://h.com/d/e/f")
    assert [(x["text"], x["href"], x["url"], x["heading"]) for x in links] == [
        ("a b", "../x?y#z", "https://h.com/d/x?y#z", "h2"), ("m", "mailto:q", "mailto:q", None)]


def test_link_filter_and_first_wins(spark):
    html = '<a href="#t">a</a><a href="javascript:1">b</a><a href="/p">c</a><a href="/p">d</a><a href="">e</a><a href="tel:1">f</a>'
    pages = spark.createDataFrame([(1, "https://h.com", html)], "page_id long, url string, html string")
    assert rows(C.page_links(pages, ["page_id"]), "anchor_text", "link_url") == [("c", "https://h.com/p")]


def test_anchor_threshold(spark):
    df = spark.createDataFrame([("<a x><a y>",), ("<a x><a y><a z>",)], "h string")
    assert [r[0] for r in df.select(filters.is_listing(F.col("h"))).collect()] == [False, True]


def test_node_stream_pairs_links_with_the_last_heading(spark):
    html = '<a href="0.pdf">x</a><p>RESOLUÇÃO N 7</p><div><a href="1.pdf">y</a></div><a href="2.pdf">z</a><p>RESOLUÇÃO N 8</p><a href="3.pdf">w</a>'
    pages = spark.createDataFrame([(1, "https://h.com/", html)], "page_id long, url string, html string")
    nodes = read_pages(pages, ["page_id"], ["nodes"]).select("page_id", F.explode("nodes").alias("n")).select("page_id", "n.*")
    number = F.regexp_extract("text", r"RESOLUÇÃO N (\d+)", 1)
    for block in (100, 2):
        stream = ordered.carry_forward(
            nodes.withColumn("number", F.when(number != "", number)), ["page_id"], "pos", ["number"], block)
        assert rows(stream.filter("kind = 'link'"), "url", "number") == [
            ("https://h.com/0.pdf", None), ("https://h.com/1.pdf", "7"), ("https://h.com/2.pdf", "7"), ("https://h.com/3.pdf", "8")]


def test_two_hop_takes_first_file_and_reports_the_rest(spark):
    pages = spark.createDataFrame([
        ("https://h.com/1", '<a href="x.html">n</a><a href="b.pdf">b</a><a href="a.PDF">a</a>'), ("https://h.com/2", "<p>nada</p>")],
        "url string, html string")
    items = spark.createDataFrame([("https://h.com/1",), ("https://h.com/2",), ("https://h.com/3",)], "item string")
    found, dropped = C.resolve_files(items, "item", pages)
    assert rows(found, "item", "file_url") == [("https://h.com/1", "https://h.com/b.pdf")]
    assert rows(dropped, "item") == [("https://h.com/2",), ("https://h.com/3",)]


def test_capture_drops_seen_short_and_undated(spark):
    body = "palavra " * 40
    html = lambda extra: f"<h1>Título da página</h1><p>{extra}</p><p>{body}</p>"
    pages = spark.createDataFrame([
        ("a", "https://h.com/1", html("Publicado em: 03/02/2026")), ("a", "https://h.com/2", html("sem data")),
        ("a", "https://h.com/3", "<h1>x</h1>curto"), ("b", "https://h.com/4", html("Publicado em: 03/02/2026")),
        ("a", "https://h.com/5", html("Publicado em: 04/02/2026"))], "source_id string, url string, html string")
    rules = spark.createDataFrame([[{"source_id": "a", "sector": "S", "page_date_label": "Publicado em", "date_format": "br",
                                     "requires_date": True}.get(f.name) for f in C.RULE]], C.RULE)
    manifest = spark.createDataFrame([("a", "https://h.com/5")], "source_id string, key string")
    docs, seen = C.capture_documents(pages, manifest, rules, F.lit("2026-03-01").cast("date"))
    assert rows(docs, "url", "published_at", "sector") == [
        ("https://h.com/1", "2026-02-03", "S"), ("https://h.com/4", "2026-03-01", None)]
    assert seen.count() == 3


# --- ordered ------------------------------------------------------------------

def test_positions_do_not_depend_on_block_size(spark):
    data = [(random.Random(i).choice("ab"), i * 3 % 101) for i in range(101)]
    df = spark.createDataFrame(data, "k string, o long")
    want = {}
    for k in "ab":
        for n, o in enumerate(sorted(o for kk, o in data if kk == k)):
            want[o] = n
    for size in (7, 1000):
        got = {r["o"]: r["position"] for r in ordered.with_position(df, ["k"], "o", rows_per_block=size).collect()}
        assert got == want


def test_systematic_sample_equals_slicing(spark):
    for counts, target in (([1, 3, 40], 10), ([5, 5], 5), ([2, 1], 120), ([7, 9, 30, 2], 9)):
        data = [(f"2026-01-{d + 1:02d}", d * 1000 + i) for d, n in enumerate(counts) for i in range(n)]
        total, want = len(data), []
        for d in reversed(range(len(counts))):
            docs = [o for day, o in data if day == f"2026-01-{d + 1:02d}"]
            quota = max(1, round(target * len(docs) / total))
            want += docs[::max(1, len(docs) // quota)][:quota]
        df = spark.createDataFrame(data, "day string, o long")
        for size in (4, 1000):
            got = ordered.systematic_sample(df, "day", "o", target, size).orderBy("sample_position").collect()
            assert [r["o"] for r in got] == want[:target]


def test_paging_stop(spark):
    data = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z"), ("a", 3, "w"), ("a", 3, "v"),   # page 2 is short
            ("b", 1, "x"), ("b", 1, "y"), ("b", 2, "x"), ("b", 2, "y"), ("b", 3, "n"), ("b", 3, "m"),  # page 2 brings nothing
            ("c", 1, "q")]
    df = spark.createDataFrame(data, "s string, p int, k string")
    got = ordered.paging_stop(df, "s", "p", "k", 2, 5).groupBy("s").agg(F.count("*").alias("n"))
    assert rows(got, "s", "n") == [("a", 3), ("b", 2), ("c", 1)]


def test_first_wins_and_null_keys(spark):
    df = spark.createDataFrame([("s", None, 1), ("s", None, 2), ("s", "l", 4), ("s", "l", 3), ("t", "l", 9)], "s string, l string, o int")
    assert rows(dedup.first_wins_keep_null(df, "l", ["s"], [F.col("o")]), "s", "o") == [("s", 1), ("s", 2), ("s", 3), ("t", 9)]


# --- catalogue ------------------------------------------------------------------

def test_items_without_a_key_are_new_on_every_run(spark):
    items = spark.createDataFrame([("a", "k1", 1), ("a", "k2", 2), (None, "k1", 3), ("a", None, 4), (None, None, 5)], "s string, key string, o int")
    for seen, want in (([], [1, 2, 3, 4, 5]), ([("a", "k1"), ("a", None), (None, None)], [2, 3, 4, 5])):
        manifest = spark.createDataFrame(seen, "s string, key string")
        for new in (dedup.new_items, dedup.new_wide_items):
            found = new(items, manifest, ["s", "key"])
            assert sorted(r.o for r in found.collect()) == want and sorted(found.columns) == ["key", "o", "s"]


def test_status_upsert(spark):
    schema = "source_id string, status string, last_run timestamp, docs_captured long, last_error string"
    old = dt.datetime(2020, 1, 1)
    src = spark.createDataFrame([("a", "x", old, 1, None), ("a", "y", old, 1, None), ("b", "z", old, 1, "e")], schema)
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    runs = spark.createDataFrame([("a", True, 5, None, t1), ("a", False, 0, "it's", t2), ("zz", True, 1, None, t1)],
                                 "source_id string, ok boolean, docs long, error string, run_at timestamp")
    got = rows(K.upsert_run_status(src, runs, "source_id", [F.col("run_at")]), "source_id", "status", "docs_captured", "last_error")
    assert got == [("a", "Erro", 0, "it's"), ("a", "Erro", 0, "it's"), ("b", "z", 1, "e")]


def test_block_match_is_literal(spark):
    src = spark.createDataFrame([("A.B(",), ("",), (None,), ("zz",)], "name string")
    blk = spark.createDataFrame([(1, "falha a.b( hoje", None), (2, "axb(", "ZZ e A.B("), (3, None, None)], "id int, b string, f string")
    assert rows(K.match_blocks(src, blk, "name", ["b", "f"]), "name", "id") == [("A.B(", 1), ("A.B(", 2), ("zz", 2)]


def test_block_match_equals_brute_force(spark):
    """Short and repeated names, a gram that most blocks hold, a text of 20 kB, names that no block holds."""
    rnd = random.Random(2)
    names = ["a", "É", "ab", "xyz", "grupo sul", "GRUPO norte", "grupo", "zzzz nowhere", "", None, "grupo sul"] + [
        "grupo " + "".join(rnd.choices("abc", k=3)) for _ in range(20)]
    texts = ["Grupo " + " grupo ".join("".join(rnd.choices("abcd", k=rnd.randint(1, 5))) for _ in range(rnd.randint(1, 4))) for _ in range(80)]
    texts += [None, "", "é", "xy", "".join(rnd.choices("abcdef ", k=20_000)) + "grupo norte"]
    src = spark.createDataFrame(list(enumerate(names)), "sid int, name string")
    blk = spark.createDataFrame([(i, t, texts[-i]) for i, t in enumerate(texts)], "id int, name_text string, other string")
    want = sorted((s, i) for s, n in enumerate(names) if n for i, t in enumerate(texts)
                  if any(n.lower() in (x or "").lower() for x in (t, texts[-i])))
    for hot in (10_000, 7):
        got = K.match_blocks(src, blk, "name", ["name_text", "other"], hot=hot)
        assert sorted((r["sid"], r["id"]) for r in got.collect()) == want
    assert K.match_blocks(src, blk.limit(0), "name", ["other"]).count() == 0


def test_next_ids(spark):
    for existing, want in (([], "blq_001"), (["blq_099"], "blq_100"), (["blq_999", "x"], "blq_1000")):
        blocks = spark.createDataFrame([(i, "n") for i in existing], "id string, name string")
        new = spark.createDataFrame([(1, "novo")], "o long, name string")
        assert [r["id"] for r in K.append_blocks(blocks, new, "o").filter("name = 'novo'").collect()] == [want]


def test_fusion(spark):
    df = spark.createDataFrame([("real", None, "n"), ("set", "Alta", None), ("g1", "Baixa", "g"), ("g2", "Media", "h"), ("g3", "X", None), ("lone", "Y", None)],
                               "k string, importance string, notes string")
    pairs = spark.createDataFrame([("g1", "real"), ("g2", "real"), ("g3", "set"), ("lone", "absent")], "ghost string, real string")
    assert rows(K.fuse_duplicates(df, pairs, "k", ["importance", "notes"], F.col("k")), "k", "importance", "notes") == [
        ("lone", "Y", None), ("real", "Baixa", "n"), ("set", "Alta", None)]


def test_update_or_insert_refuses_ambiguous(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError):
        K.update_or_insert(df, spark.createDataFrame([("a", 3)], "k string, v int"), "k", ["v"])
    with pytest.raises(ValueError):
        K.assert_placeholder(df, F.col("k") == "a", F.lit(False))
    with pytest.raises(ValueError):
        K.choose_sources(df, "nope", "k")


def test_delete_keeps_null_predicate(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    assert rows(K.delete_where(df, F.col("k") == "a"), "k") == [("b",), (None,)]


def test_rating_columns(spark):
    df = spark.createDataFrame([("E", None)], "entityId string, ratingTo string")
    row = rating_actions(df).first()
    import hashlib
    assert row["synthetic_id"] == hashlib.md5(b"E|||||").hexdigest() and row["cwolTo"] == "" and len(row) == 15


# --- entities ------------------------------------------------------------------

ENT = [(0, "e1", "Um", ["São Pedro", "SPIV11", "S.A."]), (1, "e2", "Dois", ["sao pedro ", "Energia Solar Norte", "ABCDEF"]), (2, "e3", "Três", ["Radar"])]


@pytest.fixture(scope="module")
def index(spark):
    return entities.alias_index(spark.createDataFrame(ENT, "entity_pos int, canonical_id string, main_name string, aliases array<string>"))


def test_alias_index_last_wins(index):
    got = {r["alias_norm"]: (r["canonical_id"], r["n_owners"]) for r in index.collect()}
    assert got["SAO PEDRO"] == ("e2", 2) and got["SPIV11"] == ("e1", 1)


def brute_mentions(texts, index_rows, legacy=False):
    import re
    out = []
    for i, text in texts:
        t = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().strip().upper()
        for r in index_rows:
            a = re.escape(r["alias_norm"])
            if re.search(rf"\b{a}\b" if legacy else rf"(?<!\w){a}(?!\w)", t):
                out.append((i, r["alias_norm"], len(r["alias_norm"]) <= 5))
    return sorted(out)


def test_mentions_equal_brute_force(spark, index):
    texts = [(1, "O radar da São Pedro S.A. hoje"), (2, "Radares e SPIV11x"), (3, "spiv11, ABCDEF."), (4, "nada"), (5, "energia solar norte"),
             (6, None), (7, ""), (8, "s.a. S.A.x _radar radar_ radar"), (8, "radar")]
    docs = spark.createDataFrame(texts, "id int, text string")
    for legacy in (False, True):
        want = brute_mentions([(i, t or "") for i, t in texts], index.collect(), legacy)
        # one pass with the whole dictionary, and passes with parts of it
        for carried in (100, 2):
            got = entities.scan_mentions(docs, index, "id", "text", legacy, carried)
            assert rows(got, "id", "alias_norm", "suspect") == want
    assert entities.scan_mentions(docs, index.limit(0), "id", "text").count() == 0


def test_mentions_of_a_large_dictionary(spark):
    rnd = random.Random(9)
    parts = ["ANA", "AN", "A", "NA-", "BANANA", "B.", "A A"]
    names = sorted({"".join(rnd.choices(parts, k=rnd.randint(1, 4))).strip() for _ in range(400)})
    texts = [(i, "".join(rnd.choices([*parts, " ", "x", "_"], k=rnd.randint(0, 30)))) for i in range(60)]
    large = spark.createDataFrame([(a, f"c{i}", a.title(), (i, 0)) for i, a in enumerate(names)],
                                  "alias_norm string, canonical_id string, main_name string, pos struct<a:int,b:int>")
    docs = spark.createDataFrame(texts, "id int, text string")
    want = sorted(brute_mentions(texts, large.collect()), key=str)
    for carried in (1000, 50):
        assert rows(entities.scan_mentions(docs, large, "id", "text", carried=carried), "id", "alias_norm", "suspect") == want


def test_a_large_dictionary_reads_texts_once(spark, monkeypatch):
    """Aliases that hold a word take no pass for each part of the dictionary."""
    passes = []
    scan = entities._found_in_texts
    monkeypatch.setattr(entities, "_found_in_texts", lambda *a: passes.append(a) or scan(*a))
    names = [f"N{i} B.{i}" for i in range(40)] + ["--"]
    large = spark.createDataFrame([(a, f"c{i}", a) for i, a in enumerate(names)], "alias_norm string, canonical_id string, main_name string")
    docs = spark.createDataFrame([(1, "n1 b.1, n2 b.2"), (1, "n1 b.1"), (None, "x -- n7 b.77 n9 b.9")], "id int, text string")
    got = sorted((str(r["id"]), r["alias_norm"]) for r in entities.scan_mentions(docs, large, "id", "text", carried=2).collect())
    assert got == [("1", "N1 B.1"), ("1", "N1 B.1"), ("1", "N2 B.2"), ("None", "--"), ("None", "N9 B.9")]
    assert len(passes) == 1


def test_texts_are_strings_a_few_at_a_time():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(["t"] * 1000)], names=["k", "_text"])
    parts = list(entities._few_rows(iter([batch])))
    assert max(p.num_rows for p in parts) <= 256 and [k for p in parts for k in p.column(0).to_pylist()] == list(range(1000))


def nearest_aliases(names, aliases, threshold=85):
    """Every name against every alias in list order; the first of the best."""
    want = []
    for n in sorted(set(names)):
        score, _, canonical = max((M.token_set_ratio(n, a), -i, c) for i, (a, c) in enumerate(aliases))
        if score >= threshold:
            want.append((n, canonical, round(score, 6)))
    return want


def fuzzy(df, index, **more):
    return sorted((r["alias_norm"], r["canonical_id"], round(r["score"], 6)) for r in entities.match_fuzzy(df, index, **more).collect())


def test_fuzzy_equals_brute_force(spark, index):
    names = ["SAO PEDRU", "CIA ENERGIA SOLAR NORTE SA", "XYZ", "ENERGIA SOLAR", "RADAR NOVO", "ABCDEG", "", "  "]
    df = spark.createDataFrame([(n,) for n in names], "alias_norm string")
    ordered_aliases = [(r["alias_norm"], r["canonical_id"]) for r in sorted(index.collect(), key=lambda r: tuple(r["pos"]))]
    assert fuzzy(df, index) == nearest_aliases(names, ordered_aliases)
    assert entities.match_fuzzy(df, index.limit(0)).count() == 0 and entities.match_fuzzy(df.limit(0), index).count() == 0


@pytest.mark.parametrize("threshold", [0.85, 0.7])
def test_fuzzy_of_hard_names_equals_brute_force(spark, threshold):
    """Short tokens, shared hot tokens, changed, dropped and swapped letters, joined and parted tokens."""
    rnd = random.Random(3)
    stems = ["SA", "CIA", "A", "B", "AB", "GRUPO", "ENERGIA", "MARIPOSA", "LITORAL", "SUL", "X1", "NORTE", "AGUAS"]

    def made():
        return [rnd.choice(stems) if rnd.random() < 0.7 else "".join(rnd.choices("ABEIO", k=rnd.randint(1, 9))) for _ in range(rnd.randint(1, 4))]

    def changed(tokens):
        text = list(" ".join(tokens))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(text)) if text else 0
            kind = rnd.random()
            text[at:at + 1] = [] if kind < 0.3 else [rnd.choice("ABEIOXZ ")] if kind < 0.7 else text[at:at + 1] + [rnd.choice("AEIO ")]
        return "".join(text)

    aliases = sorted({" ".join(made()) for _ in range(120)})
    rnd.shuffle(aliases)
    names = [changed(rnd.choice(aliases).split()) if rnd.random() < 0.8 else " ".join(made()) for _ in range(150)]
    index = spark.createDataFrame([(a, f"c{i}", (i, 0)) for i, a in enumerate(aliases)],
                                  "alias_norm string, canonical_id string, pos struct<entity_pos:int,alias_pos:int>")
    df = spark.createDataFrame([(n,) for n in names], "alias_norm string")
    assert fuzzy(df, index, threshold=threshold) == nearest_aliases(names, [(a, f"c{i}") for i, a in enumerate(aliases)], threshold * 100)


def test_fuzzy_blocks_equal_brute_force(spark, monkeypatch):
    """Names and aliases in many blocks; null, blank and repeated names, letters of other scripts."""
    monkeypatch.setattr(entities, "BLOCK_LETTERS", 40)
    monkeypatch.setattr(entities, "BLOCK_NAMES", 3)
    rnd = random.Random(4)
    aliases = sorted({"".join(rnd.choices("ABCDÉ\U00010400 ", k=rnd.randint(1, 20))).strip() or "A" for _ in range(40)})
    names = [a[:3] + rnd.choice("ABX ") + a[4:] for a in aliases] * 2 + ["", " "]
    index = spark.createDataFrame([(a, f"c{i}", (i, 0)) for i, a in enumerate(aliases)],
                                  "alias_norm string, canonical_id string, pos struct<entity_pos:int,alias_pos:int>")
    df = spark.createDataFrame([(n,) for n in [*names, None]], "alias_norm string")
    assert fuzzy(df, index) == nearest_aliases(names, [(a, f"c{i}") for i, a in enumerate(aliases)])


def test_few_candidates_have_enough_grams_in_common():
    """Of random names nearly every pair shares some gram; only pairs with as many as the threshold asks for are compared."""
    rnd = random.Random(6)
    aliases = ["".join(rnd.choices("0123456789ABCDEF", k=12)) + " " + "".join(rnd.choices("0123456789ABCDEF", k=20)) for _ in range(2000)]
    names = [a[:5] + "Q" + a[6:] for a in aliases[:200]]
    index = M.GramIndex(aliases, 0.85)
    assert sum(len(places) for _, places in index.near(names)) < 0.002 * len(names) * len(aliases)
    assert sorted((n, a) for n, a, _ in index.scored(names)) == sorted(zip(names, aliases))


def test_token_set_ratio():
    assert M.token_set_ratio("RADAR", "NOVO RADAR SUL") == 100
    assert M.token_set_ratio("", "A") == 0
    assert round(M.token_set_ratio("FUZZY WAS A BEAR", "FUZZY FUZZY WAS A BEAR")) == 100
    a, b = "MARIPOSAS LITORAL", "MARIPOSA LITORAL"
    # shared "LITORAL"; rests differ by one letter
    assert abs(M.token_set_ratio(a, b) - (100 - 100 * 1 / (17 + 16))) < 1e-9


def test_resolution_marks_unmatched(spark, index):
    df = spark.createDataFrame([(1, "são pedro"), (2, "Cia Radar"), (3, "outra")], "p int, name string")
    assert rows(entities.resolve(df, index), "p", "canonical_id", "in_universe") == [(1, "e2", True), (2, "e3", True), (3, None, False)]


# --- clusters ------------------------------------------------------------------

def sequential_leaders(docs, threshold, window):
    unit = {i: v / np.linalg.norm(v) if np.linalg.norm(v) else v for i, _, v in docs}
    leaders, out = [], {}
    for i, day, _ in sorted(docs, key=lambda d: (d[1], d[0])):
        best, at = None, -2.0
        for leader, leader_day in leaders:
            if day - leader_day <= window:
                sim = float(unit[i] @ unit[leader])
                if sim >= threshold and sim > at + 1e-12:
                    best, at = leader, sim
        if best is None:
            leaders.append((i, day))
        out[i] = i if best is None else best
    return out


@pytest.mark.parametrize("seed,slices", [(0, 4000), (1, 3), (2, 2), (3, 2)])
def test_leaders_equal_sequential_scan(spark, seed, slices):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(4, 6))
    docs = []
    for i in range(70):
        kind = rng.integers(0, 10)
        if kind == 0:
            v = np.zeros(6)
        elif kind < 4:
            v = centers[0].copy()  # a third of all rows are copies of one vector
        else:
            v = centers[rng.integers(0, 4)] + rng.normal(scale=0.45, size=6)
        docs.append((i, int(rng.integers(0, 9)), v))
    df = spark.createDataFrame([(i, dt.date(2026, 1, 1) + dt.timedelta(days=d), [float(x) for x in v]) for i, d, v in docs],
                               "id int, day date, v array<double>")
    got = G.leader_clusters(df, "id", "day", "id", "v", 0.85, 3, slices)
    assert {int(r["id"]): int(r["leader_id"]) for r in got.collect()} == sequential_leaders(docs, 0.85, 3)


def rounds_of(monkeypatch):
    """A list that grows by one with each round of scans."""
    rounds = []
    scan = G._scan
    monkeypatch.setattr(G, "_scan", lambda *a: rounds.append(a) or scan(*a))
    return rounds


def test_unlike_documents_take_one_round(spark, monkeypatch):
    rounds = rounds_of(monkeypatch)
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, dt.date(2026, 1, 1 + i % 4), [float(x) for x in rng.normal(size=64)]) for i in range(1600)],
                               "id int, day date, v array<double>")
    assert G.leader_clusters(df, "id", "day", "id", "v", 0.85, slice_rows=300).filter("id <> leader_id").count() == 0
    assert len(rounds) == 1


@pytest.mark.parametrize("slice_rows", [4000, 80])
def test_a_chain_takes_as_many_rounds_as_it_crosses_slices(spark, monkeypatch, slice_rows):
    """Each document is near the one before and the one after it only."""
    rounds = rounds_of(monkeypatch)
    near_next = [[0.0] * i + [1.0, 1.0] + [0.0] * (200 - i) for i in range(200)]
    df = spark.createDataFrame([(i, dt.date(2026, 1, 1), [float(x) for x in v]) for i, v in enumerate(near_next)],
                               "id int, day date, v array<double>")
    got = {int(r["id"]): int(r["leader_id"]) for r in G.leader_clusters(df, "id", "day", "id", "v", 0.45, 3, slice_rows).collect()}
    # every second document leads; one between two leaders joins the earlier
    assert got == {i: i - i % 2 for i in range(200)}
    # a day of 200 in slices of 80: two cells, the larger in three parts, entered and left twice at most
    assert len(rounds) <= (1 if slice_rows == 4000 else 6)


@pytest.mark.parametrize("tile_rows", [12, 4000])
def test_small_slices_share_tiles(spark, monkeypatch, tile_rows):
    """Slices of 8 rows: tasks and rounds follow the tiles, and leaders are those of the sequential scan."""
    rounds = rounds_of(monkeypatch)
    rng = np.random.default_rng(7)
    docs = [(i, i % 10, rng.normal(size=8)) for i in range(150)]
    df = spark.createDataFrame([(i, dt.date(2026, 1, 1) + dt.timedelta(days=d), [float(x) for x in v]) for i, d, v in docs],
                               "id int, day date, v array<double>")
    got = G.leader_clusters(df, "id", "day", "id", "v", 0.5, 3, 8, tile_rows)
    assert {int(r["id"]): int(r["leader_id"]) for r in got.collect()} == sequential_leaders(docs, 0.5, 3)
    assert len(rounds) > 1 if tile_rows == 12 else len(rounds) == 1


def vectors(spark, docs):
    return spark.createDataFrame([(i, dt.date(2026, 1, 1) + dt.timedelta(days=d), [float(x) for x in v]) for i, d, v in docs],
                                 "id int, day date, v array<double>")


def test_many_rounds_stay_plannable(spark, monkeypatch):
    """The size that the optimizer reckons for a plan must not multiply with itself from round to round."""
    rounds, bits, cut = rounds_of(monkeypatch), [], G.cut_lineage

    def spy(df):
        bits.append(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()))
        return cut(df)

    monkeypatch.setattr(G, "cut_lineage", spy)
    rng = np.random.default_rng(8)
    docs = [(i, i // 6, rng.normal(size=4)) for i in range(30)]
    got = G.leader_clusters(vectors(spark, docs), "id", "day", "id", "v", 0.2, 3, 6, 6)
    assert {int(r["id"]): int(r["leader_id"]) for r in got.collect()} == sequential_leaders(docs, 0.2, 3)
    assert len(rounds) >= 3 and max(bits) < 4000


def test_a_day_that_fits_a_tile_is_not_cut(spark, monkeypatch):
    """Documents of one day in two tiles would wait for each other: here 30 unlike ones, then a day's chain of 40 in tiles of about 50."""
    rounds = rounds_of(monkeypatch)
    docs = [(i, 0, [float(i == k) for k in range(71)]) for i in range(30)]
    docs += [(30 + i, 1, [float(k in (30 + i, 31 + i)) for k in range(71)]) for i in range(40)]
    got = G.leader_clusters(vectors(spark, docs), "id", "day", "id", "v", 0.45, 0, 8, 50)
    assert {int(r["id"]): int(r["leader_id"]) for r in got.collect()} == {i: i if i < 30 else i - i % 2 for i in range(70)}
    assert len(rounds) == 1


def test_leaders_in_small_parts(spark, monkeypatch):
    """Rows meet others a few at a time, and a row that has found one is done."""
    for name, rows_ in (("SCAN_ROWS", 5), ("MEET_ROWS", 3)):
        monkeypatch.setattr(G, name, rows_)
    rng = np.random.default_rng(10)
    part = pd.DataFrame({"id": [str(i) for i in range(60)], "day": rng.integers(0, 8, 60), "ord": rng.integers(0, 9, 60),
                         "embedding": list(rng.normal(size=(60, 4))), "outside": rng.random(60) < 0.2})
    part.loc[rng.random(60) < 0.2, "ord"] = np.nan
    unit = M.unit_rows(part["embedding"])

    def near(i, j):
        gap = part["day"][i] - part["day"][j]
        return (0 < gap <= 2 or gap == 0 and part["ord"][j] < part["ord"][i]) and unit[i] @ unit[j] >= 0.6

    assert set(G._waits(0.6, 2)(part, part)["hi"]) == {str(i) for i in range(60) if any(near(i, j) for j in range(60))}
    leads, opened = set(), set()
    for i in part.sort_values(["day", "ord"]).index:
        if not any(near(i, j) for j in leads):
            (opened if part["outside"][i] or any(near(i, j) for j in opened) else leads).add(i)
    got = G._scan(0.6, 2)(part)
    assert {int(i): s for i, s in zip(got["id"], got["state"])} == {**dict.fromkeys(leads, G.LEADS), **dict.fromkeys(opened, G.OPEN)}


def test_documents_without_day_or_vector_lead(spark):
    df = spark.sql("select * from values (1, date'2026-01-01', array(1D, 0D)), (2, null, array(1D, 0D)), (3, date'2026-01-01', null), "
                   "(4, date'2026-01-01', array(0D, 0D)), (5, date'2026-01-02', array(2D, 0D)) t(id, day, v)")
    got = {r["id"]: r["leader_id"] for r in G.leader_clusters(df, "id", "day", "id", "v", 0.85).collect()}
    assert got == {"1": "1", "2": "2", "3": "3", "4": "4", "5": "1"}
    assert G.leader_clusters(df.limit(0), "id", "day", "id", "v", 0.85).count() == 0
    assert rows(G.similar_pairs(df, "id", "day", "id", "v", 0.85), "hi", "lo") == [("5", "1")]


def test_first_wins_carries_maps(spark):
    df = spark.sql("select * from values (1, 2, map('a', 1)), (1, 1, map('b', 2)) t(k, o, m)")
    assert [(r["k"], r["m"]) for r in dedup.first_wins(df, ["k"], [F.col("o")]).collect()] == [(1, {"b": 2})]


def test_status_only_moves_forward(spark):
    src = spark.sql("select 'a' source_id, 'x' status, timestamp_ntz'2026-01-05' last_run, 1L docs_captured, null last_error")
    runs = spark.sql("select 'a' source_id, true ok, 9L docs, null error, timestamp_ntz'2026-01-04' run_at")
    assert K.upsert_run_status(src, runs, "source_id", [F.col("run_at")]).first()["docs_captured"] == 1


def test_naive_scan_in_blocks(spark):
    docs = spark.sql("select 1 k, 'alfa beta gama delta' t")
    index = spark.createDataFrame([(a.upper(), a, a, (i, 0)) for i, a in enumerate(["alfa", "beta", "zeta", "gama", "ab"])],
                                  "alias_norm string, canonical_id string, main_name string, pos struct<a:int,b:int>")
    got = {limit: sorted(r["canonical_id"] for r in entities.naive_mentions(docs, index, "k", "t", limit).collect()) for limit in (5000, 2)}
    assert got[2] == got[5000] == ["alfa", "beta", "gama"]


def test_similarity_window_edges(spark):
    day = dt.date(2026, 1, 1)
    data = [(1, day, [1.0, 0.0]), (2, day + dt.timedelta(days=3), [1.0, 0.0]), (3, day + dt.timedelta(days=4), [1.0, 0.0]),
            (4, day, [0.0, 0.0]), (5, day, [3.0, 4.0])]
    df = spark.createDataFrame(data, "id int, day date, v array<double>")
    got = G.similar_pairs(df, "id", "day", "id", "v", 0.6)
    assert rows(got, "hi", "lo") == [("2", "1"), ("2", "5"), ("3", "2"), ("5", "1")]


def test_directional_slices_lose_no_pair(spark):
    rng = np.random.default_rng(11)
    centers = np.eye(5)
    vectors = [centers[i % 5] + rng.normal(scale=0.25, size=5) for i in range(120)]
    df = spark.createDataFrame([(i, dt.date(2026, 1, 1) + dt.timedelta(days=i % 2), [float(x) for x in v]) for i, v in enumerate(vectors)],
                               "id int, day date, v array<double>")
    unit = [v / np.linalg.norm(v) for v in vectors]
    want = sorted(tuple(sorted((i, j))) for i in range(120) for j in range(i) if unit[i] @ unit[j] >= 0.85)
    for slices in (4000, 6):
        got = G.similar_pairs(df, "id", "day", "id", "v", 0.85, 1, slices)
        assert sorted(tuple(sorted((int(r["hi"]), int(r["lo"])))) for r in got.collect()) == want


def sequential_titles(docs, threshold):
    from difflib import SequenceMatcher
    leaders, out = {}, {}
    for i, day, title in sorted(docs):
        key = unicodedata.normalize("NFKD", title).encode("ascii", "ignore").decode().lower().strip()
        hit = next((j for j, t in leaders.get(day, []) if SequenceMatcher(None, key, t).ratio() >= threshold), None)
        if hit is None:
            leaders.setdefault(day, []).append((i, key))
        out[i] = i if hit is None else hit
    return out


@pytest.mark.parametrize("slices", [4000, 25, 3])
def test_title_clusters_equal_sequential_scan(spark, slices):
    rng = random.Random(5)
    words = ["anel", "leilao", "tarifa", "revisao", "energia", "agua", "norte"]
    docs = [(i, rng.randint(0, 2), " ".join(rng.choices(words, k=rng.choice([0, 1, 4, 4, 4])))) for i in range(60)]
    docs += [(60 + i, 1, "Tarifa Não") for i in range(30)]  # a third of a day has one title
    df = spark.createDataFrame(docs, "id int, day int, title string")
    got = G.title_clusters(df, "id", "day", "id", "title", slice_rows=slices)
    assert {int(r["id"]): int(r["leader_id"]) for r in got.collect()} == sequential_titles(docs, 0.55)


def test_title_matches_equal_difflib():
    """Short, long and repetitive titles, on both sides of the threshold and exactly at it."""
    from difflib import SequenceMatcher
    rng = random.Random(3)
    for _ in range(400):
        letters = rng.choice(["ab", "abc xyz01 ", "abcdefghijklmnopqrstuvwxyz0123456789 "])
        n = rng.choice([0, 1, 5, 60, 63, 64, 127, 150, 199, 200, 230])
        a, b = ("".join(rng.choices(letters, k=max(0, n + rng.randint(-9, 9)))) for _ in range(2))
        b = rng.choice([b, a[:n // 3] + b[n // 4:], b[:n // 2] + a[n // 3:]])
        ratio = SequenceMatcher(None, a, b).ratio()
        for threshold in (0.3, 0.55, ratio, 0.9):
            leaders = G.TitleLeaders(threshold)
            leaders.add("b", b)
            assert (leaders.first(a) == "b") == G.M.TitleMatcher(b).fits(a, threshold) == (ratio >= threshold)


def test_unlike_titles_are_not_compared_one_by_one(monkeypatch):
    """Titles of one language share most letters; a title is compared whole with few leaders, not with most of them."""
    from difflib import SequenceMatcher
    rng, compared = random.Random(4), []
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(400)]
    own = getattr(G.M, "TitleMatcher", None)
    for kind, name in ((SequenceMatcher, "ratio"), *([(own, "fits")] if own else [])):
        monkeypatch.setattr(kind, name, lambda *a, f=getattr(kind, name): compared.append(1) or f(*a))
    leaders = G.TitleLeaders(0.55)
    for i in range(150):
        title = " ".join(rng.choices(words, k=9))
        if leaders.first(title) is None:
            leaders.add(str(i), title)
    assert len(leaders.ids) > 120 and len(compared) < 150 * 120 / 2 / 5


def test_title_clusters_without_day_or_title(spark):
    df = spark.sql("select * from values (1, null, 'a b c'), (2, null, 'a b d'), (3, 1, null), (4, 1, '!!'), (5, 1, 'a b c') t(id, day, title)")
    got = {r["id"]: r["leader_id"] for r in G.title_clusters(df, "id", "day", "id", "title").collect()}
    assert got == {"1": "1", "2": "1", "3": "3", "4": "3", "5": "5"}
    assert G.title_clusters(df.limit(0), "id", "day", "id", "title").count() == 0


def test_macro_themes(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(8, 12)) * 5
    data = [(i, [float(x) for x in centers[i % 8] + rng.normal(scale=0.1, size=12)]) for i in range(160)]
    df = spark.createDataFrame(data, "id int, v array<double>")
    got = {r["id"]: r["theme"] for r in macro_themes(df, "id", "v", components=4, fine=8).collect()}
    assert len(got) == 160 and len(set(got.values())) <= 5
    assert all(len({got[i] for i in range(160) if i % 8 == k}) == 1 for k in range(8))


def test_merge_labels():
    points = np.array([[1, 0], [0.99, 0.1], [0, 1], [0.1, 0.99]])
    assert merge_labels(points, 2) in ([0, 0, 1, 1], [1, 1, 0, 0])


# --- digest ------------------------------------------------------------------

def test_unknown_indices_are_ignored(spark):
    items = digest.numbered_items(spark.createDataFrame([("s", 5), ("s", 6)], "s string, id long"), ["s"], "id")
    replies = spark.createDataFrame([("s", '{"selected_news":[{"news_index":9,"choice_rationale":"x"},{"news_index":2,"choice_rationale":"y"}]}')], "s string, r string")
    assert rows(digest.apply_selection(items, replies, ["s"], "r"), "id", "priority", "choice_rationale") == [(6, 1, "y")]


def test_subject_limits(spark):
    df = spark.createDataFrame([("um dois", "a b c d e f g h i", ["x"] * 4), ("um dois três", "t", ["w " * 19])], "n string, t string, b array<string>")
    got = [r["violations"] for r in digest.subject_violations(df, "n", "t", "b").collect()]
    assert got == [["subject_words", "title_words", "bullet_count"], ["bullet_words"]]
