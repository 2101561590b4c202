"""Boundary rows of the column functions."""

import unicodedata

from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions import dates as D
from acervo.functions import replies as R
from acervo.functions import score as S
from acervo.functions import similarity as M
from acervo.functions import text as X
from acervo.functions import urls as U

T = F.col("t")


def test_fold_equals_unicode_definition(values):
    texts = ["ã ç É", "ß", "Nº 5ª", "é ö", "😀 ok", "½ kg", "ﬁm œuvre", "“aspas” …", "ｆｕｌｌ", None, ""]
    want = [None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert values([(t,) for t in texts], "t string", X.fold(T)) == want


def test_slug(values):
    rows = [None, "", "São Pedro IV S.A.", "!!! ???", "ab cd ef", "x" * 70, "日本"]
    assert values([(t,) for t in rows], "t string", X.slugify(T, 60)) == [
        "sem-titulo", "sem-titulo", "sao-pedro-iv-s-a", "sem-titulo", "ab-cd-ef", "x" * 60, "sem-titulo"]
    # a cut that lands on a dash is stripped again
    assert values([("ab cd ef",)], "t string", X.slugify(T, 3)) == ["ab"]


def test_document_id_uses_title_without_url(values):
    got = values([("fonte", "Título", ""), ("fonte", "Título", "u")], "s string, t string, u string",
                 X.document_id(F.col("s"), T, F.col("u")))
    import hashlib
    assert got[0] == "fonte_titulo_" + hashlib.md5("Título".encode()).hexdigest()[:8]
    assert got[1] == "fonte_titulo_" + hashlib.md5(b"u").hexdigest()[:8]


def test_paywall_scan_width(values):
    m = "assine já"
    rows = ["x" * 1490 + m, "x" * 1495 + m, "ASSINE JÁ agora", "livre", "x" * 1491 + m]
    assert values([(t,) for t in rows], "t string", X.looks_paywalled(T)) == [True, False, True, False, True]


def test_keyword_terms_in_list_order(values):
    assert values([("Esgotamento SANITARIO e Saneamento; agems",)], "t string", X.matched_terms(T)) == [
        ["AGEMS", "saneamento", "esgotamento sanitário"]]


def test_list_append_and_notes(values):
    rows = [(None,), ("",), ("a, b",), ("a,, n ,",)]
    assert values(rows, "t string", X.append_to_list(T, F.lit("n"))) == ["n", "n", "a, b, n", "a, n"]
    assert values([(None,), (" ",), ("x",)], "t string", X.append_note(T, F.lit("r"))) == ["r", "r", "x | r"]


def test_escape(values):
    assert values([(None,), ("NaN",), ("a<b & \"c\"\nd",)], "t string", X.escape_html(T, multiline=True, quotes=True)) == [
        "", "", "a&lt;b &amp; &quot;c&quot;<br>d"]


def test_insert_before_body_end(values):
    assert values([("<p></p></body></body>",), ("x",)], "t string", X.insert_before_body_end(T, F.lit("B"))) == [
        "<p></p>B</body>B</body>", "xB"]


def test_tickers(values):
    aliases = ["Taesa", "TAEE11", "A B", "TOOLONG12", "123", "TAEE3", "X1"]
    assert values([(aliases,)], "t array<string>", X.tickers(T)) == [["TAEE11", "TAEE3"]]


def test_urls(values):
    rows = ["https://www.A.com:80/x", "http://b.org", "not a url", "", None]
    assert values([(t,) for t in rows], "t string", U.domain(T)) == ["a.com:80", "b.org", "", "", ""]
    assert values([(t,) for t in rows[:3]], "t string", U.root(T)) == ["https://www.A.com:80", "http://b.org", ""]
    assert values([("https://x/a/Relat%C3%B3rio-1_b+c.PDF",)], "t string", U.file_title(T)) == ["Relatório 1 b+c"]
    assert values([("https://x.com/a/b", "../c?d"), ("https://x.com", None)], "b string, t string", U.absolute(F.col("b"), T)) == [
        "https://x.com/c?d", None]


def test_dates(values):
    def one(fn, *texts):
        return values([(t,) for t in texts], "t string", fn(T))

    assert one(D.loose_br_date, "1/02/26", "31/02/2026", "em 05/03/2024 e 06/03/2024") == ["2026-02-01", None, "2024-03-05"]
    assert one(D.us_date, "08/12/2026") == ["2026-08-12"]
    assert one(D.long_pt_date, "1 de março de 2026", "2 de MARCO de 2026", "3 de brumário de 2026", None) == [
        "2026-03-01", "2026-03-02", None, None]
    assert one(D.short_month_date, "Ago 17, 2026", "Oct 30, 2024", "18 Mar 2026", "Foo 1, 2026", "17 agosto 2026") == [
        "2026-08-17", "2024-10-30", "2026-03-18", None, "2026-08-17"]
    assert one(lambda c: D.br_date(c, "Data da publicação"), "Data da publicação: 01/02/2026", "01/02/2026") == ["2026-02-01", None]
    assert one(lambda c: D.rfc2822_date(c, F.lit("F")), "Mon, 03 Aug 2026 10:00:00 GMT", "3 Aug 2026 10:00:00 +0000",
               "Mon, 03 Aug 2026 23:00:00 -0300", "bad") == ["2026-08-03", "2026-08-03", "2026-08-03", "F"]
    assert one(D.underscore_file_date, "do_01_02_2026.pdf", "do_01_02_2026.PDF") == ["2026-02-01", None]


def test_reference_date(values):
    rows = [("", "2026-01-02T10:00"), ("bad", "2026-01-02"), (None, None), ("2026-01-05 10:00", "")]
    got = values(rows, "p string, d string", D.reference_date(F.col("p"), F.col("d"), F.lit("2020-01-01").cast("date")).cast("string"))
    assert got == ["2026-01-02", "2020-01-01", "2020-01-01", "2026-01-05"]


def test_window_keeps_undated(values):
    as_of = F.lit("2026-01-02 00:00:00").cast("timestamp_ntz")
    rows = [("2026-01-01 00:00:00",), ("2025-12-31 23:59:59",), (None,), ("2027-01-01 00:00:00",)]
    assert values(rows, "t string", D.within_hours(T.cast("timestamp_ntz"), as_of)) == [True, False, True, True]


def test_money(values):
    texts = ["R$ 100 milhões", "R$ 99,9 mi", "R$ 5,48 bi", "R$ 100.000.000", "R$ ,", "R$ 1,2,3 bi", "R$ 5 mil",
             "R$ 5 e R$ 2 BILHÕES", "r$ 150 MILHÕES", "US$ 5", None, "R$ 99 milhas"]
    assert values([(t,) for t in texts], "t string", S.has_relevant_amount(T)) == [
        True, False, True, True, False, False, False, True, True, False, False, False]


def test_relevance_rounds_like_the_exact_value(values):
    for level in (1, 2, 3, None):
        for n in (0, 1, 2, 3, 4):
            for money in (True, False):
                for tags in (["m_a"], []):
                    p = {1: 1.0, 2: 0.6, 3: 0.3}.get(level, 0.3)
                    q = 0.0 if n == 0 else 0.5 if n == 1 else 0.75 if n <= 3 else 1.0
                    want = round(min(1.0, 0.30 * p + 0.35 * q + 0.15 * money + 0.20 * bool(tags)), 3)
                    CASES.append(((level, n, money, tags), want))
    rows = [c for c, _ in CASES]
    got = values(rows, "l int, n int, m boolean, t array<string>", S.relevance_score(F.col("l"), F.col("n"), F.col("m"), S.critical_tags(T)))
    assert got == [w for _, w in CASES]


CASES: list = []


def test_sentiment(values):
    rows = [("abc",), ("2.0",), ("-3",), (None,), ("0.12345",)]
    assert values(rows, "t string", S.clean_sentiment_score(T)) == [0.0, 1.0, -1.0, 0.0, 0.123]
    assert values([("positivo",), ("Positivo",), (None,)], "t string", S.clean_sentiment(T)) == ["positivo", "neutro", "neutro"]


def test_tags_keep_order_and_repeats(values):
    rows = [(["esg", "zzz", "esg"],), (None,)]
    assert values(rows, "t array<string>", S.allowed_tags(T), S.rejected_tags(T)) == [(["esg", "esg"], ["zzz"]), (None, None)]


def test_status_and_importance(values):
    rows = [("Coberta e validada em produção",), ("ERRO: bloqueada",), ("Descartada",), (None,), ("coberta indiretamente (erro)",)]
    assert values(rows, "t string", S.status_class(T)) == ["badge-ok", "badge-erro", "badge-descartada", "badge-medio", "badge-ok"]
    assert values([("Baixa",), ("Zeta",), (None,)], "t string", S.importance_rank(T)) == [4, 99, 99]


def test_fences(values):
    rows = ["```json\n{\"k\": 1}\n```", "```\n{\"k\": 2}```  ", "{\"k\": 3}", "nada", "[1]", None]
    got = values([(t,) for t in rows], "t string", R.parse_reply(T, "k int")["k"])
    assert got == [1, 2, 3, None, None, None]


def test_citations(values):
    ok = "- a [1] b [2]\n**Fontes:**\n[1] http://x\n[2] http://y"
    gap = "- a [1] b [3]\n[1] http://x\n[3] http://y"
    no_source, no_mark = "- a [1]\ntexto", "- a\n[1] http://x"
    assert values([(t,) for t in (ok, gap, no_source, no_mark)], "t string", R.citations_consistent(T)) == [True, False, False, False]


def test_sections(values):
    text = "solto\n## Visão Geral\n# ignorada\nlinha\n\n## Fontes\n(recado)\n## Sem corpo"
    got = values([(text,)], "t string", R.sections(T))[0]
    assert [(r["key"], r["body"]) for r in got] == [("visao geral", "linha"), ("fontes", ""), ("sem corpo", "")]


def test_company_markers(values):
    got = values([("x {portfolio:A B (T11)} y {portfolio:C}",)], "t string", R.company_markers(T))[0]
    assert [(r["name"], r["ticker"]) for r in got] == [("A B", "T11"), ("C", None)]


def test_cosine_zero_vector(values):
    rows = [([1.0, 0.0], [0.0, 0.0]), ([1.0, 1.0], [2.0, 2.0])]
    got = values(rows, "a array<double>, b array<double>", F.round(M.cosine(F.col("a"), F.col("b")), 9))
    assert got == [0.0, 1.0]


def test_round_exact(values):
    rows = [0.4425, 0.0005, 2.5, 1234.5675, -0.4425]
    got = values([(x,) for x in rows], "t double", S.round_exact(T, 3))
    assert got == [round(x, 3) for x in rows]


def test_parameters_are_consistent():
    assert set(P.CRITICAL_TAGS) <= set(P.TAG_VOCABULARY)
    assert len(P.JUNK_TAGS) == 11 and len(P.CONTENT_SELECTORS) == 11


def test_summary_length_counts_characters(values):
    """Characters of one to four bytes, at both limits and where bytes alone decide."""
    sizes = [0, 74, 75, 299, 300, 500, 501, 2001]
    for ch in "aé€🔴":
        assert values([(ch * n,) for n in sizes] + [(None,)], "t string", ~R._chars_between(T, 300, 500)) == [
            not 300 <= n <= 500 for n in sizes] + [None]
