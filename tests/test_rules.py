"""Listing rules on small pages in each family's shape."""

from pyspark.sql import functions as F

from acervo.functions.html import Page
from acervo.operators import capture as C
from acervo.rules import rule_rows


def test_selectors():
    page = Page('<div class="g a"><p class="x"><i>1</i></p></div><section><i>2</i></section><a href="/n/1">3</a><b itemprop="d">4</b>', frozenset())

    def hits(css):
        return ["".join(page.inner(e)) for e in page.find(css)]

    assert hits("div.g.a i") == ["1"] and hits("div.a > i") == [] and hits("section > i") == ["2"]
    assert hits('a[href^="/n/"]') == ["3"] and hits('a[href^="/m/"]') == [] and hits('[itemprop="d"]') == ["4"]


CARDS = [
    ("ana_noticias", '<ul class="noticias listagem-noticias-com-foto"><li><h2 class="titulo"><a href="/x">T um</a></h2><span class="data">03/02/2026</span></li></ul>', "T um", "2026-02-03"),
    ("agenersa_rj_noticias", '<div class="views-row"><h2 class="field-content"><a href="/x">T</a></h2><time datetime="2026-02-03T10:00:00Z">x</time></div>', "T", "2026-02-03"),
    ("abar_noticias", '<article class="jeg_post"><h3 class="jeg_post_title"><a href="/x">T</a></h3><div class="jeg_meta_date">3 de fevereiro de 2026</div></article>', "T", "2026-02-03"),
    ("tcu_solucao_consensual", '<a href="/imprensa/noticias/x"><article><h2>T</h2><time datetime="2026-02-03">d</time></article></a>', "T", "2026-02-03"),
    ("teletime_noticias", '<div class="td_module_wrap"><h3 class="entry-title"><a href="/x">T</a></h3><time class="td-module-date">03/02/26, 10:30</time></div>', "T", "2026-02-03"),
    ("abr_aero_imprensa", '<div class="tf-posts grid"><div class="column"><h2 class="title"><a href="/x">T</a></h2><li class="post-date"><a>02/03/2026</a></li></div></div>', "T", "2026-02-03"),
    ("epe_noticias", '<div class="item"><a href="/area-1">T</a></div><div class="item"><a href="/x"><h2>T</h2></a><span class="date"> 03/02/2026</span></div>', "T", "2026-02-03"),
    ("abrace_noticias", '<div class="post-item"><h5 class="post-title"><a href="/x">T</a></h5></div>', "T", None),
]


def test_card_families(spark):
    pages = spark.createDataFrame([(i, s, "https://h.com/", h) for i, (s, h, _, _) in enumerate(CARDS)],
                                  "page_id int, source_id string, url string, html string")
    got = {r["source_id"]: (r["title"], r["published_at"]) for r in C.card_items(pages, rule_rows(spark), ["page_id"]).collect()}
    assert got == {s: (t, d) for s, _, t, d in CARDS}


def test_link_families(spark):
    html = ('<a href="https://www.acende.org/artigo/um-dois/">a</a><a href="https://www.gov.br/antaq/pt-br/noticias/x">b</a>'
            '<a href="https://www.gov.br/antaq/pt-br/noticias/y?p=1">c</a><h2><a href="/z">Extrato de Aviso Prévio 1</a></h2><h2><a href="/w">Notícia</a></h2>'
            '<a href="https://exame.com/esg/uma-noticia-bem-longa/">Uma notícia bem longa aqui</a><a href="https://exame.com/faculdade/x">Uma notícia bem longa fora</a>')
    sources = ["acende_brasil", "antaq_noticias", "agesan_rs_noticias", "psr_energia_em_foco"]
    pages = spark.createDataFrame([(i, s, "https://h.com/", html) for i, s in enumerate(sources)], "page_id int, source_id string, url string, html string")
    got = sorted((r["source_id"], r["link_url"]) for r in C.rule_links(pages, rule_rows(spark), ["page_id"]).collect())
    assert got == [("acende_brasil", "https://www.acende.org/artigo/um-dois/"), ("agesan_rs_noticias", "https://h.com/w"),
                   ("antaq_noticias", "https://www.gov.br/antaq/pt-br/noticias/x"), ("psr_energia_em_foco", "https://exame.com/esg/uma-noticia-bem-longa/")]


def test_page_date_rules(spark):
    body = "palavra " * 40
    pages = spark.createDataFrame([
        ("psr_energia_em_foco", "https://exame.com/1", f"<h1>ESG</h1><h1>Um título com tamanho</h1><p>Por X, 3 de março de 2026 às 10h</p><p>{body}</p>"),
        ("psr_energia_em_foco", "https://exame.com/2", f"<h1>Outro título sem data</h1><p>{body}</p>"),
        ("abcr", "https://abcr.org/1", f"<header><h1>Título</h1><time>março 3, 2026</time></header><p>{body}</p>")], "source_id string, url string, html string")
    empty = spark.createDataFrame([], "source_id string, key string")
    docs, _ = C.capture_documents(pages, empty, rule_rows(spark), F.lit("2026-04-01").cast("date"))
    assert sorted((r["url"], r["title"], r["published_at"]) for r in docs.collect()) == [
        ("https://abcr.org/1", "Título", "2026-03-03"), ("https://exame.com/1", "Um título com tamanho", "2026-03-03")]


def test_rules_before_first_wins_and_following_dates(spark):
    html = ('<a href="https://exame.com/esg/x/"><img></a><a href="https://exame.com/esg/x/">Uma notícia bem longa aqui</a>'
            '<a href="https://www.gov.br/antaq/pt-br/noticias/x"><img></a><a href="https://www.gov.br/antaq/pt-br/noticias/x">com título</a>'
            '<h2><a href="/w">Notícia</a></h2><p>publicado em 03/02/2026</p><h2><a href="/v">Outra</a></h2><p>sem data</p>')
    pages = spark.createDataFrame([(i, s, "https://h.com/", html) for i, s in enumerate(["psr_energia_em_foco", "antaq_noticias", "agesan_rs_noticias"])],
                                  "page_id int, source_id string, url string, html string")
    got = sorted((r["source_id"], r["link_url"], r["published_at"]) for r in C.rule_links(pages, rule_rows(spark), ["page_id"]).collect())
    assert got == [("agesan_rs_noticias", "https://h.com/v", None), ("agesan_rs_noticias", "https://h.com/w", "2026-02-03"),
                   ("psr_energia_em_foco", "https://exame.com/esg/x/", None)]


def test_optional_end_tags_and_backtracking():
    page = Page('<ul><li class="c"><a href="/1">um</a><li class="c"><a href="/2">dois</a><i>d2</i><ul><li>x</ul></ul><p>a<p>b<div>c</div>'
                '<table><tr><td>1<td>2<tr><td>3</table><dl><dt>t<dd>d<dt>u</dl>', frozenset())
    cards = page.find("li.c")
    assert [len(page.find("i", inside=c)) for c in cards] == [0, 1]
    assert ["".join(page.inner(e)) for e in page.find("p")] == ["a", "b"]
    assert ["".join(page.inner(e)) for e in page.find("tr")] == ["12", "3"] and ["".join(page.inner(e)) for e in page.find("dt")] == ["t", "u"]
    deep = Page('<div class="a"><div class="b"><div class="b"><i>1</i></div></div></div>', frozenset())
    assert len(deep.find("div.a > div.b i")) == 1 and len(deep.find("div.b > i")) == 1 and not deep.find("div.a > i")


def test_repeated_url_in_a_batch_is_one_document(spark):
    body = "palavra " * 40
    pages = spark.createDataFrame([("x", "https://a.com/1", f"<h1>T</h1><p>{body}</p>")] * 2, "source_id string, url string, html string")
    empty = spark.createDataFrame([], "source_id string, key string")
    docs, manifest = C.capture_documents(pages, empty, rule_rows(spark), F.lit("2026-04-01").cast("date"))
    assert docs.count() == 1 and manifest.count() == 1
