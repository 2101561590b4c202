"""Listing rules as rows: one per source, read by the capture operators.

Fixed values: addresses, selectors and formats of the public listings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from acervo.operators.capture import RULE

GOV_LIST = {"card_css": "ul.noticias.listagem-noticias-com-foto > li", "title_css": "h2.titulo a", "link_css": "h2.titulo a[href]",
            "date_css": "span.data", "date_format": "br", "title_mode": "h1", "page_date_label": "Publicado em", "page_date_format": "br"}

# Links of a page filtered by address.
LINK_RULES = [
    {"source_id": "acende_brasil", "sector": "ENERGIA", "url_regex": r"(?i)/artigo/[a-z0-9\-]+/?$", "title_mode": "h1",
     "page_date_label": "Data da publica[çc][ãa]o", "page_date_format": "br"},
    {"source_id": "antt_noticias_infraestrutura", "sector": "TRANSPORTE", "url_prefix": "https://www.gov.br/antt/pt-br/assuntos/noticias-defeso-eleitoral/",
     "forbid_query": True, "title_required": True, "title_mode": "h1", "page_date_label": "Publicado em", "page_date_format": "br"},
    {"source_id": "aneel_noticias", "sector": "ENERGIA", "url_prefix": "https://www.gov.br/aneel/pt-br/assuntos/noticias/2026-defeso-eleitoral/",
     "forbid_query": True, "title_required": True, "title_mode": "h1", "page_date_label": "Publicado em", "page_date_format": "br"},
    {"source_id": "antaq_noticias", "sector": "TRANSPORTE", "url_prefix": "https://www.gov.br/antaq/pt-br/noticias/",
     "forbid_query": True, "title_required": True, "title_mode": "h1", "page_date_label": "Publicado em", "page_date_format": "br"},
    {"source_id": "agesan_rs_noticias", "sector": "SANEAMENTO", "heading": "h2", "title_stop": ["extrato de aviso prévio"], "min_anchor": 1,
     "following_date": True, "title_mode": "none"},
    {"source_id": "agetransp_noticias", "sector": "TRANSPORTE", "url_prefix": "https://www.agetransp.rj.gov.br/noticias/", "min_anchor": 15,
     "following_date": True, "title_mode": "none"},
    {"source_id": "psr_energia_em_foco", "sector": "ENERGIA", "url_prefix": "https://exame.com/", "min_anchor": 20, "title_mode": "content_h1",
     "exclude": ["/arquivo/", "/politica-de-privacidade/", "/termos-de-uso/", "/politica-de-cookies/", "/lei-transparencia-salarial/",
                 "/institucional/", "/newsletters/", "/canais-especiais/", "/faculdade", "/revista-exame/", "/invest/calculadoras/",
                 "/invest/guia/", "materias-em-destaque"],
     "page_date_label": r"(?=\d{1,2} de \S+ de \d{4})", "page_date_format": "long_pt", "requires_date": True},
]

# Listing cards.
CARD_RULES = [
    {"source_id": "ana_noticias", "sector": "SANEAMENTO", **GOV_LIST},
    {"source_id": "anp_noticias", "sector": "ENERGIA", **GOV_LIST},
    {"source_id": "agenersa_rj_noticias", "sector": "SANEAMENTO", "card_css": "div.views-row", "title_css": "h2.field-content a",
     "link_css": "h2.field-content a[href]", "date_css": "time[datetime]", "title_mode": "h1"},
    {"source_id": "abegas_noticias", "sector": "ENERGIA", "card_css": "div.blog_post_preview.noticias", "title_css": "h2.blogpost_title a",
     "link_css": "h2.blogpost_title a[href]", "date_css": "span.post_date", "date_format": "br", "title_mode": "h1"},
    {"source_id": "abar_noticias", "sector": "REGULATORIO", "card_css": "article.jeg_post", "title_css": ".jeg_post_title a",
     "link_css": ".jeg_post_title a[href]", "date_css": ".jeg_meta_date", "date_format": "long_pt", "title_mode": "h1"},
    {"source_id": "epe_noticias", "card_css": "div.item", "title_css": "a[href] h2", "link_css": "a[href]", "date_css": "span.date",
     "date_format": "br", "exclude": ["/area-"], "title_mode": "none"},
    {"source_id": "tratabrasil_blog", "sector": "SANEAMENTO", "card_css": "div.e-loop-item", "title_css": "h1.elementor-heading-title a",
     "link_css": "h1.elementor-heading-title a[href]", "date_css": '[itemprop="datePublished"] time', "date_format": "br", "title_mode": "h1"},
    {"source_id": "abrace_noticias", "sector": "ENERGIA", "card_css": "div.post-item", "title_css": "h5.post-title a",
     "link_css": "h5.post-title a[href]", "title_mode": "none", "page_date_css": "time.entry-date[datetime]", "page_date_format": "iso"},
    {"source_id": "aesbe_noticias", "sector": "SANEAMENTO", "card_css": "article.elementor-post", "title_css": "h3.elementor-post__title a",
     "link_css": "h3.elementor-post__title a[href]", "title_mode": "none",
     "page_date_css": ".elementor-post-info__item--type-date time", "page_date_format": "br"},
    {"source_id": "tcu_solucao_consensual", "sector": "REGULATORIO", "card_css": 'a[href^="/imprensa/noticias/"]', "title_css": "h2",
     "date_css": "time[datetime]", "title_mode": "none"},
    {"source_id": "teletime_noticias", "sector": "TELECOM", "card_css": "div.td_module_wrap", "title_css": "h3.entry-title a",
     "link_css": "h3.entry-title a[href]", "date_css": "time.td-module-date", "date_format": "br_time", "title_mode": "h1"},
    {"source_id": "agergs_noticias", "sector": "TRANSPORTE", "card_css": "article", "title_css": "h2.conteudo-lista__item__titulo a",
     "link_css": "h2.conteudo-lista__item__titulo a[href]", "date_css": "time", "title_mode": "none"},
    {"source_id": "abcr", "sector": "TRANSPORTE", "card_css": "article.eael-grid-post", "title_css": "h2.eael-entry-title a",
     "link_css": "h2.eael-entry-title a[href]", "title_mode": "h1", "page_date_css": "time",
     "page_date_format": "month_first_pt"},
    {"source_id": "abr_aero_imprensa", "sector": "TRANSPORTE", "card_css": "div.tf-posts.grid > div.column", "title_css": "h2.title a",
     "link_css": "h2.title a[href]", "date_css": "li.post-date a", "date_format": "us", "title_mode": "h1"},
]


def rule_rows(spark: SparkSession, rules: list[dict] | None = None) -> DataFrame:
    """Rule rows as a table; missing fields are null."""
    chosen = LINK_RULES + CARD_RULES if rules is None else rules
    return spark.createDataFrame([[rule.get(f.name) for f in RULE] for rule in chosen], RULE)
