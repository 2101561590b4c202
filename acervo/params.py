"""Fixed values of the rule set, stated plainly.

These must equal the published rules for the results to agree; they are
parameters everywhere, this file only holds the defaults.
"""

# Lengths, windows, thresholds.
MIN_TEXT_CHARS = 200
MIN_SELECTOR_CHARS = 300
MIN_ARTICLE_CHARS = 500
MIN_PAGE_CHARS = 500
MIN_PAGE_ANCHORS = 3
PAYWALL_SCAN_CHARS = 1500
FEED_WINDOW_HOURS = 24
GAZETTE_WINDOW_DAYS = 31
RATINGS_WINDOW_DAYS = 7
WEEK_DAYS = 7
SAMPLE_SIZE = 120
SAMPLE_DAYS = 5
CLUSTER_COSINE = 0.85
CLUSTER_WINDOW_DAYS = 3
TITLE_RATIO = 0.55
FUZZY_RATIO = 0.85
SHORT_ALIAS_CHARS = 5
NAIVE_ALIAS_MIN_CHARS = 4
MONEY_THRESHOLD = 100_000_000
PROMPT_CHARS = 4000
EMBEDDING_CHARS = 8000
RECENT_RUNS = 20
DIGEST_TOPICS = 8
TOP_SOURCES = 5
MACRO_THEMES = 5
MACRO_SEED = 42
AREA = "Infra"

# Junk elements dropped before text extraction.
JUNK_TAGS = ["script", "style", "noscript", "iframe", "svg", "form",
             "nav", "header", "footer", "aside", "button"]

# Content selectors, tried in this order.
CONTENT_SELECTORS = ["#content-core", "#parent-fieldname-text", "#content", "main",
                     ".field--name-body", ".single_meta .blog_content", "#page-document",
                     ".entry-content", ".elementor-widget-theme-post-content",
                     ".td-post-content", ".artigo__texto"]

# Heading texts that are sections, not titles.
SECTION_HEADINGS = ["esg", "economia", "negócios"]

# Markers of text behind a subscription.
PAYWALL_MARKERS = [
    "para continuar lendo",
    "assine agora mesmo",
    "assine já",
    "conteúdo exclusivo para assinantes",
    "faça login para ler",
    "este conteúdo é para assinantes",
    "cadastre-se para continuar",
]

# Terms that make a gazette page relevant, in report order.
GAZETTE_TERMS = [
    "AGEMS", "saneamento", "energia elétrica", "tarifa", "concessão",
    "concessionária", "transporte rodoviário", "regulação", "regulatório",
    "distribuição de energia", "abastecimento de água", "esgotamento sanitário",
]

# Closed tag vocabulary and its critical subset.
TAG_VOCABULARY = [
    "fato_relevante", "comunicado_cvm", "resultado_trimestral",
    "emissao_debenture", "emissao_cri", "emissao_cra", "captacao",
    "m_a", "ipo", "follow_on",
    "rating_change",
    "default", "renegociacao", "recuperacao_judicial",
    "litigation", "regulatorio", "governanca",
    "guidance", "projeto_novo", "expansao", "desinvestimento",
    "esg", "safra", "lancamento",
]
CRITICAL_TAGS = ["fato_relevante", "rating_change", "m_a", "default", "litigation"]

# An amount in reais and its unit.
MONEY_PATTERN = r"(?iuU)R\$\s*([\d.,]+)\s*(milh[ãa]o|milh[õo]es|bilh[ãa]o|bilh[õo]es|\bmi\b|\bbi\b|\bmil\b)?"

# Money units after an amount in reais.
MONEY_UNITS = {
    "mil": 1_000.0,
    "mi": 1_000_000.0,
    "milhão": 1_000_000.0,
    "milhao": 1_000_000.0,
    "milhões": 1_000_000.0,
    "milhoes": 1_000_000.0,
    "bi": 1_000_000_000.0,
    "bilhão": 1_000_000_000.0,
    "bilhao": 1_000_000_000.0,
    "bilhões": 1_000_000_000.0,
    "bilhoes": 1_000_000_000.0,
}

# Month names.
MONTHS_PT = {
    "janeiro": 1, "fevereiro": 2, "março": 3, "marco": 3, "abril": 4,
    "maio": 5, "junho": 6, "julho": 7, "agosto": 8, "setembro": 9,
    "outubro": 10, "novembro": 11, "dezembro": 12,
}
MONTHS_SHORT = {
    "jan": 1, "fev": 2, "feb": 2, "mar": 3, "abr": 4, "apr": 4, "mai": 5, "may": 5,
    "jun": 6, "jul": 7, "ago": 8, "aug": 8, "set": 9, "sep": 9, "out": 10, "oct": 10,
    "nov": 11, "dez": 12, "dec": 12,
}

# Catalogue lookups.
IMPORTANCE_ORDER = ["Alta", "Média", "Media", "Baixa"]
IMPORTANCE_PRIORITY = {"Alta": 1, "Média": 2, "Media": 2, "Baixa": 3}
CATEGORY_SOURCE_TYPE = {
    "Diário Oficial": "regulatorio",
    "Agência Reguladora": "regulatorio",
    "Mídia": "noticia",
    "Mídia especializada": "noticia",
    "Associação": "doc_corporativo",
    "Consultoria": "blog",
    "Agência de Rating": "rating",
}
STATUS_OK = "Coberta e validada em produção"
STATUS_ERROR = "Erro"
UNKNOWN_SOURCE = "Desconhecida"
UNKNOWN_SECTOR = "Não classificado"

# Digest grammar.
SECTORS = ["Energia e Gás", "Saneamento", "Transporte", "Telecom",
           "Regulatório/Múltiplo", "Outros"]
DIMENSION_CODES = {"Regulatório": "reg", "Operacional": "op", "Leilão": "lei",
                   "Corporate": "corp", "Macro": "mac", "ESG": "esg"}
IMPACT_MARKS = {"Alto": "🔴", "Médio": "🟠", "Baixo": "🟢"}

# The source columns of a rating action row.
RATING_COLUMNS = [
    "ratingActionDate", "actionTypeCode", "entityId", "sourceProvidedName",
    "actionLevelIndicator", "actionName", "sectorCode", "class", "ratingFrom",
    "ratingTo", "cwolFrom", "cwolTo", "ratingType", "maturityDate",
]
RATING_KEY = ["entityId", "ratingActionDate", "ratingType", "class", "ratingTo", "actionName"]

# Creditor sentiments.
SENTIMENTS = ["positivo", "neutro", "negativo"]

# Texts that mark a challenge page and a broken page.
CHALLENGE_MARKERS = ["Pardon Our Interruption", "reeseSkipExpirationCheck"]
BROKEN_MARKERS = ["lrpError", "Configura"]

# Relevance weights.
WEIGHT_PRIORITY, WEIGHT_PORTFOLIO, WEIGHT_MONEY, WEIGHT_TAGS = 0.30, 0.35, 0.15, 0.20
