"""Model replies: JSON text columns to typed columns, quality flags, digest grammar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions.text import let


def strip_fence(text: Column) -> Column:
    """Reply without a surrounding code fence."""
    opened = F.regexp_replace(_strip(text), r"^```(?:json)?\s*\n?", "")
    return _strip(F.regexp_replace(opened, r"\n?```\s*$", ""))


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def parse_reply(text: Column, schema: str) -> Column:
    """Struct of the reply, null where it is not valid JSON of an object."""
    cleaned = strip_fence(text)
    valid = F.json_object_keys(cleaned).isNotNull()
    return F.when(valid, F.from_json(cleaned, schema, {"mode": "PERMISSIVE"}))


def prompt_text(text: Column, limit: int = P.PROMPT_CHARS) -> Column:
    return F.substring(text, 1, limit)


def word_count(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"\s+")))


def _chars_between(text: Column, low: int, high: int) -> Column:
    """Whether the text has `low` to `high` characters; they are counted only where its bytes leave that open, a character having one to four."""
    octets = F.octet_length(text)
    return F.when((octets < low) | (octets > 4 * high), False).otherwise(F.length(text).between(low, high))


def violations(sentiment: Column, score: Column, tags: Column, summary: Column, rationale: Column) -> Column:
    """Names of the stated limits that a reply breaks."""
    sign = F.signum(score)
    checks = [
        ("sentiment_sign", ((sentiment == "positivo") & (sign <= 0)) | ((sentiment == "negativo") & (sign >= 0))),
        ("tag_count", ~F.size(tags).between(1, 4)),
        ("summary_length", ~_chars_between(summary, 300, 500)),
        ("rationale_words", word_count(rationale) > 12),
    ]
    flags = F.array(*[F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in checks])
    return F.filter(flags, lambda f: f.isNotNull())


# --- digest grammar -------------------------------------------------------

def topic_blocks(markdown: Column) -> Column:
    """Blocks of a digest, split at `---` lines."""
    return F.filter(
        F.transform(F.split(markdown, r"(?m)^---\s*$"), lambda b: _strip(b)), lambda b: b != ""
    )


def topic_title(block: Column) -> Column:
    return _or_null(F.trim(F.regexp_extract(block, r"(?m)^## (.+)$", 1)))


def topic_sector(block: Column) -> Column:
    named = F.trim(F.regexp_extract(block, r"(?m)^\*\*Setor:\*\*\s*(.+)$", 1))
    return F.when(named.isin(*P.SECTORS), named)


def topic_impact(block: Column) -> Column:
    return _or_null(F.regexp_extract(block, r"(?m)^(?:### Impacto Esperado:|\*\*Impacto:\*\*)\s*(Alto|Médio|Baixo)", 1))


def topic_summary(block: Column) -> Column:
    return _or_null(F.trim(F.regexp_extract(block, r"(?m)^\*\*Resumo Executivo\*\* - (.+)$", 1)))


def topic_parts(block: Column) -> Column:
    """What stands before the first heading, then each `### ` section and the sources, each from its heading on; one split."""
    return let(F.split(block, r"(?m)^(?=### |\*\*Fontes)"), lambda parts: F.when(
        F.get(parts, F.lit(0)).startswith("### ") | F.get(parts, F.lit(0)).startswith("**Fontes"), F.concat(F.array(F.lit("")), parts)).otherwise(parts))


def section_of(parts: Column, heading: str) -> Column:
    """Text below the first section of that heading; null without it."""
    return let(F.get(F.filter(parts, lambda p: p.startswith(f"### {heading}")), F.lit(0)), lambda part: F.when(
        part.isNotNull(), _strip(F.when(part.contains("\n"), F.substr(part, F.locate("\n", part) + 1)).otherwise(""))))


def dashes(text: Column) -> Column:
    """Its `- ` lines."""
    lines = F.split(text, r"\r\n|[\n\r\u0085\u2028\u2029]")
    return F.transform(F.filter(lines, lambda line: line.startswith("- ") & (F.length(line) > 2)), lambda line: F.trim(F.substr(line, F.lit(3))))


def topic_bullets(parts: Column) -> Column:
    """Fact bullets: of their section in the daily form, before the sources in the weekly one."""
    return dashes(F.coalesce(section_of(parts, "O que mudou"), F.get(parts, F.lit(0))))


def topic_why(parts: Column) -> Column:
    return _or_null(section_of(parts, "Por que importa"))


def topic_triggers(parts: Column) -> Column:
    return dashes(F.coalesce(section_of(parts, "Próximos Gatilhos"), F.lit("")))


def topic_portfolio(parts: Column) -> Column:
    """Positions named in the portfolio section: (position, text) of its `- **name** - text` lines."""
    lines = dashes(F.coalesce(section_of(parts, "Potencial Impacto na Carteira"), F.lit("")))
    read = F.transform(lines, lambda b: F.struct(F.regexp_extract(b, r"^\*\*(.+?)\*\*", 1).alias("position"),
                                                 F.trim(F.regexp_extract(b, r"^\*\*.+?\*\*\s*-\s*(.*)$", 1)).alias("text")))
    return F.filter(read, lambda r: r["position"] != "")


def topic_source_marks(block: Column) -> Column:
    return F.regexp_extract_all(block, F.lit(r"(?m)^\[(\d+)\] \S+"), F.lit(1))


def topic_source_urls(block: Column) -> Column:
    return F.regexp_extract_all(block, F.lit(r"(?m)^\[\d+\] (\S+)"), F.lit(1))


def impact_mark(rating: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in P.IMPACT_MARKS.items() for x in pair])
    return F.try_element_at(table, rating)


def bullet_dimension(bullet: Column) -> Column:
    """Code of the leading `[Tag]`, null if the tag is not one of the six."""
    table = F.create_map(*[F.lit(x) for pair in P.DIMENSION_CODES.items() for x in pair])
    return F.try_element_at(table, F.regexp_extract(bullet, r"^\[([^\]]+)\]", 1))


def bullet_text(bullet: Column) -> Column:
    return F.when(bullet_dimension(bullet).isNotNull(), F.regexp_replace(bullet, r"^\[[^\]]+\]\s*", "")).otherwise(bullet)


def cited_marks(block: Column) -> Column:
    """Numbers cited inside the text, source lines excluded."""
    body = F.regexp_replace(block, r"(?m)^\[\d+\] \S+.*$", "")
    return F.array_distinct(F.regexp_extract_all(body, F.lit(r"\[(\d+)\]"), F.lit(1)))


def citations_consistent(block: Column) -> Column:
    """Every mark has a source, every source a mark, sources count 1..n without a gap."""
    cited, listed = cited_marks(block), topic_source_marks(block)
    n = F.size(listed)
    numbered = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), lambda i: i.cast("string"))).otherwise(
        F.array().cast("array<string>"))
    return (
        (F.size(F.array_except(cited, listed)) == 0)
        & (F.size(F.array_except(listed, cited)) == 0)
        & (listed == numbered)
    )


def company_markers(text: Column) -> Column:
    """`{portfolio:Name (TICKER)}` marks as (name, ticker); the ticker may be null."""
    raw = F.regexp_extract_all(text, F.lit(r"\{portfolio:([^}]+)\}"), F.lit(1))
    return F.transform(
        raw,
        lambda m: F.struct(
            F.trim(F.regexp_replace(m, r"\s*\([^)]*\)\s*$", "")).alias("name"),
            _or_null(F.regexp_extract(m, r"\(([^)]*)\)\s*$", 1)).alias("ticker"),
        ),
    )


def section_key(heading: Column) -> Column:
    return F.translate(F.lower(F.trim(heading)), "ãáâçéêíóõú", "aaaceeioou")


def sections(text: Column) -> Column:
    """`## ` sections and their text, of a repeated heading the last; `# ` lines dropped, bracketed placeholders empty."""
    clean = F.regexp_replace(F.concat(F.lit("\n"), text), r"(?m)^# .*\n?", "")
    pieces = F.split(clean, r"\n## ")
    parts = F.slice(pieces, F.lit(2), F.size(pieces) - 1)
    entries = F.transform(
        parts,
        lambda p: F.struct(
            section_key(F.substring_index(p, "\n", 1)).alias("key"),
            _strip(F.when(p.contains("\n"), F.regexp_replace(p, r"^[^\n]*\n", "")).otherwise("")).alias("body"),
        ),
    )
    keys = F.transform(entries, lambda e: e["key"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e["key"]))
    return F.transform(
        last,
        lambda e: F.struct(
            e["key"].alias("key"),
            F.when(e["body"].startswith("(") & e["body"].endswith(")"), "").otherwise(e["body"]).alias("body"),
        ),
    )


def config_version(name: Column) -> Column:
    """N of `config_N.json`, null for any other name."""
    return F.regexp_extract(name, r"config_(\d+)\.json$", 1).try_cast("int")


def _or_null(text: Column) -> Column:
    return F.when(text != "", text)
