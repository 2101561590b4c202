"""Score and lookup expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions.text import let


def round_exact(value: Column, digits: int) -> Column:
    """Half-even on the exact binary value.

    `bround` works on the shortest decimal text, where 0.4425 is a tie; the
    double itself lies off it. The distance to the tie is computed without
    rounding error by splitting the value into two short halves.
    """
    scale = float(10 ** digits)

    def rounded(x: Column) -> Column:
        a = F.abs(x)
        high = a * 134217729.0 - (a * 134217729.0 - a)
        k = F.floor(a * scale).cast("double")
        off = (high * (2 * scale) - (2 * k + 1)) + (a - high) * (2 * scale)
        up = (off > 0) | ((off == 0) & (k % 2 == 1))
        size = (k + F.when(up, 1.0).otherwise(0.0)) / scale
        return F.when(x < 0, -size).otherwise(size)

    return let(value.cast("double"), rounded)


def _literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def has_relevant_amount(text: Column, threshold: float = P.MONEY_THRESHOLD) -> Column:
    """Any amount in reais, times its unit, at or above the threshold."""
    units = _literal_map(P.MONEY_UNITS)
    numbers = F.regexp_extract_all(text, F.lit(P.MONEY_PATTERN), F.lit(1))
    names = F.regexp_extract_all(text, F.lit(P.MONEY_PATTERN), F.lit(2))
    values = F.zip_with(
        numbers, names,
        lambda n, u: F.replace(F.replace(n, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")
        * F.coalesce(F.try_element_at(units, F.lower(u)), F.lit(1.0)),
    )
    found = F.exists(values, lambda v: F.coalesce(v >= F.lit(float(threshold)), F.lit(False)))
    # the cheap test keeps the two regex passes off texts without an amount
    return F.when(F.contains(F.coalesce(text, F.lit("")), F.lit("$")), found).otherwise(F.lit(False))


def priority(importance: Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(P.IMPORTANCE_PRIORITY), importance), F.lit(3))


def source_type(category: Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(P.CATEGORY_SOURCE_TYPE), category), F.lit("noticia"))


def portfolio_count(risks: Column) -> Column:
    return F.coalesce(F.size(F.filter(risks, lambda r: r["in_universe"])), F.lit(0))


def priority_weight(level: Column) -> Column:
    return F.when(level == 1, 1.0).when(level == 2, 0.6).otherwise(0.3)


def portfolio_weight(count: Column) -> Column:
    return F.when(count == 0, 0.0).when(count == 1, 0.5).when(count <= 3, 0.75).otherwise(1.0)


def critical_tags(tags: Column) -> Column:
    """Sorted critical tags among the tags."""
    listed = F.coalesce(tags, F.array().cast("array<string>"))
    return F.array_sort(F.array_intersect(F.array(*[F.lit(t) for t in P.CRITICAL_TAGS]), listed))


def relevance_score(level: Column, n_portfolio: Column, has_amount: Column, critical: Column) -> Column:
    total = (
        F.lit(P.WEIGHT_PRIORITY) * priority_weight(level)
        + F.lit(P.WEIGHT_PORTFOLIO) * portfolio_weight(n_portfolio)
        + F.lit(P.WEIGHT_MONEY) * F.when(has_amount, 1.0).otherwise(0.0)
        + F.lit(P.WEIGHT_TAGS) * F.when(F.size(critical) > 0, 1.0).otherwise(0.0)
    )
    return round_exact(F.least(F.lit(1.0), total), 3)


def relevance_rationale(level: Column, n_portfolio: Column, has_amount: Column, critical: Column,
                        score: Column) -> Column:
    def number(value: Column) -> Column:
        return value.cast("string")

    flag = F.when(has_amount, F.lit("True")).otherwise(F.lit("False"))
    listed = F.concat(F.lit("["), F.array_join(F.transform(critical, lambda t: F.concat(F.lit("'"), t, F.lit("'"))), ", "), F.lit("]"))
    return F.concat(
        F.lit("prioridade_fonte="), level.cast("string"), F.lit("(peso "), number(priority_weight(level)), F.lit(") x0.30 + portfolio="),
        n_portfolio.cast("string"), F.lit(" empresa(s)(peso "), number(portfolio_weight(n_portfolio)),
        F.lit(") x0.35 + valor_monetario_relevante="), flag, F.lit("(peso "),
        number(F.when(has_amount, 1.0).otherwise(0.0)), F.lit(") x0.15 + tags_criticas="), listed, F.lit("(peso "),
        number(F.when(F.size(critical) > 0, 1.0).otherwise(0.0)), F.lit(") x0.20 = "), number(score),
    )


def allowed_tags(tags: Column, vocabulary: list[str] | None = None) -> Column:
    words = F.array(*[F.lit(t) for t in vocabulary or P.TAG_VOCABULARY])
    return F.filter(tags, lambda t: F.array_contains(words, t))


def rejected_tags(tags: Column, vocabulary: list[str] | None = None) -> Column:
    words = F.array(*[F.lit(t) for t in vocabulary or P.TAG_VOCABULARY])
    return F.filter(tags, lambda t: ~F.array_contains(words, t))


def clean_sentiment(value: Column) -> Column:
    return F.when(value.isin(*P.SENTIMENTS), value).otherwise(F.lit("neutro"))


def clean_sentiment_score(value: Column) -> Column:
    """Number in [-1, 1], three decimals; anything unreadable counts as 0."""
    number = F.coalesce(value.try_cast("double"), F.lit(0.0))
    return round_exact(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), number)), 3)


def status_class(status: Column) -> Column:
    s = F.lower(F.coalesce(status, F.lit("")))
    return (
        F.when(s.contains("validada em produção") | s.contains("coberta indiretamente"), "badge-ok")
        .when(s.contains("erro") | s.contains("bloquead"), "badge-erro")
        .when(s.contains("descartada"), "badge-descartada")
        .otherwise("badge-medio")
    )


def is_covered(status: Column) -> Column:
    return status_class(status) == "badge-ok"


def importance_rank(importance: Column, order: list[str] | None = None) -> Column:
    """Position in the fixed order, unknown values after it."""
    at = F.array_position(F.array(*[F.lit(x) for x in order or P.IMPORTANCE_ORDER]), importance)
    return F.when(at > 0, at).otherwise(F.lit(99)).cast("int")


def importance_or_default(importance: Column) -> Column:
    blank = F.coalesce(F.trim(importance), F.lit("")) == ""
    return F.when(blank, F.lit("Baixa")).otherwise(importance)
