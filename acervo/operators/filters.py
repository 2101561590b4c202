"""Row filters and page classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions import dates as D
from acervo.functions import text as X


def long_enough(df: DataFrame, text: str = "text", minimum: int = P.MIN_TEXT_CHARS) -> DataFrame:
    return df.filter(F.length(text) >= minimum)


def readable(df: DataFrame, text: str = "text", markers: list[str] | None = None) -> DataFrame:
    """Without text behind a subscription; a null text is not readable."""
    return df.filter(F.col(text).isNotNull() & ~X.looks_paywalled(F.col(text), markers))


def fresh(df: DataFrame, published: str, as_of: Column, hours: int = P.FEED_WINDOW_HOURS) -> DataFrame:
    return df.filter(D.within_hours(F.col(published), as_of, hours))


def in_category(df: DataFrame, tags: str, feed_type: str, label: str, general: str = "general") -> DataFrame:
    """Items of the general feed need a tag with the label; a dedicated feed passes whole."""
    wanted = X.fold_lower(F.lit(label))
    tagged = F.exists(F.col(tags), lambda t: X.fold_lower(t).contains(wanted))
    return df.filter((F.col(feed_type) != general) | F.coalesce(tagged, F.lit(False)))


def with_required(df: DataFrame, columns: list[str]) -> DataFrame:
    complete = F.lit(True)
    for c in columns:
        complete = complete & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return df.filter(complete)


def missing_required(df: DataFrame, columns: list[str]) -> Column:
    """Aggregate: rows without one of the columns."""
    broken = F.lit(False)
    for c in columns:
        broken = broken | (F.coalesce(F.col(c).cast("string"), F.lit("")) == "")
    return F.count_if(broken)


def anchor_count(html: Column) -> Column:
    return F.regexp_count(html, F.lit("<a "))


def is_listing(html: Column, minimum: int = P.MIN_PAGE_ANCHORS) -> Column:
    return anchor_count(html) >= minimum


def response_class(body: Column) -> Column:
    """`waf` before `broken` before `ok`."""
    broken = F.lit(True)
    for marker in P.BROKEN_MARKERS:
        broken = broken & body.contains(marker)
    return (F.when(X.contains_any(body, P.CHALLENGE_MARKERS), "waf").when(broken, "broken").otherwise("ok"))


def acceptable_page(status: Column, body: Column, minimum: int = P.MIN_PAGE_CHARS) -> Column:
    return F.coalesce((status == 200) & (F.length(body) > minimum), F.lit(False))


def published_items(df: DataFrame, as_of: Column, status: str, publish: str, expiry: str,
                    approved: str = "Aprovado", term: str | None = None, term_value: str | None = None) -> DataFrame:
    """Approved, already published, not expired, optionally of one taxonomy term."""
    shown = (F.col(status) == approved) & (F.col(publish) <= as_of) & (
        F.col(expiry).isNull() | (F.col(expiry) >= as_of))
    if term:
        shown = shown & (F.col(term) == term_value)
    return df.filter(shown)


def keyword_pages(pages: DataFrame, text: str, terms: list[str] | None = None) -> DataFrame:
    """Pages that hold a term; the matched terms in list order."""
    return pages.withColumn("terms", X.matched_terms(F.col(text), terms)).filter(F.size("terms") > 0)


def edition_of_day(links: DataFrame, partition: list[str], href: str, position: str, target: Column) -> DataFrame:
    """First link per listing whose file name carries the target date."""
    from acervo.operators.dedup import first_wins

    dated = links.withColumn("edition_date", D.underscore_file_date(F.col(href)))
    return first_wins(dated.filter(F.col("edition_date") == target), partition, [F.col(position)])


def full_editions(pages: DataFrame, html: str, target: Column) -> DataFrame:
    """Distinct full-edition files named in a page, of the target date."""
    names = pages.select(F.explode(F.array_distinct(D.dotted_edition_dates(F.col(html)))).alias("file")).distinct()
    return names.withColumn("edition_date", D.dotted_file_date(F.col("file"))).filter(F.col("edition_date") == target)
