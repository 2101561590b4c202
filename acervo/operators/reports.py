"""Report tables: one row per fact, so no report line gathers a whole group."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions import score as S
from acervo.functions import text as X
from acervo.functions import urls as U


def covered_by_importance(sources: DataFrame, status: str, importance: str, name: str) -> DataFrame:
    """Covered sources, one row per name, with the level's order and count.

    Levels outside the fixed order follow it alphabetically.
    """
    covered = sources.filter(S.is_covered(F.col(status))).select(
        S.importance_or_default(F.col(importance)).alias("importance"), F.col(name).alias("name"))
    counts = covered.groupBy("importance").agg(F.count("*").alias("n_sources"))
    return covered.join(counts, "importance").withColumn("level_order", S.importance_rank(F.col("importance")))


def covered_first(sources: DataFrame, status: str, importance: str, position: str) -> DataFrame:
    """Report order: importance level, covered before uncovered, then position."""
    level = S.importance_or_default(F.col(importance))
    return sources.withColumns({
        "importance_shown": level, "level_order": S.importance_rank(level), "covered": S.is_covered(F.col(status)),
    }).orderBy("level_order", "importance_shown", F.desc("covered"), position)


def display_groups(sources: DataFrame, group: str, status: str, position: str) -> DataFrame:
    """Per display group: size, and the class of its first row's status."""
    shown = sources.filter(F.coalesce(F.trim(F.col(group)), F.lit("")) != "")
    return shown.groupBy(group).agg(
        F.count("*").alias("n_variants"), F.min_by(F.col(status), F.col(position)).alias("first_status"),
    ).withColumn("badge", S.status_class(F.col("first_status")))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def run_summary(outcomes: DataFrame, source: str, saved: str, error: str, order: str) -> DataFrame:
    """Saved documents per source, or the last error text."""
    return outcomes.groupBy(source).agg(
        F.count_if(F.col(saved)).alias("saved"),
        F.count_if(F.col(error).isNotNull()).alias("failed"),
        F.max_by(F.col(error), F.when(F.col(error).isNotNull(), F.col(order))).alias("last_error"))


def covered_but_never_ran(sources: DataFrame, status: str, last_run: str) -> DataFrame:
    return sources.filter(F.col(status).like("%Coberta%") & F.col(last_run).isNull())


def recent_runs(sources: DataFrame, last_run: str, tie: str, k: int = P.RECENT_RUNS) -> DataFrame:
    return sources.filter(F.col(last_run).isNotNull()).orderBy(F.desc(last_run), tie).limit(k)


def listing_profile(items: DataFrame, keys: list[str], url: str, title: str, published: str, category: str) -> DataFrame:
    def missing(name: str) -> Column:
        return F.count_if(F.coalesce(F.col(name).cast("string"), F.lit("")) == "")

    return items.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.countDistinct(url).alias("distinct_urls"),
        missing(published).alias("missing_date"), missing(title).alias("missing_title"),
        missing(url).alias("missing_url"), missing(category).alias("missing_category"),
        F.countDistinct(category).alias("distinct_categories"))


def type_frequency(df: DataFrame, kind: str) -> DataFrame:
    return df.groupBy(kind).agg(F.count("*").alias("n"))


def years_mentioned(pages: DataFrame, text: str) -> DataFrame:
    """Distinct years of DD/MM/YYYY dates, with the number of pages that hold them."""
    years = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(r"\d{2}/\d{2}/(\d{4})"), F.lit(1)))
    return pages.select(F.explode(years).alias("year")).groupBy("year").agg(F.count("*").alias("n_pages"))


def short_texts(df: DataFrame, text: str, minimum: int = P.MIN_TEXT_CHARS) -> DataFrame:
    return df.agg(F.count_if(F.length(text) < minimum).alias("n_short"), F.count("*").alias("n_texts"))


def extractors_agree(a: Column, b: Column, tolerance: int = 200) -> Column:
    return F.abs(F.length(a) - F.length(b)) < tolerance


def domain_groups(links: DataFrame, topic: str, url: str, position: str) -> DataFrame:
    """Per topic and domain: count and first URL in order."""
    return links.withColumn("domain", U.domain_or_unknown(F.col(url))).groupBy(topic, "domain").agg(
        F.count("*").alias("n_links"), F.min_by(F.col(url), F.col(position)).alias("first_url"))


def top_sources(citations: DataFrame, source: str, k: int = P.TOP_SOURCES) -> DataFrame:
    return citations.groupBy(source).agg(F.count("*").alias("n_citations")).orderBy(
        F.desc("n_citations"), source).limit(k)


def top_topics(topics: DataFrame, in_universe: str, relevance: str, n_sources: str, key: str,
               k: int = P.DIGEST_TOPICS) -> DataFrame:
    return topics.orderBy(F.desc(in_universe), F.desc(relevance), F.desc(n_sources), key).limit(k)


def page_blocks(pages: DataFrame, document: str, number: str, terms: str, text: str) -> DataFrame:
    """Kept pages as annotated blocks, one row per page, to be written in page order."""
    header = F.concat(F.lit("--- Página "), F.col(number).cast("string"), F.lit(" (termos: "),
                      F.array_join(terms, ", "), F.lit(") ---"))
    return pages.select(document, number, F.concat(header, F.lit("\n"), F.trim(F.col(text))).alias("block"))


def match_counts(mentions: DataFrame) -> DataFrame:
    return mentions.agg(
        F.count("*").alias("n_matches"), F.count_if(~F.col("suspect")).alias("n_confirmed"),
        F.count_if(F.col("suspect")).alias("n_suspect"))


def source_card(sources: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """Labelled non-blank fields of a source, one row per field."""
    listed = X.labelled_fields([(label, F.col(c)) for label, c in fields])
    return sources.select("*", F.posexplode(listed).alias("field_pos", "_f")).withColumns({
        "label": F.col("_f.label"), "value": F.col("_f.value")}).drop("_f")


def by_name(df: DataFrame, name: str) -> DataFrame:
    """All rows in the order of their names, over the whole table."""
    return df.orderBy(F.col(name).asc_nulls_first())


def inversions(df: DataFrame, name: str) -> DataFrame:
    """(n_rows, n_inversions): how many rows come after a row with a greater name, in the order the table stands in.

    Each partition is read once and hands on one row: its count, first and last
    name. The last names meet the next partition's first in an order over these
    few rows. A null name comes before all others.
    """
    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, bad, first, last, at = 0, 0, None, None, None
        for part in parts:
            for value, place in zip(part["name"], part["at"]):
                if n and (last or "") > (value or ""):
                    bad += 1
                first = value if n == 0 else first
                n, last, at = n + 1, value, place
        if n:
            yield pd.DataFrame({"at": [at], "n": [n], "bad": [bad], "first": [first], "last": [last]})

    borders = df.select(F.col(name).cast("string").alias("name"), F.spark_partition_id().alias("at")).mapInPandas(
        scan, "at int, n long, bad long, first string, last string")
    before = F.coalesce(F.lag("last").over(Window.orderBy("at")), F.lit(""))
    crossed = F.when(before > F.coalesce("first", F.lit("")), 1).otherwise(0)
    return borders.withColumn("crossed", crossed).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("bad") + F.col("crossed")), F.lit(0)).alias("n_inversions"))
