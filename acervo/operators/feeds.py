"""Feed items: combination, fallback, rating actions, JSON listings, search hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions import text as X
from acervo.operators.dedup import first_wins_keep_null, last_wins


def combine_feeds(items: DataFrame, source: str, link: str, order: list[Column]) -> DataFrame:
    """First item per link over all feeds of a source; items without a link all stay."""
    return first_wins_keep_null(items, link, [source], order)


def active_feed(items: DataFrame, source: str, candidate: str) -> DataFrame:
    """Items of the first candidate feed that has any, per source."""
    first = items.groupBy(source).agg(F.min(candidate).alias("_active"))
    return items.join(first, source).filter(F.col(candidate) == F.col("_active")).drop("_active")


def sources_without_feed(sources: DataFrame, items: DataFrame, source: str) -> DataFrame:
    return sources.join(items.select(source).distinct(), source, "left_anti")


def rating_actions(items: DataFrame) -> DataFrame:
    """The fourteen named columns, missing as empty text, and the synthetic id."""
    present = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in items.columns else F.lit("").alias(c)
               for c in P.RATING_COLUMNS]
    named = items.select(*present)
    return named.withColumn("synthetic_id", X.synthetic_key(*[F.col(c) for c in P.RATING_KEY])).select(
        "synthetic_id", *P.RATING_COLUMNS)


def odata_items(payloads: DataFrame, payload: str, page_url: str) -> DataFrame:
    """Items of `d.results`, publication date cut to the day, URL built from the id."""
    schema = "d struct<results: array<struct<Id: string, Title: string, Subtitle: string, PublishDate: string>>>"
    return payloads.select(F.explode(F.from_json(payload, schema)["d"]["results"]).alias("r")).select(
        F.col("r.Id").alias("id"), F.col("r.Title").alias("title"), F.col("r.Subtitle").alias("subtitle"),
        F.substring("r.PublishDate", 1, 10).alias("published_at"), F.concat(F.lit(page_url), F.col("r.Id")).alias("url"))


def search_items(payloads: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """Items of a JSON search listing; bad JSON gives no rows."""
    schema = "items array<struct<title: string, `@id`: string, effective: string>>"
    return payloads.select(*keys, F.posexplode(F.from_json(payload, schema)["items"]).alias("pos", "i")).select(
        *keys, "pos", F.col("i.title").alias("title"), F.col("i.`@id`").alias("url"),
        F.substring("i.effective", 1, 10).alias("published_at"))


def block_text(blocks: Column, order: Column, kind: str = "slate") -> Column:
    """Texts of the blocks of one kind in the order of the id list, joined by a blank line."""
    texts = F.transform(order, lambda k: F.when(F.try_element_at(blocks, k)["type"] == kind,
                                                F.try_element_at(blocks, k)["plaintext"]))
    return F.array_join(F.filter(texts, lambda t: F.coalesce(F.trim(t), F.lit("")) != ""), "\n\n")


def newest_items(items: DataFrame, partition: list[str], order: list[Column], k: int) -> DataFrame:
    """At most k newest items per source."""
    from acervo.operators.ordered import first_k

    return first_k(items, partition, order, k)


def expand_queries(queries: DataFrame, hits: DataFrame, query: str) -> DataFrame:
    """Hits of every distinct query text; repeated queries count once."""
    return hits.join(queries.select(query).distinct(), query)


def last_hit_wins(hits: DataFrame, domain: str, title: str, order: list[Column]) -> DataFrame:
    """Hits with the same domain and title overwrite each other."""
    return last_wins(hits, [domain, title], order)
