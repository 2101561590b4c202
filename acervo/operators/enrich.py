"""Enrichment: replies, lookups, scores and the assembled record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions import replies as R
from acervo.functions import score as S
from acervo.functions import urls as U

REPLY_SCHEMAS = {
    "summary": "summary string",
    "sentiment": "sentiment string, sentiment_score string, justificativa string",
    "tags": "tags array<string>, tag_sugerida_fora_do_vocabulario string",
    "entities": "entities_mentioned array<struct<name: string, context: string>>",
}


def parsed_replies(replies: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document with a struct per task; null where the reply is missing or invalid.

    A document has one reply per task, so the grouped rows are few and small.
    """
    return replies.groupBy(key).agg(*[
        R.parse_reply(F.max(F.when(F.col("task") == task, F.col("raw"))), schema).alias(task)
        for task, schema in REPLY_SCHEMAS.items()
    ])


def invalid_replies(replies: DataFrame, key: str = "doc_id") -> DataFrame:
    """Replies that are not a JSON object: the quarantine table."""
    return replies.filter(F.json_object_keys(R.strip_fence(F.col("raw"))).isNull()).select(key, "task", "raw")


def embedding_text(title: Column, summary: Column) -> Column:
    """Title and summary on two lines; the title alone without a summary."""
    both = F.btrim(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(summary, F.lit(""))), F.lit(" \n\t"))
    return F.substring(F.when(both != "", both).otherwise(F.coalesce(title, F.lit(""))), 1, P.EMBEDDING_CHARS)


def apply_model(df: DataFrame, model: Callable[[DataFrame], DataFrame], key: str = "doc_id") -> DataFrame:
    """Hook for a model supplied by the caller: a DataFrame in, its reply columns out, joined by key."""
    return df.join(model(df), key, "left")


def with_amounts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Whether each text names a relevant amount, in place of the text: done before any join, so that texts are not shuffled."""
    return docs.withColumn("relevant_amount", S.has_relevant_amount(F.col(text))).drop(text)


def scored(df: DataFrame, text: str | None, tags: str, risks: str, level: str = "priority") -> DataFrame:
    """Relevance score and its auditable explanation; without `text`, amounts are told by `relevant_amount`."""
    staged = df.withColumns({
        "_n": S.portfolio_count(F.col(risks)),
        "_money": S.has_relevant_amount(F.col(text)) if text else F.col("relevant_amount"),
        "_critical": S.critical_tags(F.col(tags)),
    })
    with_score = staged.withColumn(
        "relevance_score", S.relevance_score(F.col(level), F.col("_n"), F.col("_money"), F.col("_critical")))
    return with_score.withColumn("relevance_rationale", S.relevance_rationale(
        F.col(level), F.col("_n"), F.col("_money"), F.col("_critical"), F.col("relevance_score"))).drop("_n", "_money", "_critical")


def enriched_records(docs: DataFrame, replies: DataFrame, risks: DataFrame, captured_at: Column,
                     random_ids: bool = False) -> DataFrame:
    """The 24-field record of every document whose replies are all usable.

    `docs` carries `relevant_amount` (`with_amounts`), the source lookup and cluster columns,
    `replies` the structs of `parsed_replies`, `risks` the resolved mentions per document.
    """
    usable = replies.filter("tags is not null and sentiment is not null and entities is not null and summary is not null")
    joined = docs.join(usable, "doc_id").join(risks, "doc_id", "left")
    none = F.array().cast("array<struct<name:string,canonical_id:string,in_universe:boolean>>")
    ready = joined.withColumns({
        "_risks": F.coalesce("credit_risks", none),
        "_tags": S.allowed_tags(F.coalesce("tags.tags", F.array().cast("array<string>"))),
    })
    done = scored(ready, None, "_tags", "_risks")
    return done.select(
        (F.expr("uuid()") if random_ids else F.md5(F.col("doc_id").cast("string"))).alias("id"),
        "cluster_id", "source_id", "source_name", U.root(F.col("url")).alias("source_url"), "source_type",
        "title", "url",
        F.coalesce(F.nullif(F.col("published_at"), F.lit("")), F.nullif(F.col("date"), F.lit("")), F.lit("")).alias("published_at"),
        captured_at.alias("captured_at"), F.lit("pt").alias("language"), F.lit(P.AREA).alias("area"), "subarea", "priority",
        F.col("_risks").alias("credit_risks"), F.coalesce("summary.summary", F.lit("")).alias("summary"),
        S.clean_sentiment(F.col("sentiment.sentiment")).alias("sentiment"),
        S.clean_sentiment_score(F.col("sentiment.sentiment_score")).alias("sentiment_score"),
        "relevance_score", "relevance_rationale", F.col("_tags").alias("tags"),
        F.col("tags.tag_sugerida_fora_do_vocabulario").alias("suggested_tag"), "cluster_size", "cluster_sources",
    )
