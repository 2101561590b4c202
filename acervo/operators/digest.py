"""Digest: applying selection and grouping replies, topic blocks, quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acervo.functions import replies as R
from acervo.operators.ordered import with_position


def numbered_items(items: DataFrame, partition: list[str], order: str) -> DataFrame:
    """Items with their 1-based list number and the id shown to the model (`A01`)."""
    numbered = with_position(items, partition, order, "_n")
    return numbered.withColumn("news_index", (F.col("_n") + 1).cast("int")).withColumn(
        "article_id", F.format_string("A%02d", F.col("news_index"))).drop("_n")


def apply_selection(numbered: DataFrame, replies: DataFrame, keys: list[str], reply: str) -> DataFrame:
    """Items picked by index, in the reply's priority order, each with its rationale."""
    schema = "selected_news array<struct<news_index: int, choice_rationale: string>>"
    picks = replies.select(*keys, F.posexplode(R.parse_reply(F.col(reply), schema)["selected_news"]).alias("priority", "p")).select(
        *keys, "priority", F.col("p.news_index").alias("news_index"), F.col("p.choice_rationale").alias("choice_rationale"))
    return numbered.join(picks, [*keys, "news_index"])


def apply_flags(items: DataFrame, reply: str) -> DataFrame:
    """Boolean form: one reply per item."""
    parsed = R.parse_reply(F.col(reply), "relevant_news boolean, choice_rationale string")
    return items.withColumn("_r", parsed).filter("_r.relevant_news").withColumn(
        "choice_rationale", F.col("_r.choice_rationale")).drop("_r")


def apply_grouping(numbered: DataFrame, replies: DataFrame, keys: list[str], reply: str) -> DataFrame:
    """Items joined to the subjects that list their id, ids exactly as written."""
    schema = "selected_news array<struct<news_index: array<string>, subject_name: string, subject_description: string>>"
    subjects = replies.select(*keys, F.posexplode(R.parse_reply(F.col(reply), schema)["selected_news"]).alias("subject_pos", "s"))
    members = subjects.select(*keys, "subject_pos", F.col("s.subject_name").alias("subject_name"),
                              F.col("s.subject_description").alias("subject_description"),
                              F.explode("s.news_index").alias("article_id"))
    return numbered.join(members, [*keys, "article_id"])


def partition_violations(numbered: DataFrame, grouped: DataFrame, keys: list[str]) -> DataFrame:
    """Items in no subject or in several."""
    counted = grouped.groupBy(*keys, "article_id").agg(F.countDistinct("subject_pos").alias("n_subjects"))
    return numbered.join(counted, [*keys, "article_id"], "left").withColumn(
        "n_subjects", F.coalesce("n_subjects", F.lit(0))).filter("n_subjects <> 1")


def topics(digests: DataFrame, key: str, markdown: str, structured_only: bool = False) -> DataFrame:
    """One row per topic block; `structured_only` keeps blocks with every weekly section."""
    rows = digests.select(key, F.posexplode(R.topic_blocks(F.col(markdown))).alias("topic_pos", "block")).withColumn(
        "parts", R.topic_parts(F.col("block")))
    block, parts = F.col("block"), F.col("parts")
    read = rows.withColumns({
        "title": R.topic_title(block), "sector": R.topic_sector(block), "impact": R.topic_impact(block),
        "summary": R.topic_summary(block), "bullets": R.topic_bullets(parts),
        "why": R.topic_why(parts), "triggers": R.topic_triggers(parts), "portfolio": R.topic_portfolio(parts),
        "source_urls": R.topic_source_urls(block), "citations_ok": R.citations_consistent(block),
    }).drop("parts")
    complete = (F.col("title").isNotNull() & F.col("sector").isNotNull() & F.col("impact").isNotNull()
                & (F.size("bullets") > 0) & (F.size("source_urls") > 0))
    return read.filter(complete) if structured_only else read.withColumn("structured", complete)


def with_roles(topic_rows: DataFrame, max_secondary_bullets: int = 2) -> DataFrame:
    """Position decides the role; secondary topics keep their first bullets."""
    role = F.when(F.col("topic_pos") == 0, "lead").otherwise("secondary")
    return topic_rows.withColumn("role", role).withColumn(
        "bullets", F.when(F.col("role") == "lead", F.col("bullets")).otherwise(F.slice("bullets", 1, max_secondary_bullets)))


def subject_violations(subjects: DataFrame, name: str, title: str, bullets: str) -> DataFrame:
    """Stated limits: subject name 3 to 8 words, title up to 8, three bullets of up to 18 words."""
    checks = [
        ("subject_words", ~R.word_count(F.col(name)).between(3, 8)),
        ("title_words", R.word_count(F.col(title)) > 8),
        ("bullet_count", F.size(bullets) > 3),
        ("bullet_words", F.exists(bullets, lambda b: R.word_count(b) > 18)),
    ]
    flags = F.array(*[F.when(broken, F.lit(code)) for code, broken in checks])
    return subjects.withColumn("violations", F.filter(flags, lambda f: f.isNotNull()))


def latest_config(names: DataFrame, name: str) -> DataFrame:
    """Highest configuration number, and the one a new file gets."""
    return names.agg(F.max(R.config_version(F.col(name))).alias("latest")).withColumn("next", F.coalesce("latest", F.lit(0)) + 1)
