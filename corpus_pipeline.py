"""The corpus pipeline: documents in, cleaned and tokenised documents out.

Every stage takes what its predecessor kept, with the columns of `documents`; n_chars follows the text. Rows that repeat,
null columns and empty tables pass as the operators say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.llm import bpe, decontamination, language, neardup, secrets
from acervo.llm.common import staged

LEAST_SHARE = 0.5


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _packed(docs: DataFrame) -> DataFrame:
    """text, doc_id, source, and every other column in one, numbered, so that no name can meet an operator's own or break a schema."""
    others = [c for c in docs.columns if c != "text"]
    return docs.select(F.struct(*[F.col(_quoted(c)).alias(f"c{i}") for i, c in enumerate(others)]).alias("_row"), "text", "doc_id", "source")


def _unpacked(found: DataFrame, like: DataFrame, changed: Column | None = None) -> DataFrame:
    """The columns of `like` again; n_chars is counted anew where the text has changed."""
    others = [c for c in like.columns if c != "text"]
    columns = {c: F.col("text") if c == "text" else F.col(f"_row.c{others.index(c)}") for c in like.columns}
    if changed is not None and "n_chars" in columns:
        columns["n_chars"] = F.when(changed, F.length("text")).otherwise(columns["n_chars"]).cast("bigint")
    return found.select(*[value.alias(c) for c, value in columns.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay: those without letters, or with no language at half the probability, go."""
    model = language.fit(docs.where(language.remainder() != 1), language.vocabulary_path(spark))
    found = language.identified(_packed(docs), model, keep=("_row", "text"))
    return _unpacked(found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the smallest doc_id."""
    return neardup.deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark windows are cut out of the texts; documents without any stay as they are."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.benchmark_spans(_packed(docs), items, keep=("_row",), clean=True)
    return _unpacked(found, docs, F.size("spans") > 0)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; documents without any stay as they are."""
    forest, dictionary = secrets.trained(spark, docs, bpe.vocabulary_path(spark))
    found = secrets.scanned(_packed(docs), forest, dictionary, keep=("_row",)).withColumnRenamed("redacted", "text")
    return _unpacked(found, docs, F.exists("findings", lambda f: f["secret"]))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the texts' token ids, and the digests of the ids and of what they decode to."""
    return bpe.encoded(docs, bpe.vocabulary_path(spark), keep=("doc_id", "source"), ids=True)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mask_secrets", mask_secrets), ("tokenize", tokenize)]

#: Learned models, signatures and merges cannot be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
