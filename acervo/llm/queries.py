"""Registered queries of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.llm import oracles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op9_bpe")
def op9(spark, sf_dir):
    from acervo.llm.bpe import encoded, vocabulary_path
    return encoded(table(spark, sf_dir, "documents"), vocabulary_path(spark))


@query("op8_decontamination", oracles.OP8)
def op8(spark, sf_dir):
    from acervo.llm.decontamination import benchmark_spans, span_length
    found = benchmark_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", span_length().alias("n_hit"),
                        F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


@query("op1_sharding")
def op1(spark, sf_dir):
    from acervo.llm.sharding import interleaved
    dealt = interleaved(table(spark, sf_dir, "documents"))
    return dealt.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


@query("op4_nearest", oracles.OP4)
def op4(spark, sf_dir):
    from acervo.llm.neighbours import nearest
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query("op5_language")
def op5(spark, sf_dir):
    from acervo.llm.language import fit, identified, remainder, vocabulary_path
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(remainder() != 1), vocabulary_path(spark))
    found = identified(docs, model)
    return found.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op6_warc", oracles.OP6)
def op6(spark, sf_dir):
    from acervo.llm.archives import converted
    return converted(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_secrets")
def op3(spark, sf_dir):
    from acervo.llm.bpe import vocabulary_path
    from acervo.llm.secrets import scanned, trained
    docs = table(spark, sf_dir, "documents")
    forest, dictionary = trained(spark, docs, vocabulary_path(spark))
    found = scanned(docs, forest, dictionary)
    return found.select("doc_id", F.size("findings").cast("bigint").alias("n_candidates"),
                        F.filter("findings", lambda f: f["secret"]).alias("secrets"),
                        F.sha2(F.coalesce("redacted", F.lit("")).cast("binary"), 256).alias("redacted_sha256"))


@query("op2_neardup", oracles.OP2)
def op2(spark, sf_dir):
    from acervo.llm.neardup import classes
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


@query("op7_substrings", oracles.OP7)
def op7(spark, sf_dir):
    from acervo.llm.substrings import deduplicated
    return deduplicated(table(spark, sf_dir, "documents"))


@query("op10_suffixes", oracles.OP10)
def op10(spark, sf_dir):
    from acervo.llm.suffixes import deduplicated
    return deduplicated(table(spark, sf_dir, "documents"))


@query("op11_topk", oracles.OP11)
def op11(spark, sf_dir):
    from acervo.llm.topk import highest
    vectors = table(spark, sf_dir, "embeddings")
    return highest(vectors, vectors.where("vec_id % 50 = 0"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of conversations with faults planted by crc32 of `conv_id:turn`; a null is one blank."""
    def plain(column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(plain("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text")).alias("text"),
        kind.alias("kind")).where("kind <> 0")
    return rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))


@query("op12_repair", oracles.OP12)
def op12(spark, sf_dir):
    from acervo.llm.repair import digests, repaired
    conversations = table(spark, sf_dir, "conversations")
    report, turns = repaired(damaged(conversations))
    found = report.join(digests(turns).withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c"))).withColumnRenamed("conv_id", "r")
    every = conversations.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("r")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text of all documents; where crc32(doc_id) says so, a tail of the words repeats with a period.

    Other texts stay as they are; a null doc_id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words):
        n = F.size(words)
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.when(n == 0, "").otherwise(F.array_join(F.transform(
            F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " "))

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, F.transform(F.array(words), planted)[0]).otherwise(F.col("text")).alias("text"))


@query("op13_runs", oracles.OP13)
def op13(spark, sf_dir):
    from acervo.llm.runs import periodic_runs
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    longest = F.aggregate("runs", F.expr("struct(0L AS start, 0L AS length, 0L AS period)"), lambda best, r: F.when(r.length > best.length, r).otherwise(best))
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")))
    some = found.withColumn("best", F.when(F.size("runs") > 0, longest))
    return some.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
