"""Proportional stratified interleaving: every shard holds the sources in the corpus's own proportions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo.session import cut_lineage


def _ranked(rows: DataFrame, group: list[str], place: Column, order: list[str], size: Column, name: str) -> DataFrame:
    """Rank rows 0.. within each group by `order`; `place` in [0, 1) rises with the order.

    Two levels: rows are numbered inside blocks of the order, blocks carry the count of all before them. A group of
    `size` rows has about as many blocks as a block has rows, so no group is gathered and no list of blocks is long.
    """
    blocks = F.ceil(F.sqrt(size))
    cut = rows.withColumn("_block", F.least((place * blocks).cast("bigint"), blocks - 1))
    sizes = cut.groupBy(*group, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_block").alias("_b"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)] + [F.col("_block") == F.col("_b")]
    numbered = cut.withColumn("_at", F.row_number().over(Window.partitionBy(*group, "_block").orderBy(*order)))
    return numbered.join(starts, on=same, how="inner").withColumn(name, F.col("_start") + F.col("_at") - 1).drop(
        "_block", "_b", "_start", "_at", *[f"_g{i}" for i in range(len(group))])


def interleaved(docs: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """Deal all rows into shards whose counts differ by one at most and whose mixture of sources is the corpus's.

    Rows of a source are shuffled by a seeded hash of id and text and ranked; the rank's middle as a share of the source
    is the row's place; rows are ordered by place (ties: hash, then id) and cut into `shards` runs of equal count.
    Columns: doc_id, source, size (UTF-8 bytes of the text plus 1; null text: 1), text_crc32, shard, slot (0.. within
    the shard, in order). Null ids and sources are values like any other (one source of null); repeated rows are all
    dealt; an empty table gives no row; further columns play no part. Rows alike in id, source and text are
    interchangeable. Only these narrow columns are shuffled; texts are read once.
    """
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    narrow = cut_lineage(docs.select(
        "doc_id", "source", (F.length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), raw).alias("_hash")))
    total = narrow.count()
    counts = narrow.groupBy("source").agg(F.count("*").alias("_of")).withColumnRenamed("source", "_s")
    shuffled = narrow.join(counts, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    share = F.col("_hash") / F.lit(2.0 ** 64) + 0.5
    ranked = _ranked(shuffled, ["source"], share, ["_hash", "doc_id", "size", "text_crc32"], F.col("_of"), "_rank")
    placed = ranked.withColumn("_place", (F.col("_rank") + 0.5) / F.col("_of"))
    ordered = _ranked(placed.withColumn("_all", F.lit(0)), ["_all"], F.col("_place"),
                      ["_place", "_hash", "source", "doc_id", "size", "text_crc32"], F.lit(total), "_position")
    # whole numbers throughout: row p stands in shard p * shards div total, which begins at ceil(shard * total / shards)
    shard = F.expr(f"cast(_position * {shards}L div {max(1, total)}L as int)")
    first = F.expr(f"(cast(_position * {shards}L div {max(1, total)}L as bigint) * {total}L + {shards - 1}L) div {shards}L")
    return ordered.select("doc_id", "source", "size", "text_crc32", shard.alias("shard"),
                          (F.col("_position") - first).cast("bigint").alias("slot"))
