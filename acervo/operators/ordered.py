"""Operators that depend on row order, in two levels.

A plain window puts all rows of a partition key into one task. Here an ordered
key is cut into blocks: the window runs inside (key, block), a summary of one
row per block carries the state across blocks. A hot key is spread over as many
tasks as it has blocks.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acervo import params as P

BLOCK = 100_000


def _split_points(df: DataFrame, order: str, max_blocks: int, rows_per_block: int) -> list[float]:
    """Equal-depth cut points of a numeric order key: at most `max_blocks` numbers."""
    n = df.select(F.count(order)).first()[0]
    blocks = min(max_blocks, -(-n // rows_per_block))
    if blocks <= 1:
        return []
    probabilities = [i / blocks for i in range(1, blocks)]
    return sorted(set(df.select(F.col(order).cast("double").alias("o")).approxQuantile("o", probabilities, 0.2 / blocks)))


def with_position(
    df: DataFrame, partition: list[str], order: str, name: str = "position",
    rows_per_block: int = BLOCK, max_blocks: int = 10_000,
) -> DataFrame:
    """0-based row position inside `partition`, ordered by a unique numeric column."""
    points = _split_points(df, order, max_blocks, rows_per_block)
    whole = Window.partitionBy(*partition) if partition else Window.partitionBy(F.lit(0))
    if not points:
        # the whole table fits one block, so a plain window is bounded
        return df.withColumn(name, (F.row_number().over(whole.orderBy(order)) - 1).cast("long"))
    ranged = Bucketizer(
        splits=[float("-inf"), *points, float("inf")], inputCol="_order", outputCol="_block",
    ).transform(df.withColumn("_order", F.col(order).cast("double"))).drop("_order")
    keys = [*partition, "_block"]
    counts = ranged.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = counts.select(*keys, F.coalesce(
        F.sum("_n").over(whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    return (
        ranged.withColumn("_rn", inside)
        .join(before, keys)
        .withColumn(name, (F.col("_rn") + F.col("_before")).cast("long"))
        .drop("_rn", "_before", "_block")
    )


def carry_forward(
    df: DataFrame, partition: list[str], position: str, columns: list[str], block: int = BLOCK,
) -> DataFrame:
    """Fill each column with its last non-null value at or before the row.

    `position` is a dense integer per partition. Blocks hold `block` positions.
    """
    return _fill(df, partition, position, columns, block, forward=True)


def carry_backward(
    df: DataFrame, partition: list[str], position: str, columns: list[str], block: int = BLOCK,
) -> DataFrame:
    """Fill each column with its first non-null value at or after the row."""
    return _fill(df, partition, position, columns, block, forward=False)


def _fill(df, partition, position, columns, block, forward):
    keys = [*partition, "_block"]
    blocked = df.withColumn("_block", F.floor(F.col(position) / F.lit(block)))
    inside = Window.partitionBy(*keys).orderBy(position)
    across = Window.partitionBy(*partition).orderBy("_block")
    if forward:
        inside = inside.rowsBetween(Window.unboundedPreceding, 0)
        across = across.rowsBetween(Window.unboundedPreceding, -1)
        within, edge = F.last, F.max_by
    else:
        inside = inside.rowsBetween(0, Window.unboundedFollowing)
        across = across.rowsBetween(1, Window.unboundedFollowing)
        within, edge = F.first, F.min_by
    # one row per block: its edge value, combined on the map side
    edges = blocked.groupBy(*keys).agg(*[
        edge(F.col(c), F.when(F.col(c).isNotNull(), F.col(position))).alias(f"_e_{c}") for c in columns
    ])
    carried = edges.select(
        *keys, *[within(F.col(f"_e_{c}"), ignorenulls=True).over(across).alias(f"_c_{c}") for c in columns]
    )
    filled = blocked.select(
        *df.columns, "_block",
        *[within(F.col(c), ignorenulls=True).over(inside).alias(f"_i_{c}") for c in columns],
    )
    return filled.join(carried, keys, "left").select(
        *[c for c in df.columns if c not in columns],
        *[F.coalesce(F.col(f"_i_{c}"), F.col(f"_c_{c}")).alias(c) for c in columns],
    )


def paging_stop(
    items: DataFrame, source: str, page: str, key: str, page_size: int, max_pages: int,
) -> DataFrame:
    """Items of the pages up to the stop.

    Paging ends with the first page shorter than `page_size`, before the first
    page that brings no key unseen on earlier pages, and at `max_pages`.
    Aggregates only: no source's pages meet in one task.
    """
    per_page = items.groupBy(source, page).agg(F.count("*").alias("_n"))
    first_seen = items.groupBy(source, key).agg(F.min(page).alias(page))
    fresh = first_seen.groupBy(source, page).agg(F.count("*").alias("_fresh"))
    judged = per_page.join(fresh, [source, page], "left")
    stops = judged.groupBy(source).agg(
        F.min(F.when(F.col("_n") < page_size, F.col(page))).alias("_short"),
        F.min(F.when(F.col("_fresh").isNull(), F.col(page))).alias("_stale"),
    )
    last = F.least(
        F.coalesce(F.col("_short"), F.lit(max_pages)),
        F.coalesce(F.col("_stale") - 1, F.lit(max_pages)),
        F.lit(max_pages),
    )
    return (
        items.join(stops.select(source, last.alias("_last")), source)
        .filter(F.col(page) <= F.col("_last")).drop("_last")
    )


def systematic_sample(
    docs: DataFrame, day: str, order: str, target: int = P.SAMPLE_SIZE, rows_per_block: int = BLOCK,
) -> DataFrame:
    """Every n-th document of each day, a quota per day, newest days first, cut to `target`.

    quota = max(1, half-even round of target·n/N), step = max(1, n div quota).
    """
    days = docs.groupBy(day).agg(F.count("*").alias("_n"))
    # days are few (one row each): the total and the running quota are windows over this summary
    everything = Window.partitionBy(F.lit(0))
    sized = days.withColumn("_total", F.sum("_n").over(everything))
    quota = F.greatest(F.lit(1), F.bround(F.lit(target) * F.col("_n") / F.col("_total"), 0).cast("long"))
    planned = (
        sized.withColumn("_quota", quota)
        .withColumn("_step", F.greatest(F.lit(1), F.floor(F.col("_n") / F.col("_quota"))))
        .withColumn("_taken", F.least(F.col("_quota"), F.ceil(F.col("_n") / F.col("_step"))))
        .withColumn("_before", F.coalesce(F.sum("_taken").over(
            everything.orderBy(F.desc(day)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    numbered = with_position(docs, [day], order, "_pos", rows_per_block)
    slot = F.floor(F.col("_pos") / F.col("_step"))
    return (
        numbered.join(planned.select(day, "_step", "_taken", "_before"), day)
        .filter((F.col("_pos") % F.col("_step") == 0) & (slot < F.col("_taken")))
        .withColumn("sample_position", (F.col("_before") + slot).cast("long"))
        .filter(F.col("sample_position") < target)
        .select(*docs.columns, "sample_position")
    )


def first_k(df: DataFrame, partition: list[str], order: list[Column], k: int) -> DataFrame:
    """First k rows per key. Spark limits each group in the map tasks before the shuffle."""
    spec = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(spec)).filter(F.col("_rn") <= k).drop("_rn")


def split_roles(df: DataFrame, partition: list[str], position: str) -> DataFrame:
    """`lead` for the first item of each partition, `secondary` for the others."""
    first = df.groupBy(*partition).agg(F.min(position).alias("_first"))
    return df.join(first, partition).withColumn(
        "role", F.when(F.col(position) == F.col("_first"), "lead").otherwise("secondary")
    ).drop("_first")
