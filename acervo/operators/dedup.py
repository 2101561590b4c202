"""First-wins, last-wins, anti-join and duplicate reports.

All of them aggregate instead of ranking in a window: a grouped minimum is
combined on the map side, so a key that owns a third of the rows reaches its
reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _winner(df: DataFrame, keys: list[str], order: list[Column], pick) -> DataFrame:
    """The payload goes along with the winner and is not compared, so it may hold maps."""
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.dropDuplicates(keys)
    row = F.struct(*[F.col(f"`{c}`") for c in payload])
    ranks = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    best = df.groupBy(*keys).agg(pick(row, ranks).alias("_w"))
    return best.select(*keys, *[F.col(f"_w.`{c}`").alias(c) for c in payload]).select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in `order` (which must be unique within a key)."""
    return _winner(df, keys, order, F.min_by)


def last_wins(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return _winner(df, keys, order, F.max_by)


def first_wins_keep_null(df: DataFrame, key: str, partition: list[str], order: list[Column]) -> DataFrame:
    """First-wins on `key`, rows without a key all kept; one pass over the input.

    A row without a key is its own group, told apart by its order.
    """
    slotted = df.withColumn("_slot", F.when(F.col(key).isNull(), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])))
    return first_wins(slotted, [*partition, key, "_slot"], order).drop("_slot")


def new_items(items: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Items whose key is not in the manifest."""
    return items.join(manifest.select(*keys).distinct(), keys, "left_anti")


def new_wide_items(items: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """The same for rows with a large payload.

    The manifest, which only grows, meets the keys alone; the payload is then
    filtered by the new keys, few enough in a daily run to be broadcast. Items
    with a null in their key are never in the manifest and stay, as in new_items().
    """
    if manifest.isEmpty():  # a first run: everything is new
        return items
    fresh = new_items(items.select(*keys).distinct(), manifest, keys)
    fresh = fresh.select(*[F.col(k).alias(f"_new{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_new{i}")) for i, k in enumerate(keys)]
    return items.join(fresh, same, "left_semi")


def extend_manifest(manifest: DataFrame, accepted: DataFrame, keys: list[str], dismissed: DataFrame | None = None) -> DataFrame:
    """Seen keys after a run, each once. `dismissed` are items turned down for good (the portfolio gate, an empty
    edition): they count as seen, so later runs do not read them again."""
    seen = manifest.select(*keys).unionByName(accepted.select(*keys))
    return (seen if dismissed is None else seen.unionByName(dismissed.select(*keys))).distinct()


def duplicate_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Names behind every key used more than once, one row per name, with the key's count.

    Rows, not a list per key: one key may own a large part of the table.
    """
    usable = df.filter(F.col(key).isNotNull() & (F.col(key) != "—")).select(key, name)
    counts = usable.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return usable.join(counts, key)


def split_null_keys(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a key, and the rejects without one."""
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def only_in_left(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.select(*keys).subtract(right.select(*keys))


def in_both(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.select(*keys).intersect(right.select(*keys))
