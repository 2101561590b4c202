"""Source catalogue: status upsert, lookups, ids, and DML on plain tables.

Plain parquet has no UPDATE or MERGE, so each change is a DataFrame from the
old table to the new one; `sources.tables.replace_table` publishes the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions import score as S
from acervo.functions import text as X
from acervo.functions.text import let
from acervo.operators.dedup import last_wins
from acervo.operators.ordered import with_position
from acervo.session import cut_lineage


def upsert_run_status(sources: DataFrame, runs: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Latest run per source into every row of that source; unknown sources and runs older than the row's change nothing.

    `runs` has key, ok, docs, error, run_at. `sources` has status, last_run,
    docs_captured, last_error.
    """
    latest = last_wins(runs.select(key, "ok", "docs", "error", "run_at"), [key], order)
    matched = F.col("_r.ok").isNotNull() & F.coalesce(F.col("_r.run_at") >= F.col("s.last_run"), F.lit(True))
    changed = {
        "status": F.when(F.col("_r.ok"), P.STATUS_OK).otherwise(P.STATUS_ERROR),
        "last_run": F.col("_r.run_at"),
        "docs_captured": F.col("_r.docs"),
        "last_error": F.when(F.col("_r.ok"), F.lit(None).cast("string")).otherwise(F.col("_r.error")),
    }
    joined = sources.alias("s").join(latest.alias("_r"), F.col(f"s.{key}") == F.col(f"_r.{key}"), "left")
    return joined.select(*[
        F.when(matched, changed[c]).otherwise(F.col(f"s.{c}")).alias(c) if c in changed else F.col(f"s.{c}")
        for c in sources.columns
    ])


def source_dimension(sources: DataFrame, order: list[Column]) -> DataFrame:
    """One row per usable source id (last row wins) with the derived columns."""
    usable = sources.filter(F.col("source_id").isNotNull() & ~F.col("source_id").isin("", "—"))
    one = last_wins(usable, ["source_id"], order)

    def filled(name: str, default: Column) -> Column:
        return F.coalesce(F.when(F.col(name) != "", F.col(name)), default)

    return one.select(
        "source_id",
        filled("name", F.col("source_id")).alias("source_name"),
        filled("sector", F.lit(P.UNKNOWN_SECTOR)).alias("subarea"),
        S.priority(F.col("importance")).alias("priority"),
        S.source_type(F.col("kind")).alias("source_type"),
    )


def lookup_source(docs: DataFrame, dimension: DataFrame) -> DataFrame:
    """Left join with the defaults of an unknown source."""
    own_id = F.when(F.col("source_id") != "", F.col("source_id"))
    return docs.join(dimension, "source_id", "left").withColumns({
        "source_name": F.coalesce("source_name", own_id, F.lit(P.UNKNOWN_SOURCE)),
        "subarea": F.coalesce("subarea", F.lit(P.UNKNOWN_SECTOR)),
        "priority": F.coalesce("priority", F.lit(3)),
        "source_type": F.coalesce("source_type", F.lit("noticia")),
    })


def with_covering_name(sources: DataFrame) -> DataFrame:
    """Name of the source that covers this one, else its id as written."""
    names = last_wins(sources.select("source_id", "name"), ["source_id"], [F.col("name")]).select(
        F.col("source_id").alias("covered_by"), F.col("name").alias("_covering"))
    return sources.join(names, "covered_by", "left").withColumn(
        "covered_via", F.coalesce("_covering", "covered_by")).drop("_covering")


def _grams(text: Column, sizes: list[int]) -> Column:
    """Distinct grams of the given sizes; the text is cut into its letters once."""
    def of(letters: Column, size: int) -> Column:
        return F.when(F.size(letters) >= size, F.transform(
            F.sequence(F.lit(0), F.size(letters) - size), lambda i: F.concat(*[F.get(letters, i + j) for j in range(size)]))).otherwise(
            F.array().cast("array<string>"))

    return let(F.filter(F.split(text, ""), lambda c: c != ""), lambda letters: F.array_distinct(F.flatten(F.array(*[of(letters, n) for n in sizes]))))


def match_blocks(sources: DataFrame, blocks: DataFrame, name: str, texts: list[str], gram: int = 4, hot: int = 10_000) -> DataFrame:
    """Source rows with the blocks whose texts contain the source's name, case ignored.

    Containment as an equi join on one gram of each name, the one that fewest
    blocks hold (a shorter name is its own gram); `contains` then decides. The
    blocks of a gram that more than `hot` blocks hold are dealt over several
    keys, and the names that ask for it are repeated for each.
    """
    named = sources.filter(F.coalesce(F.col(name), F.lit("")) != "").select(F.struct("*").alias("_s"), F.lower(F.col(name)).alias("_key"))
    # numbered once, so that the numbers hold when a task is run again
    held = cut_lineage(blocks.select(F.struct("*").alias("_row"), F.monotonically_increasing_id().alias("_b"),
                                     F.array(*[F.lower(F.coalesce(F.col(t), F.lit(""))) for t in texts]).alias("_texts")))
    keys = named.select("_key").distinct()
    asked = keys.filter(F.length("_key") >= gram).select("_key", F.explode(_grams(F.col("_key"), [gram])).alias("_g")).unionByName(
        keys.filter(F.length("_key") < gram).select("_key", F.col("_key").alias("_g")))
    # only the lengths that names ask for; `gram` of them at most
    sizes = sorted(r["n"] for r in asked.select(F.length("_g").alias("n")).distinct().collect())
    grams = F.array_distinct(F.flatten(F.transform("_texts", lambda t: _grams(t, sizes))))
    # the optimizer takes exploded rows for as many as the blocks, so it may not choose to broadcast them
    postings = cut_lineage(held.select("_b", F.explode(grams).alias("_g")).join(asked.select("_g").distinct(), "_g", "left_semi")).hint("merge")
    counts = postings.groupBy("_g").agg(F.ceil(F.count("*") / hot).cast("int").alias("_salts"), F.count("*").alias("_n"))
    # a name with a gram that no block holds is in no block
    rarest = asked.join(counts, "_g", "left").groupBy("_key").agg(
        F.min_by(F.struct("_g", "_salts", "_n"), F.struct(F.coalesce("_n", F.lit(0)), "_g")).alias("m")).filter("m._n is not null").select("_key", "m._g", "m._salts")
    dealt = postings.join(rarest.select("_g", "_salts").distinct(), "_g").select(
        "_g", "_b", F.pmod(F.xxhash64("_b"), F.col("_salts")).cast("int").alias("_salt"))
    met = rarest.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).join(dealt.hint("merge"), ["_g", "_salt"]).select("_key", "_b")
    found = met.hint("merge").join(held, "_b").filter(F.exists("_texts", lambda t: F.contains(t, F.col("_key"))))
    return found.hint("merge").join(named, "_key").select("_s.*", "_row.*")


def next_block_number(blocks: DataFrame) -> Column:
    """Aggregate: one more than the highest number of a `blq_NNN` id."""
    return (F.coalesce(F.max(F.substring("id", 5, 12).try_cast("int")), F.lit(0)) + 1).alias("next_number")


def block_id(number: Column) -> Column:
    """Three digits at least, longer numbers whole."""
    return F.format_string("blq_%03d", number)


def append_blocks(blocks: DataFrame, rows: DataFrame, order: str) -> DataFrame:
    """Rows added under the next consecutive ids."""
    start = blocks.agg(next_block_number(blocks)).first()["next_number"]
    numbered = with_position(rows, [], order, "_n")
    added = numbered.withColumn("id", block_id((F.lit(start) + F.col("_n")).cast("int"))).drop("_n")
    return blocks.unionByName(added.select(*blocks.columns))


def tagged_union(parts: list[tuple[str, DataFrame]], order: str) -> DataFrame:
    """Union with a type literal and generated ids in (part, order) sequence."""
    whole = None
    offset = 0
    for tag, part in parts:
        numbered = with_position(part, [], order, "_n").withColumn("_n", F.col("_n") + F.lit(offset)).withColumn("type", F.lit(tag))
        offset += part.count()
        whole = numbered if whole is None else whole.unionByName(numbered, allowMissingColumns=True)
    return whole.withColumn("id", block_id((F.col("_n") + 1).cast("int"))).drop("_n")


# --- DML ------------------------------------------------------------------

def update_where(df: DataFrame, predicate: Column, changes: dict[str, Column]) -> DataFrame:
    """UPDATE: a null predicate counts as false. All right sides see the old row."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.select(*[
        F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in df.columns
    ])


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """DELETE: rows where the predicate is null stay."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def insert_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    return df.unionByName(rows, allowMissingColumns=True).select(*df.columns)


def insert_if_absent(df: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    return insert_rows(df, rows.join(df.select(key).distinct(), key, "left_anti"))


def assert_unique_target(df: DataFrame, rows: DataFrame, key: str) -> None:
    """Raise where an incoming key meets more than one row."""
    many = df.join(rows.select(key).distinct(), key, "left_semi").groupBy(key).count().filter("count > 1").limit(1)
    if not many.isEmpty():
        raise ValueError(f"more than one row for a {key}: {many.first()[0]}")


def update_or_insert(df: DataFrame, rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Row with the key: update `columns`; none: insert; more than one: refuse."""
    assert_unique_target(df, rows, key)
    renamed = rows.select(F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_n_{c}") for c in columns])
    joined = df.join(renamed, key, "left")
    updated = joined.select(*[
        F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in df.columns
    ])
    return insert_rows(updated, rows.join(df.select(key).distinct(), key, "left_anti"))


def presence(df: DataFrame, name: Column, key: Column) -> DataFrame:
    """Rows with this name, and rows elsewhere that already use this id."""
    named = F.coalesce(name, F.lit(False))
    return df.agg(
        F.count_if(named).alias("with_name"),
        F.count_if(F.coalesce(key, F.lit(False)) & ~named).alias("id_elsewhere"),
    )


def assert_placeholder(df: DataFrame, name: Column, key: Column) -> None:
    row = presence(df, name, key).first()
    if row["with_name"] != 1 or row["id_elsewhere"] != 0:
        raise ValueError(f"expected one placeholder and a free id, found {row.asDict()}")


def fuse_duplicates(df: DataFrame, pairs: DataFrame, key: str, columns: list[str], order: Column) -> DataFrame:
    """Ghost rows give missing values to their real rows and disappear.

    `pairs` has ghost, real. The first ghost of a real row is read. A ghost whose
    real row does not exist stays.
    """
    ids = df.select(key).distinct()
    usable = pairs.join(ids.withColumnRenamed(key, "real"), "real", "left_semi")
    ghost_rows = (
        df.join(usable.withColumnRenamed("ghost", key), key)
        .groupBy("real").agg(*[F.min_by(F.col(c), order).alias(f"_g_{c}") for c in columns])
        .withColumnRenamed("real", key)
    )
    kept = df.join(usable.select(F.col("ghost").alias(key)).distinct(), key, "left_anti")
    return kept.join(ghost_rows, key, "left").select(*[
        F.coalesce(F.col(c), F.col(f"_g_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns
    ])


def inherit(df: DataFrame, mapping: DataFrame, key: str, column: str, placeholder: str = "N/D") -> DataFrame:
    """Placeholder text replaced by the parent's value from a mapping (key, value)."""
    joined = df.join(mapping.select(key, F.col("value").alias("_v")), key, "left")
    return joined.withColumn(
        column, F.when((F.col(column) == placeholder) & F.col("_v").isNotNull(), F.col("_v")).otherwise(F.col(column))
    ).select(*df.columns)


def add_column_if_missing(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def append_note_where(df: DataFrame, predicate: Column, reason: str, column: str = "notes") -> DataFrame:
    return update_where(df, predicate, {column: X.append_note(F.col(column), F.lit(reason))})


def choose_sources(df: DataFrame, source: str, column: str = "source_id") -> DataFrame:
    """`todas` keeps everything; an unknown name is refused."""
    if source == "todas":
        return df
    chosen = df.filter(F.col(column) == source)
    if chosen.limit(1).isEmpty():
        raise ValueError(f"unknown source: {source}")
    return chosen
