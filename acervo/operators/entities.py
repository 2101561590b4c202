"""Entity resolution: exact, fuzzy and in-text matching against the alias index."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from acervo import params as P
from acervo.functions import similarity as M
from acervo.functions.text import fold_upper
from acervo.session import cut_lineage, spread

# Aliases that one pass over the texts carries: an automaton of some tens of MB in a task.
CARRIED_ALIASES = 100_000
# Letters of a block of names or aliases: an index of some tens of MB in a task. Fewer names than BLOCK_NAMES are not worth an index.
BLOCK_LETTERS, BLOCK_NAMES = 2_000_000, 500


def alias_index(entities: DataFrame) -> DataFrame:
    """One canonical id per folded alias: the last entity and alias to claim it wins.

    `entities` has entity_pos, canonical_id, main_name, aliases. Position of an
    alias is where it first appears, which breaks ties of fuzzy matches.
    """
    rows = entities.select(
        "entity_pos", "canonical_id", "main_name", F.posexplode("aliases").alias("alias_pos", "alias")
    ).withColumn("alias_norm", fold_upper(F.col("alias"))).filter("alias_norm <> ''")
    place = F.struct("entity_pos", "alias_pos")
    return rows.groupBy("alias_norm").agg(
        F.max_by("canonical_id", place).alias("canonical_id"),
        F.max_by("main_name", place).alias("main_name"),
        F.min(place).alias("pos"),
        F.countDistinct("canonical_id").alias("n_owners"),
    )


def match_exact(names: DataFrame, index: DataFrame, name: str = "name") -> DataFrame:
    """Left join on the folded name; `canonical_id` is null without a match."""
    return (
        names.withColumn("alias_norm", fold_upper(F.col(name)))
        .join(index.select("alias_norm", "canonical_id"), "alias_norm", "left")
    )


def _tokens(text: str) -> Column:
    """Distinct tokens of a name, parted as `str.split` parts ASCII."""
    return F.array_distinct(F.filter(F.split(text, r"[\s\x1c-\x1f]+"), lambda t: t != ""))


def _with_length(df: DataFrame, text: str) -> DataFrame:
    """tokens, and the length of the distinct tokens joined by blanks."""
    joined = F.aggregate("tokens", F.lit(-1), lambda n, t: n + F.length(t) + 1)
    return df.withColumn("tokens", _tokens(text)).filter(F.size("tokens") > 0).withColumn("length", joined)


def _rarest_tokens(own: DataFrame, other: DataFrame, name: str, share: float) -> DataFrame:
    """(name, token): tokens of `own`, the rarest in `other` first, until the rest is shorter than `share` of the name.

    Whatever shares tokens of that joined length with the name shares one of these.
    """
    counts = other.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    each = own.select(name, "length", F.explode("tokens").alias("token")).join(counts, "token", "left")
    before = Window.partitionBy(name).orderBy(F.coalesce("n", F.lit(0)), "token").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("length") - F.coalesce(F.sum(F.length("token") + 1).over(before), F.lit(0))
    return each.withColumn("left", left).filter((F.col("left") >= F.col("length") * share - 1e-6) & F.col("n").isNotNull()).select(name, "token")


def _by_grams(names: DataFrame, aliases: DataFrame, threshold: float) -> DataFrame:
    """(name, alias, score): pairs that reach the threshold by their letters, token by token or across tokens.

    Blocks of names meet blocks of aliases in tasks, which count common grams by an index in memory (`GramIndex`). Grams
    and the pairs that they ask for are never rows: only pairs that reach the threshold leave a task, and what is
    shuffled is each name once for each block of aliases, each alias once for each block of names.
    """
    letters = F.coalesce(F.sum("length"), F.lit(0)).alias("letters")
    (n, name_letters), (_, alias_letters) = (tuple(df.agg(F.count("*"), letters).first()) for df in (names, aliases))
    columns = max(1, -(-alias_letters // BLOCK_LETTERS))
    tasks = 2 * names.sparkSession.sparkContext.defaultParallelism
    lines = max(1, -(-name_letters // BLOCK_LETTERS), min(-(-tasks // columns), n // BLOCK_NAMES))

    def dealt(df: DataFrame, text: str, own: str, mine: int, other: str, others: int) -> DataFrame:
        placed = df.select(text, F.pmod(F.xxhash64(text), F.lit(mine)).cast("int").alias(own))
        return spread(placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))), "line", "column").groupBy("line", "column")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = M.GramIndex(right["alias"].tolist(), threshold).scored(left["name"].tolist()) if len(left) and len(right) else ()
        return pd.DataFrame(found, columns=["name", "alias", "score"])

    return dealt(names, "name", "line", lines, "column", columns).cogroup(
        dealt(aliases, "alias", "column", columns, "line", lines)).applyInPandas(meet, "name string, alias string, score double")


def match_fuzzy(names: DataFrame, index: DataFrame, threshold: float = P.FUZZY_RATIO, min_alias_tokens: int = 1) -> DataFrame:
    """Nearest alias of each distinct `alias_norm` in names; kept if the ratio reaches the threshold (two thirds or more).

    Ties go to the alias listed first. Result: alias_norm, canonical_id, score.

    No name meets the whole dictionary. Pairs that share enough whole tokens meet on the rarest tokens of either side;
    where one name holds all tokens of the other the score is 100 and is settled by that join. The other names meet
    aliases on their grams of letters too, counted inside tasks. Only pairs with enough in common are scored, in Arrow
    passes. Both searches are exact: a pair at the threshold passes by the bounds given with each.
    """
    if threshold * 3 < 2:
        raise ValueError("below two thirds a pair need not share any letter")
    # the optimizer takes exploded tokens and grams for as many as the names, so it may not choose to broadcast them
    left = cut_lineage(_with_length(names.select(F.col("alias_norm").alias("name")).distinct(), "name")).hint("merge")
    right = cut_lineage(_with_length(index.select(
        F.col("alias_norm").alias("alias"), "canonical_id", F.col("pos.entity_pos").alias("e"), F.col("pos.alias_pos").alias("a")), "alias").filter(
        F.size(F.split("alias", r"\s+")) >= min_alias_tokens)).hint("merge")
    share = threshold / (2 - threshold)
    on_left = _rarest_tokens(left, right, "name", share).join(right.select("alias", F.explode("tokens").alias("token")), "token")
    on_right = _rarest_tokens(right, left, "alias", share).join(left.select("name", F.explode("tokens").alias("token")), "token")
    inside = (F.size(F.array_except("tokens", "others")) == 0) | (F.size(F.array_except("others", "tokens")) == 0)
    sharing = cut_lineage(on_left.select("name", "alias").unionByName(on_right.select("name", "alias")).distinct().join(
        left.select("name", "tokens"), "name").join(right.select("alias", F.col("tokens").alias("others"), "canonical_id", "e", "a"), "alias").select(
        "name", "alias", "canonical_id", "e", "a", inside.alias("inside")))
    whole = cut_lineage(sharing.filter("inside").groupBy("name").agg(
        F.min_by("canonical_id", F.struct("e", "a")).alias("canonical_id"), F.lit(100.0).alias("score"))).hint("merge")
    open_names = cut_lineage(left.join(whole.select("name"), "name", "left_anti"))
    pairs = sharing.select("name", "alias").join(whole.select("name"), "name", "left_anti")
    floor = threshold * 100

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple] = {}

        def tokens(text: str) -> tuple:
            if text not in known:
                if len(known) > 50_000:
                    known.clear()
                known[text] = M.name_tokens(text)
            return known[text]

        for part in parts:
            part["score"] = [M.tokens_ratio(tokens(n), tokens(a), floor) for n, a in zip(part["name"], part["alias"])]
            yield part[part["score"] >= floor]

    scored = pairs.mapInPandas(score, "name string, alias string, score double").unionByName(_by_grams(open_names, right, threshold))
    near = scored.join(right.select("alias", "canonical_id", "e", "a"), "alias")
    best = near.groupBy("name").agg(
        F.max_by("canonical_id", F.struct("score", -F.col("e"), -F.col("a"))).alias("canonical_id"), F.max("score").alias("score"))
    return whole.unionByName(best).select(F.col("name").alias("alias_norm"), "canonical_id", "score")


def resolve(names: DataFrame, index: DataFrame, name: str = "name", threshold: float = P.FUZZY_RATIO,
            min_alias_tokens: int = 1) -> DataFrame:
    """Exact, else fuzzy, else unmatched: adds canonical_id and in_universe.

    Fuzzy scoring sees only the distinct names that no alias equals.
    """
    exact = match_exact(names, index, name)
    rest = exact.filter("canonical_id is null").select("alias_norm")
    fuzzy = match_fuzzy(rest, index, threshold, min_alias_tokens).select(
        "alias_norm", F.col("canonical_id").alias("_fuzzy"))
    return (
        exact.join(fuzzy, "alias_norm", "left")
        .withColumn("canonical_id", F.coalesce("canonical_id", "_fuzzy"))
        .withColumn("in_universe", F.col("canonical_id").isNotNull())
        .drop("_fuzzy", "alias_norm")
    )


def collect_risks(resolved: DataFrame, key: str, position: str, name: str = "name") -> DataFrame:
    """Mentions of a document as one ordered array; a document's reply bounds its length."""
    item = F.struct(F.col(position).alias("p"), F.col(name).alias("name"), "canonical_id", "in_universe")
    return resolved.groupBy(key).agg(F.transform(
        F.array_sort(F.collect_list(item)),
        lambda r: F.struct(r["name"].alias("name"), r["canonical_id"].alias("canonical_id"),
                           r["in_universe"].alias("in_universe")),
    ).alias("credit_risks"))


def _wordlike(text: str, at: int) -> bool:
    """Whether a letter, digit or underscore stands there; folded texts are ASCII."""
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


def _whole_word(text: str, start: int, end: int) -> bool:
    return not _wordlike(text, start - 1) and not _wordlike(text, end)


def _word_edges(text: str, start: int, end: int) -> bool:
    """The plain boundary, which fails beside punctuation at the alias's own edge."""
    return _wordlike(text, start - 1) != _wordlike(text, start) and _wordlike(text, end - 1) != _wordlike(text, end)


def _anywhere(text: str, start: int, end: int) -> bool:
    return True


def _few_rows(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch holds thousands of texts; as Python strings only a few hundred at a time are in memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _found_by_words(texts: DataFrame, index: DataFrame, key: str, accepted: Callable[[str, int, int], bool]) -> DataFrame:
    """As `_found_in_texts`, for aliases that hold a word: an equi join, whatever the size of the dictionary.

    An accepted occurrence begins and ends beside whole words, so its words are words of the text. The form of an alias
    is its number of words and the letters before the first and after the last; of each text, read once, every accepted
    piece of one of the dictionary's forms meets the alias that equals it.
    """
    name = index.columns[0]
    words = F.regexp_count(F.col(name), F.lit(r"\w+"))
    outer = [F.length(F.regexp_extract(name, pattern, 0)) for pattern in (r"(?s)^\W*", r"(?s)\W*$")]
    forms = [tuple(r) for r in index.select(words, *outer).distinct().collect()]
    schema = StructType([texts.schema[key], StructField(name, index.schema[name].dataType)])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = re.compile(r"\w+", re.ASCII).finditer
        for batch in _few_rows(batches):
            rows, found = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                seen, places = set(), [m.span() for m in spans(text or "")]
                for n, before, behind in forms:
                    for (first, _), (_, last) in zip(places, places[n - 1:]):
                        start, end = first - before, last + behind
                        if start >= 0 and end <= len(text) and accepted(text, start, end):
                            seen.add(text[start:end])
                rows += [row] * len(seen)
                found += seen
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, pa.string())], names=schema.names)

    asked = texts.select(key, "_text").mapInArrow(pieces, schema)
    # pieces are more than the texts that the optimizer sees
    return asked.hint("merge").join(index, name).select(key, *index.columns)


def _found_in_texts(texts: DataFrame, key: str, aliases: list[tuple], fields: list[StructField],
                    accepted: Callable[[str, int, int], bool]) -> DataFrame:
    """key and the values of every alias that has an accepted occurrence in `_text`, once; an alias's values begin with its name.

    One pass of an automaton with failure links over all aliases finds their occurrences, nested and overlapping ones too.
    """
    sent = texts.sparkSession.sparkContext.broadcast(aliases)
    schema = StructType([texts.schema[key], *fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for place, values in enumerate(sent.value):
            automaton.add_word(values[0], (place, len(values[0])))
        automaton.make_automaton()
        columns = [pa.array(column, pa.string()) for column in zip(*sent.value)]
        for batch in _few_rows(batches):
            rows, places = [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                if not text:
                    continue
                seen = set()
                for last, (place, length) in automaton.iter(text):
                    if place not in seen and accepted(text, last + 1 - length, last + 1):
                        seen.add(place)
                rows += [row] * len(seen)
                places += sorted(seen)
            at = pa.array(places, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(c.take(at) for c in columns)], names=schema.names)

    return texts.select(key, "_text").mapInArrow(scan, schema)


def _occurrences(texts: DataFrame, index: DataFrame, key: str, columns: list[str], accepted: Callable[[str, int, int], bool],
                 carried: int) -> DataFrame:
    """key and the text columns of each alias found, the first of them its name; `carried` aliases travel with one pass over the texts.

    Of a larger dictionary, aliases that hold a word are joined where whole words are asked for. The others are cut by a
    hash into parts of about `carried`, and each part, a list of bounded length, is a pass.
    """
    index = index.select(*[F.col(c).cast("string").alias(c) for c in columns])
    rows = index.limit(carried + 1).collect()
    blocks, found = [rows], None
    if len(rows) > carried:
        index = cut_lineage(index)
        if accepted is not _anywhere:
            worded = F.col(columns[0]).rlike(r"\w")
            found = _found_by_words(texts, index.filter(worded), key, accepted)
            index = index.filter(~worded)
        parts = -(-index.count() // carried)
        blocks = (index.filter(F.pmod(F.xxhash64(columns[0]), F.lit(parts)) == part).collect() for part in range(parts))
    for rows in blocks:
        if rows:
            hits = _found_in_texts(texts, key, [tuple(r) for r in rows], index.schema.fields, accepted)
            found = hits if found is None else found.unionByName(hits)
    return texts.limit(0).select(key, *[F.lit("").alias(c) for c in columns]) if found is None else found


def scan_mentions(docs: DataFrame, index: DataFrame, key: str, text: str, legacy: bool = False,
                  carried: int = CARRIED_ALIASES) -> DataFrame:
    """(key, alias_norm, canonical_id, main_name, suspect) of every whole-word mention, one row per document and alias.

    Aliases of at most five characters count as suspect. Texts are not shuffled: each is folded, read once by an
    automaton over the dictionary, and only places of aliases leave the task. A dictionary of more than `carried`
    aliases meets pieces of the texts in a join.
    """
    folded = docs.select(key, fold_upper(F.col(text)).alias("_text"))
    found = _occurrences(folded, index, key, ["alias_norm", "canonical_id", "main_name"], _word_edges if legacy else _whole_word, carried)
    return found.withColumn("suspect", F.length("alias_norm") <= P.SHORT_ALIAS_CHARS)


def mention_sets(mentions: DataFrame, key: str) -> DataFrame:
    """Sorted confirmed and suspect entity names per document (at most the dictionary's size)."""
    def names(flag: Column) -> Column:
        return F.array_sort(F.collect_set(F.when(flag, F.col("main_name"))))

    return mentions.groupBy(key).agg(
        names(~F.col("suspect")).alias("confirmed"), names(F.col("suspect")).alias("suspects"))


def portfolio_gate(items: DataFrame, index: DataFrame, key: str, listing_text: str, full_text: str) -> DataFrame:
    """Two passes: listing text first, full text only for items that passed.

    Each full-text set wins if it holds anything, else the listing's set.
    """
    first = mention_sets(scan_mentions(items, index, key, listing_text), key)
    passed = items.join(first, key)
    second = mention_sets(scan_mentions(passed, index, key, full_text), key).select(
        key, F.col("confirmed").alias("_c2"), F.col("suspects").alias("_s2"))

    def better(second_set: str, first_set: str) -> Column:
        return F.when(F.size(F.coalesce(F.col(second_set), F.array().cast("array<string>"))) > 0,
                      F.col(second_set)).otherwise(F.col(first_set))

    return passed.join(second, key, "left").withColumns({
        "confirmed": better("_c2", "confirmed"), "suspects": better("_s2", "suspects"),
    }).drop("_c2", "_s2")


def naive_mentions(docs: DataFrame, index: DataFrame, key: str, text: str, carried: int = CARRIED_ALIASES) -> DataFrame:
    """Substring baseline: lower-case aliases of four or more characters inside the text, found as whole-word mentions are."""
    usable = index.filter(F.length("alias_norm") >= P.NAIVE_ALIAS_MIN_CHARS).select(F.lower("alias_norm").alias("alias_norm"), "canonical_id")
    folded = docs.select(key, F.lower(fold_upper(F.col(text))).alias("_text"))
    return _occurrences(folded, usable, key, ["alias_norm", "canonical_id"], _anywhere, carried).withColumnRenamed("alias_norm", "alias")
