"""Entity matching over part names and document texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo.operators import entities as E
from acervo.plans.registry import query, table
from acervo.session import widen

# A small alias dictionary of words that occur in the test documents.
ENTITIES = [
    ("licenca", "Licença S.A.", ["license", "Lic."]),
    ("worth", "Worthless Group", ["worthless", "that it."]),
    ("orantion", "Orantion", ["Orantión", "tion"]),
    ("eaux", "Eaux", ["eaux", "en la"]),
    ("pathetic", "Pathetic Holdings", ["pathetic", "disgusting", "license agreement", "eaux"]),
]


def dictionary(spark):
    rows = [(i, c, n, a) for i, (c, n, a) in enumerate(ENTITIES)]
    return spark.createDataFrame(rows, "entity_pos int, canonical_id string, main_name string, aliases array<string>")


def _sql_index() -> str:
    index: dict[str, tuple[str, str]] = {}
    import unicodedata
    for canonical, name, aliases in ENTITIES:
        for alias in aliases:
            index[unicodedata.normalize("NFKD", alias).encode("ascii", "ignore").decode().strip().upper()] = (canonical, name)
    values = ", ".join(f"('{a}', '{c}', '{n}', '{a.replace('.', '[.]')}')" for a, (c, n) in index.items())
    return f"a(alias_norm, canonical_id, main_name, pattern) AS (VALUES {values})"


FOLDED = r"upper(trim(regexp_replace(strip_accents({0}), '[^\x00-\x7F]+', '', 'g')))"


def _sql_mentions(name: str, expr: str) -> str:
    return (f"{name} AS (SELECT doc_id, alias_norm, canonical_id, main_name, length(alias_norm) <= 5 AS suspect "
            f"FROM (SELECT doc_id, {FOLDED.format(expr)} AS t FROM documents) d JOIN a "
            rf"ON contains(t, alias_norm) AND regexp_matches(t, '(^|\W)' || pattern || '($|\W)'))")


@query("q27_alias_exact", """
WITH e AS (SELECT p_name, min(p_partkey) AS pos FROM part GROUP BY 1),
al AS (SELECT pos, p_name, 0 AS i, upper(p_name) AS alias FROM e UNION ALL SELECT pos, p_name, 1, upper(string_split(p_name, ' ')[2]) FROM e
  UNION ALL SELECT pos, p_name, 2, upper('grupo ' || string_split(p_name, ' ')[1]) FROM e),
ix AS (SELECT alias, arg_max(p_name, pos * 10 + i) AS canonical_id FROM al GROUP BY 1),
n AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN ' ' || p_name || ' ' WHEN 1 THEN string_split(p_name, ' ')[2] WHEN 2 THEN 'Grupo ' || string_split(p_name, ' ')[1]
  ELSE p_name || ' x' END AS name FROM part)
SELECT p_partkey, ix.canonical_id FROM n LEFT JOIN ix ON upper(trim(name)) = alias""")
def q27(spark, sf):
    part = table(spark, sf, "part")
    words = F.split("p_name", " ")
    entities = part.groupBy("p_name").agg(F.min("p_partkey").alias("entity_pos")).select(
        "entity_pos", F.col("p_name").alias("canonical_id"), F.initcap("p_name").alias("main_name"),
        F.array(F.col("p_name"), words[1], F.concat(F.lit("Grúpo "), words[0])).alias("aliases"))
    kind = F.col("p_partkey") % 4
    accented = F.translate("p_name", "aeo", "áéô")
    names = part.select("p_partkey", F.when(kind == 0, F.concat(F.lit(" "), accented, F.lit(" "))).when(kind == 1, words[1]).when(
        kind == 2, F.concat(F.lit("Grupo "), words[0])).otherwise(F.concat("p_name", F.lit(" x"))).alias("name"))
    return E.match_exact(names, E.alias_index(entities)).select("p_partkey", "canonical_id")


@query("q28_alias_scan", f"""
WITH {_sql_index()}, {_sql_mentions('m', 'text')} SELECT doc_id, alias_norm, canonical_id, main_name, suspect FROM m""")
def q28(spark, sf):
    return E.scan_mentions(widen(table(spark, sf, "documents").select("doc_id", "text")), E.alias_index(dictionary(spark)), "doc_id", "text")


@query("q28_growing_dictionary", """
WITH n AS (SELECT p_partkey, upper(p_name || ' ' || p_partkey) AS whole, upper(string_split(p_name, ' ')[2] || ' ' || p_partkey) AS short, upper(p_brand) AS brand FROM part),
a AS (SELECT whole AS alias_norm, 'p' || p_partkey AS canonical_id FROM n UNION ALL SELECT short, 'p' || p_partkey FROM n
  UNION ALL SELECT brand, 'p' || max(p_partkey) FROM n GROUP BY 1),
t AS (SELECT o_orderkey, string_agg(p_brand || ' ' || p_name || ' ' || p_partkey, ', ') AS t FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1),
w AS (SELECT DISTINCT o_orderkey, alias_norm FROM (SELECT o_orderkey, upper(unnest(string_split(t, ', '))) AS i FROM t),
  LATERAL (SELECT unnest([string_split(i, ' ')[1], array_to_string(string_split(i, ' ')[2:4], ' '), array_to_string(string_split(i, ' ')[3:4], ' ')]) AS alias_norm))
SELECT o_orderkey, alias_norm, canonical_id FROM w JOIN a USING (alias_norm)""")
def q28_growing(spark, sf):
    """Three aliases a part, one shared by the parts of a brand and one inside another, in the item lists of orders."""
    part = table(spark, sf, "part")
    numbered = F.concat_ws(" ", "p_name", "p_partkey")
    entities = part.select(
        F.col("p_partkey").alias("entity_pos"), F.concat(F.lit("p"), "p_partkey").alias("canonical_id"), F.initcap("p_name").alias("main_name"),
        F.array(numbered, F.concat_ws(" ", F.split("p_name", " ")[1], "p_partkey"), F.col("p_brand")).alias("aliases"))
    items = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    texts = items.groupBy("l_orderkey").agg(F.array_join(F.collect_list(F.concat_ws(" ", "p_brand", "p_name", "p_partkey")), ", ").alias("text"))
    orders = table(spark, sf, "orders").join(texts, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "text")
    return E.scan_mentions(orders, E.alias_index(entities), "o_orderkey", "text").select("o_orderkey", "alias_norm", "canonical_id")


@query("q28_match_counts", f"""
WITH {_sql_index()}, {_sql_mentions('m', 'text')}
SELECT count(*) AS n_matches, count(*) FILTER (WHERE NOT suspect) AS n_confirmed, count(*) FILTER (WHERE suspect) AS n_suspect FROM m""")
def q28_counts(spark, sf):
    from acervo.operators.reports import match_counts

    return match_counts(q28(spark, sf))


@query("q28_portfolio_gate", f"""
WITH {_sql_index()}, {_sql_mentions('m1', 'left(text, 300)')}, {_sql_mentions('m2', 'text')},
s1 AS (SELECT doc_id, list_sort(list_distinct(list(main_name) FILTER (WHERE NOT suspect))) AS c, list_sort(list_distinct(list(main_name) FILTER (WHERE suspect))) AS s FROM m1 GROUP BY 1),
s2 AS (SELECT doc_id, list_sort(list_distinct(list(main_name) FILTER (WHERE NOT suspect))) AS c, list_sort(list_distinct(list(main_name) FILTER (WHERE suspect))) AS s FROM m2 GROUP BY 1)
SELECT s1.doc_id, coalesce(array_to_string(CASE WHEN len(s2.c) > 0 THEN s2.c ELSE s1.c END, '; '), '') AS confirmed,
  coalesce(array_to_string(CASE WHEN len(s2.s) > 0 THEN s2.s ELSE s1.s END, '; '), '') AS suspects FROM s1 LEFT JOIN s2 USING (doc_id)""")
def q28_gate(spark, sf):
    items = table(spark, sf, "documents").select("doc_id", F.substring("text", 1, 300).alias("listing"), "text")
    gated = E.portfolio_gate(items, E.alias_index(dictionary(spark)), "doc_id", "listing", "text")
    return gated.select("doc_id", F.array_join("confirmed", "; ").alias("confirmed"), F.array_join("suspects", "; ").alias("suspects"))


@query("q28_naive_scan", f"""
WITH {_sql_index()}
SELECT doc_id, lower(alias_norm) AS alias, canonical_id FROM (SELECT doc_id, lower({FOLDED.format('text')}) AS t FROM documents) d
JOIN a ON length(alias_norm) >= 4 AND contains(t, lower(alias_norm))""")
def q28_naive(spark, sf):
    return E.naive_mentions(table(spark, sf, "documents"), E.alias_index(dictionary(spark)), "doc_id", "text")


@query("q28_alias_collisions", """
WITH e AS (SELECT p_name, unnest([upper(p_name), upper(string_split(p_name, ' ')[2])]) AS key FROM (SELECT DISTINCT p_name FROM part))
SELECT key, p_name AS canonical_id, n FROM (SELECT *, count(*) OVER (PARTITION BY key) AS n FROM e) WHERE n > 1""")
def q28_collisions(spark, sf):
    from acervo.operators.dedup import duplicate_keys

    claimed = table(spark, sf, "part").select("p_name").distinct().select(
        F.explode(F.array(F.upper("p_name"), F.upper(F.split("p_name", " ")[1]))).alias("key"), F.col("p_name").alias("canonical_id"))
    return duplicate_keys(claimed, "key", "canonical_id")


@query("q29_alias_fuzzy")
def q29(spark, sf):
    """Part names with a letter dropped or words added, resolved against the clean names."""
    part = table(spark, sf, "part")
    entities = part.groupBy("p_name").agg(F.min("p_partkey").alias("entity_pos")).select(
        "entity_pos", F.col("p_name").alias("canonical_id"), F.initcap("p_name").alias("main_name"), F.array("p_name").alias("aliases"))
    at = (F.col("p_partkey") % F.length("p_name")).cast("int")
    kind = F.col("p_partkey") % 3
    name = F.when(kind == 0, F.concat(F.expr("substring(p_name, 1, p_partkey % length(p_name))"),
                                      F.substring(F.col("p_name"), at + 2, F.length("p_name")))).when(
        kind == 1, F.concat(F.lit("Cia "), F.initcap("p_name"), F.lit(" S.A."))).otherwise(F.concat(F.lit("zz"), F.col("p_partkey").cast("string")))
    names = part.select("p_partkey", name.alias("name"))
    return E.resolve(names, E.alias_index(entities))


@query("q29_known_ratios", """
WITH a AS (SELECT p_partkey, 'p' || p_partkey AS canonical_id, upper(left(md5(CAST(p_partkey AS VARCHAR)), 12)) AS x, upper(right(md5(CAST(p_partkey AS VARCHAR)), 20)) AS y FROM part)
SELECT CASE p_partkey % 6 WHEN 0 THEN 'GRUPO ' || y || ' ' || x WHEN 1 THEN left(x, 5) || 'Q' || right(x, 6) || ' ' || y WHEN 2 THEN 'ZZ ' || y ELSE y END AS alias_norm,
  canonical_id, round(CASE p_partkey % 6 WHEN 1 THEN 100 - 100.0 * 2 / (33 + 33) WHEN 2 THEN 100 - 100.0 * (1 + 2) / (20 + 23) ELSE 100.0 END, 6) AS score
FROM a WHERE p_partkey % 6 <= 3""")
def q29_known(spark, sf):
    """Aliases of two random tokens x y, and names at a known ratio to them: all tokens and one more, one letter changed,
    one token changed, one token left out, five letters changed (below the threshold), nothing in common."""
    part = table(spark, sf, "part")
    digest = F.upper(F.md5(F.col("p_partkey").cast("string").cast("binary")))
    x, y = F.substring(digest, 1, 12), F.substring(digest, 13, 20)
    entities = part.select(F.col("p_partkey").alias("entity_pos"), F.concat(F.lit("p"), "p_partkey").alias("canonical_id"),
                           F.col("p_name").alias("main_name"), F.array(F.concat_ws(" ", x, y)).alias("aliases"))
    kind = F.col("p_partkey") % 6
    name = (F.when(kind == 0, F.concat_ws(" ", F.lit("GRUPO"), y, x)).when(kind == 1, F.concat(F.substring(x, 1, 5), F.lit("Q"), F.substring(x, 7, 6), F.lit(" "), y))
            .when(kind == 2, F.concat_ws(" ", F.lit("ZZ"), y)).when(kind == 3, y)
            .when(kind == 4, F.concat(F.lit("QQQQQ"), F.substring(x, 6, 7), F.lit("Q"), F.substring(y, 2, 19))).otherwise(F.reverse(F.md5(y.cast("binary")))))
    return E.match_fuzzy(part.select(name.alias("alias_norm")), E.alias_index(entities)).select("alias_norm", "canonical_id", F.round("score", 6).alias("score"))
