"""Table maintenance: update, delete, insert, upsert, fusion, inheritance."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo.operators import catalogue as K
from acervo.operators import dedup
from acervo.plans.registry import query, table


def _customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("sector"),
        F.when(F.col("c_custkey") % 3 == 0, "nota").when(F.col("c_custkey") % 3 == 1, " ").alias("notes"),
        F.when(F.col("c_nationkey") % 2 == 0, "N/D").otherwise("tier 1").alias("tier"),
        F.col("c_nationkey").cast("long").alias("nation"))


@query("q44_update", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey IN (1, 2) THEN 'Transporte' ELSE c_mktsegment END AS sector,
  CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey IN (1, 2) THEN CASE WHEN c_custkey % 3 = 0 THEN 'nota | mudou' ELSE 'mudou' END
    WHEN c_custkey % 3 = 0 THEN 'nota' WHEN c_custkey % 3 = 1 THEN ' ' END AS notes FROM customer""")
def q44_update(spark, sf):
    hit = (F.col("sector") == "BUILDING") & F.col("nation").isin(1, 2)
    noted = K.append_note_where(_customers(spark, sf), hit, "mudou")
    return K.update_where(noted, hit, {"sector": F.lit("Transporte")}).select("c_custkey", "sector", "notes")


@query("q44_delete", """
SELECT c_custkey FROM customer WHERE NOT (coalesce((CASE WHEN c_custkey % 3 = 0 THEN 'nota' WHEN c_custkey % 3 = 1 THEN ' ' END) ILIKE '%NOTA%', false) AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY'))""")
def q44_delete(spark, sf):
    gone = F.col("notes").ilike("%NOTA%") & ~F.col("sector").isin("BUILDING", "MACHINERY")
    return K.delete_where(_customers(spark, sf), gone).select("c_custkey")


@query("q44_inherit", """
SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 AND c_nationkey < 12 THEN 'tier ' || n_regionkey WHEN c_nationkey % 2 = 0 THEN 'N/D' ELSE 'tier 1' END AS tier
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def q44_inherit(spark, sf):
    parents = table(spark, sf, "nation").filter("n_nationkey < 12").select(
        F.col("n_nationkey").cast("long").alias("nation"), F.concat(F.lit("tier "), F.col("n_regionkey").cast("string")).alias("value"))
    return K.inherit(_customers(spark, sf), parents, "nation", "tier").select("c_custkey", "tier")


@query("q45_upsert", """
WITH r AS (SELECT s_suppkey + 50 AS k, 'novo ' || s_suppkey AS name FROM supplier)
SELECT coalesce(s.s_suppkey, r.k) AS k, coalesce(r.name, s.s_name) AS name, s.s_acctbal AS balance FROM supplier s FULL OUTER JOIN r ON r.k = s.s_suppkey""")
def q45_upsert(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    rows = suppliers.select((F.col("k") + 50).alias("k"), F.concat(F.lit("novo "), F.col("k").cast("string")).alias("name"))
    return K.update_or_insert(suppliers, rows, "k", ["name"])


@query("q45_insert_if_absent", """
SELECT s_suppkey AS k, s_name AS name FROM supplier UNION ALL
SELECT s_suppkey + 50, 'novo' FROM supplier WHERE s_suppkey + 50 NOT IN (SELECT s_suppkey FROM supplier)""")
def q45_insert(spark, sf):
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    rows = suppliers.select((F.col("k") + 50).alias("k"), F.lit("novo").alias("name"))
    return K.insert_if_absent(suppliers, rows, "k")


@query("q45_null_key_quarantine", """
SELECT s_suppkey % 4 = 0 AS rejected, count(*) AS n FROM supplier GROUP BY 1""")
def q45_quarantine(spark, sf):
    rows = table(spark, sf, "supplier").select(F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).alias("source_id"))
    good, bad = dedup.split_null_keys(rows, "source_id")
    return good.agg(F.count("*").alias("n")).withColumn("rejected", F.lit(False)).unionByName(
        bad.agg(F.count("*").alias("n")).withColumn("rejected", F.lit(True)))


@query("q46_ghost_fusion", """
WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 <> 0 THEN 'imp' || s_suppkey END AS importance, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS notes FROM supplier),
p AS (SELECT k AS ghost, k // 4 AS real FROM s WHERE k >= 40 AND k // 4 IN (SELECT k FROM s)),
g AS (SELECT real, importance, notes FROM s JOIN p ON ghost = k QUALIFY row_number() OVER (PARTITION BY real ORDER BY k) = 1)
SELECT s.k, coalesce(s.importance, g.importance) AS importance, coalesce(s.notes, g.notes) AS notes FROM s LEFT JOIN g ON g.real = s.k
WHERE s.k NOT IN (SELECT ghost FROM p)""")
def q46(spark, sf):
    key = F.col("s_suppkey")
    sources = table(spark, sf, "supplier").select(
        key.alias("k"), F.when(key % 3 != 0, F.concat(F.lit("imp"), key.cast("string"))).alias("importance"),
        F.when(key % 2 == 0, F.col("s_name")).alias("notes"))
    pairs = sources.filter("k >= 40").select(F.col("k").alias("ghost"), F.floor(F.col("k") / 4).alias("real"))
    return K.fuse_duplicates(sources, pairs, "k", ["importance", "notes"], F.col("k"))
