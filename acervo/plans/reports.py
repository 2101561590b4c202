"""Report tables over the catalogue, run log and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo import params as P
from acervo.operators import filters, reports
from acervo.plans.catalogue import IMPORTANCE_SQL, STATUS_SQL, _importance
from acervo.plans.registry import query, table

STATUS = "CASE c_nationkey % 4 WHEN 0 THEN 'Coberta e validada em produção' WHEN 1 THEN 'Coberta indiretamente' WHEN 2 THEN 'Bloqueada' END"


def _catalogue(spark, sf, machinery="Extra"):
    kind = F.col("c_nationkey") % 4
    return table(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), _importance(F.lit(machinery)).alias("importance"),
        F.when(kind == 0, P.STATUS_OK).when(kind == 1, "Coberta indiretamente").when(kind == 2, "Bloqueada").alias("status"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("balance"))


@query("q37_covered_by_importance", f"""
WITH c AS (SELECT coalesce(nullif(trim({IMPORTANCE_SQL.format("'Extra'")}), ''), 'Baixa') AS importance, c_name AS name, {STATUS} AS status FROM customer)
SELECT importance, name, count(*) OVER (PARTITION BY importance) AS n_sources,
  CAST(CASE importance WHEN 'Alta' THEN 1 WHEN 'Média' THEN 2 WHEN 'Media' THEN 3 WHEN 'Baixa' THEN 4 ELSE 99 END AS BIGINT) AS level_order
FROM c WHERE {STATUS_SQL.format('status')} = 'badge-ok'""")
def q37(spark, sf):
    covered = reports.covered_by_importance(_catalogue(spark, sf), "status", "importance", "name")
    return covered.select("importance", "name", "n_sources", F.col("level_order").cast("long").alias("level_order"))


@query("q37_covered_first", f"""
WITH c AS (SELECT c_custkey, coalesce(nullif({IMPORTANCE_SQL.format("' '")}, ' '), 'Baixa') AS importance_shown, {STATUS} AS status FROM customer)
SELECT c_custkey, importance_shown, {STATUS_SQL.format('status')} = 'badge-ok' AS covered FROM c
ORDER BY CASE importance_shown WHEN 'Alta' THEN 1 WHEN 'Média' THEN 2 WHEN 'Media' THEN 3 ELSE 4 END, 3 DESC, c_custkey""")
def q37_order(spark, sf):
    ordered = reports.covered_first(_catalogue(spark, sf, " "), "status", "importance", "c_custkey")
    return ordered.select("c_custkey", "importance_shown", "covered")


@query("q38_display_groups", f"""
WITH s AS (SELECT s_suppkey, CASE WHEN s_nationkey % 5 = 0 THEN ' ' WHEN s_nationkey % 5 <> 1 THEN 'G' || s_nationkey END AS grp,
  CASE s_suppkey % 4 WHEN 0 THEN 'Erro' WHEN 1 THEN 'Descartada' WHEN 2 THEN 'Coberta e validada em produção' ELSE '' END AS status FROM supplier),
g AS (SELECT grp AS display_group, count(*) AS n_variants, arg_min(status, s_suppkey) AS first_status FROM s WHERE trim(coalesce(grp, '')) <> '' GROUP BY 1)
SELECT *, {STATUS_SQL.format('first_status')} AS badge FROM g""")
def q38(spark, sf):
    nation, kind = F.col("s_nationkey") % 5, F.col("s_suppkey") % 4
    rows = table(spark, sf, "supplier").select(
        "s_suppkey", F.when(nation == 0, " ").when(nation != 1, F.concat(F.lit("G"), F.col("s_nationkey").cast("string"))).alias("display_group"),
        F.when(kind == 0, "Erro").when(kind == 1, "Descartada").when(kind == 2, P.STATUS_OK).otherwise("").alias("status"))
    return reports.display_groups(rows, "display_group", "status", "s_suppkey")


@query("q47_listing_profile", """
WITH i AS (SELECT event_type, CASE WHEN user_id % 9 <> 0 THEN '/n/' || user_id END AS url, CASE WHEN event_id % 7 = 0 THEN '' ELSE props END AS title,
  CASE WHEN value < 300 THEN ts END AS published, CASE WHEN user_id % 4 <> 0 THEN 'c' || user_id % 5 END AS category FROM events)
SELECT event_type, count(*) AS n_rows, count(DISTINCT url) AS distinct_urls, count(*) FILTER (WHERE published IS NULL) AS missing_date,
  count(*) FILTER (WHERE title = '') AS missing_title, count(*) FILTER (WHERE url IS NULL) AS missing_url,
  count(*) FILTER (WHERE category IS NULL) AS missing_category, count(DISTINCT category) AS distinct_categories FROM i GROUP BY event_type""")
def q47(spark, sf):
    user = F.col("user_id")
    items = table(spark, sf, "events").select(
        "event_type", F.when(user % 9 != 0, F.concat(F.lit("/n/"), user.cast("string"))).alias("url"),
        F.when(F.col("event_id") % 7 == 0, "").otherwise(F.col("props")).alias("title"), F.when(F.col("value") < 300, F.col("ts")).alias("published"),
        F.when(user % 4 != 0, F.concat(F.lit("c"), (user % 5).cast("string"))).alias("category"))
    return reports.listing_profile(items, ["event_type"], "url", "title", "published", "category")


@query("q47_type_frequency", "SELECT lang AS kind, count(*) AS n FROM documents GROUP BY lang")
def q47_types(spark, sf):
    return reports.type_frequency(table(spark, sf, "documents").select(F.col("lang").alias("kind")), "kind")


@query("q47_years_mentioned", """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n_pages FROM orders GROUP BY 1""")
def q47_years(spark, sf):
    d = F.date_format("o_orderdate", "dd/MM/yyyy")
    pages = table(spark, sf, "orders").select(F.concat(F.lit("de "), d, F.lit(" até "), d, F.lit(" 1/2/99")).alias("text"))
    return reports.years_mentioned(pages, "text")


@query("q47_short_texts", """
SELECT count(*) FILTER (WHERE length(text) < 200) AS n_short, count(*) AS n_texts FROM documents""")
def q47_short(spark, sf):
    return reports.short_texts(table(spark, sf, "documents"), "text")


@query("q47_required_and_agreement", """
SELECT source, count(*) FILTER (WHERE doc_id % 8 = 0 OR lang = 'de') AS n_missing, count(*) FILTER (WHERE abs(length(text) - length(replace(text, 'the', ''))) < 200) AS n_agree FROM documents GROUP BY source""")
def q47_required(spark, sf):
    docs = table(spark, sf, "documents").select(
        "source", "text", F.replace("text", F.lit("the"), F.lit("")).alias("other"),
        F.when(F.col("doc_id") % 8 != 0, F.col("doc_id").cast("string")).alias("slug"),
        F.when(F.col("lang") == "de", "").otherwise(F.col("lang")).alias("date"))
    return docs.groupBy("source").agg(
        filters.missing_required(docs, ["slug", "date"]).alias("n_missing"),
        F.count_if(reports.extractors_agree(F.col("text"), F.col("other"))).alias("n_agree"))


@query("q52_run_summary", """
SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS saved, count(*) FILTER (WHERE event_type = 'error') AS failed,
  arg_max(props, ts) FILTER (WHERE event_type = 'error') AS last_error FROM events GROUP BY user_id""")
def q52(spark, sf):
    failed = F.col("event_type") == "error"
    outcomes = table(spark, sf, "events").select(
        "user_id", (~failed).alias("saved"), F.when(failed, F.col("props")).alias("error"), "ts")
    return reports.run_summary(outcomes, "user_id", "saved", "error", "ts")


@query("q52_table_counts", """
SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'documents', count(*) FROM documents""")
def q52_counts(spark, sf):
    return reports.table_counts({n: table(spark, sf, n) for n in ("orders", "customer", "documents")})


@query("q52_never_ran", f"""
SELECT c_custkey FROM customer WHERE ({STATUS}) LIKE '%Coberta%' AND c_custkey % 5 = 0""")
def q52_never(spark, sf):
    return reports.covered_but_never_ran(_catalogue(spark, sf), "status", "balance").select("c_custkey")


@query("q49_source_card", """
WITH c AS (SELECT c_custkey, [{'label': 'Setor', 'value': c_mktsegment}, {'label': 'Notas', 'value': CASE WHEN c_custkey % 2 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN 'NaN' ELSE 'a<b & c' END},
  {'label': 'Docs', 'value': CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS VARCHAR) END}] AS f FROM customer),
e AS (SELECT c_custkey, unnest(list_filter(f, lambda x: coalesce(x.value, '') NOT IN ('', 'NaN'))) AS x FROM c)
SELECT c_custkey, x.label AS label, replace(replace(x.value, '&', '&amp;'), '<', '&lt;') AS value FROM e""")
def q49_card(spark, sf):
    key = F.col("c_custkey")
    sources = table(spark, sf, "customer").select(
        "c_custkey", "c_mktsegment", F.when(key % 2 == 0, "").when(key % 3 == 0, "NaN").otherwise("a<b & c").alias("notes"),
        F.when(key % 5 != 0, F.col("c_nationkey")).alias("docs"))
    card = reports.source_card(sources, [("Setor", "c_mktsegment"), ("Notas", "notes"), ("Docs", "docs")])
    return card.select("c_custkey", "label", "value")


@query("q63_ordered_by_name", """
WITH c AS (SELECT c_name, c_mktsegment, lag(c_mktsegment) OVER (ORDER BY c_custkey) AS before FROM customer)
SELECT 'by name' AS taken, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_inversions FROM c
UNION ALL SELECT 'as written', count(*), CAST(count(*) FILTER (before > c_mktsegment) AS BIGINT) FROM c""")
def q63_ordered(spark, sf):
    """Names out of order across the whole table: none once it is sorted by name, and those of the order of the keys."""
    from acervo.operators.reports import by_name, inversions

    customer = table(spark, sf, "customer")
    done = inversions(by_name(customer.select("c_name"), "c_name"), "c_name").withColumn("taken", F.lit("by name"))
    raw = inversions(customer.orderBy("c_custkey").select("c_mktsegment"), "c_mktsegment").withColumn("taken", F.lit("as written"))
    return done.unionByName(raw).select("taken", "n_rows", "n_inversions")
