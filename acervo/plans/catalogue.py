"""Source catalogue queries: status upsert, lookups, block match, ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo.functions import score as S
from acervo.functions import text as X
from acervo.operators import catalogue as K
from acervo.plans.registry import query, table

STATUS_SQL = """CASE WHEN contains(lower(coalesce({0}, '')), 'validada em produção') OR contains(lower(coalesce({0}, '')), 'coberta indiretamente') THEN 'badge-ok'
  WHEN contains(lower(coalesce({0}, '')), 'erro') OR contains(lower(coalesce({0}, '')), 'bloquead') THEN 'badge-erro'
  WHEN contains(lower(coalesce({0}, '')), 'descartada') THEN 'badge-descartada' ELSE 'badge-medio' END"""


@query("q06_status_merge", rf"""
WITH s AS (SELECT DISTINCT source AS source_id, lang AS name, 'Não iniciada' AS status FROM documents),
r AS (SELECT 'src' || (user_id % 40 + 1) AS source_id, event_type <> 'error' AS ok, CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS docs,
  CASE WHEN event_type = 'error' THEN 'it''s ' || event_id END AS error, ts, event_id, row_number() OVER (PARTITION BY user_id % 40 ORDER BY ts DESC, event_id DESC) AS rn FROM events),
m AS (SELECT s.source_id, s.name, CASE WHEN r.ok IS NULL THEN s.status WHEN r.ok THEN 'Coberta e validada em produção' ELSE 'Erro' END AS status,
  strftime(r.ts, '%Y-%m-%d %H:%M:%S') AS last_run, r.docs AS docs_captured, CASE WHEN NOT r.ok THEN r.error END AS last_error FROM s LEFT JOIN r ON r.source_id = s.source_id AND rn = 1)
SELECT *, {STATUS_SQL.format('status')} AS badge FROM m""")
def q06(spark, sf):
    sources = table(spark, sf, "documents").select(F.col("source").alias("source_id"), F.col("lang").alias("name")).distinct().select(
        "source_id", "name", F.lit("Não iniciada").alias("status"), F.lit(None).cast("timestamp_ntz").alias("last_run"),
        F.lit(None).cast("long").alias("docs_captured"), F.lit(None).cast("string").alias("last_error"))
    runs = table(spark, sf, "events").select(
        F.concat(F.lit("src"), (F.col("user_id") % 40 + 1).cast("string")).alias("source_id"),
        (F.col("event_type") != "error").alias("ok"), F.get_json_object("props", "$.k").cast("long").alias("docs"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("it's "), F.col("event_id").cast("string"))).alias("error"),
        F.col("ts").alias("run_at"), "event_id")
    merged = K.upsert_run_status(sources, runs.drop("event_id"), "source_id", [F.col("run_at")])
    return merged.withColumns({
        "last_run": F.date_format("last_run", "yyyy-MM-dd HH:mm:ss"), "badge": S.status_class(F.col("status"))})


KIND_SQL = "CASE c_nationkey % 4 WHEN 0 THEN 'Diário Oficial' WHEN 1 THEN 'Associação' WHEN 2 THEN 'Agência de Rating' ELSE 'Outra' END"
IMPORTANCE_SQL = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Alta' WHEN 'BUILDING' THEN 'Média' WHEN 'FURNITURE' THEN 'Media' WHEN 'HOUSEHOLD' THEN 'Baixa' WHEN 'MACHINERY' THEN {0} END"


def _importance(machinery):
    return (F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Alta").when(F.col("c_mktsegment") == "BUILDING", "Média")
            .when(F.col("c_mktsegment") == "FURNITURE", "Media").when(F.col("c_mktsegment") == "HOUSEHOLD", "Baixa").otherwise(machinery))


@query("q07_lookup_defaults", f"""
WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 10 = 0 THEN 'x' || o_custkey ELSE 'c' || o_custkey END AS source_id FROM orders),
s AS (SELECT 'c' || c_custkey AS source_id, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment ELSE '' END AS sector,
  {IMPORTANCE_SQL.format("NULL")} AS importance, {KIND_SQL} AS kind FROM customer)
SELECT o_orderkey, coalesce(s.name, nullif(d.source_id, ''), 'Desconhecida') AS source_name, coalesce(nullif(sector, ''), 'Não classificado') AS subarea,
  CAST(CASE importance WHEN 'Alta' THEN 1 WHEN 'Média' THEN 2 WHEN 'Media' THEN 2 ELSE 3 END AS BIGINT) AS priority,
  CASE kind WHEN 'Diário Oficial' THEN 'regulatorio' WHEN 'Associação' THEN 'doc_corporativo' WHEN 'Agência de Rating' THEN 'rating' ELSE 'noticia' END AS source_type
FROM d LEFT JOIN s ON s.source_id = d.source_id AND d.source_id <> ''""")
def q07(spark, sf):
    key = F.col("o_orderkey")
    cust = F.col("o_custkey").cast("string")
    docs = table(spark, sf, "orders").select("o_orderkey", F.when(key % 11 == 0, "").when(
        key % 10 == 0, F.concat(F.lit("x"), cust)).otherwise(F.concat(F.lit("c"), cust)).alias("source_id"))
    nation = F.col("c_nationkey") % 4
    sources = table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("source_id"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_name")).alias("name"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).otherwise("").alias("sector"),
        _importance(F.lit(None).cast("string")).alias("importance"),
        F.when(nation == 0, "Diário Oficial").when(nation == 1, "Associação").when(nation == 2, "Agência de Rating").otherwise("Outra").alias("kind"))
    looked = K.lookup_source(docs, K.source_dimension(sources, [F.col("source_id")]))
    return looked.select("o_orderkey", "source_name", "subarea", F.col("priority").cast("long").alias("priority"), "source_type")


@query("q38_covering_name", """
SELECT c.c_custkey, CASE WHEN c.c_custkey % 3 = 0 THEN coalesce(p.c_name, 'c' || (c.c_custkey + 700)) END AS covered_via
FROM customer c LEFT JOIN customer p ON p.c_custkey = c.c_custkey + 700""")
def q38_covering(spark, sf):
    key = F.col("c_custkey")
    sources = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("c"), key.cast("string")).alias("source_id"), F.col("c_name").alias("name"),
        F.when(key % 3 == 0, F.concat(F.lit("c"), (key + 700).cast("string"))).alias("covered_by"))
    return K.with_covering_name(sources).select("c_custkey", "covered_via")


@query("q39_block_match", """
WITH b AS (SELECT c_custkey, 'Falha em SUPPLIER#' || lpad(CAST(c_custkey % 150 AS VARCHAR), 9, '0') AS name,
  CASE WHEN c_custkey % 2 = 0 THEN 'supplier#' || lpad(CAST(c_custkey % 40 AS VARCHAR), 9, '0') || ' e outras' END AS affected FROM customer)
SELECT s_suppkey, c_custkey FROM supplier JOIN b ON contains(lower(b.name), lower(s_name)) OR contains(lower(coalesce(b.affected, '')), lower(s_name))""")
def q39(spark, sf):
    def supplier_name(n):
        return F.lpad((F.col("c_custkey") % n).cast("string"), 9, "0")

    blocks = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("Falha em SUPPLIER#"), supplier_name(150)).alias("name"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("supplier#"), supplier_name(40), F.lit(" e outras"))).alias("affected"))
    sources = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return K.match_blocks(sources, blocks, "s_name", ["name", "affected"]).select("s_suppkey", "c_custkey")


@query("q41_next_ids", """
WITH b AS (SELECT max(s_suppkey) + 1 AS nxt FROM supplier WHERE s_acctbal > 0)
SELECT printf('blq_%03d', CAST(nxt + row_number() OVER (ORDER BY s_suppkey) AS INTEGER)) AS id, s_name AS name FROM supplier, b WHERE s_acctbal <= 0""")
def q41(spark, sf):
    suppliers = table(spark, sf, "supplier")
    blocks = suppliers.filter("s_acctbal > 0").select(
        K.block_id((F.col("s_suppkey") + 1).cast("int")).alias("id"), F.col("s_name").alias("name"))
    rows = suppliers.filter("s_acctbal <= 0").select("s_suppkey", F.col("s_name").alias("name"))
    return K.append_blocks(blocks, rows, "s_suppkey").join(rows, "name", "left_semi").select("id", "name")


@query("q41_tagged_union", """
WITH u AS (SELECT 0 AS part, 'bloqueado' AS type, s_suppkey, s_name AS name, 'equipe' AS owner FROM supplier WHERE s_acctbal < 2000
  UNION ALL SELECT 1, 'descartado', s_suppkey, s_name, NULL FROM supplier WHERE s_acctbal > 8000)
SELECT printf('blq_%03d', CAST(row_number() OVER (ORDER BY part, s_suppkey) AS INTEGER)) AS id, type, name, owner FROM u""")
def q41_union(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("name"), "s_acctbal")
    blocked = suppliers.filter("s_acctbal < 2000").withColumn("owner", F.lit("equipe"))
    discarded = suppliers.filter("s_acctbal > 8000")
    return K.tagged_union([("bloqueado", blocked), ("descartado", discarded)], "s_suppkey").select("id", "type", "name", "owner")


@query("q43_list_append", """
WITH l AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ' t1,, t2 ,' WHEN 2 THEN 'novo, t3' ELSE '' END AS tasks FROM customer)
SELECT c_custkey, CASE c_custkey % 4 WHEN 1 THEN 't1, t2, novo' WHEN 2 THEN 'novo, t3' ELSE 'novo' END AS tasks FROM l""")
def q43(spark, sf):
    kind = F.col("c_custkey") % 4
    tasks = F.when(kind == 1, " t1,, t2 ,").when(kind == 2, "novo, t3").when(kind == 3, "")
    return table(spark, sf, "customer").select("c_custkey", X.append_to_list(tasks, F.lit("novo")).alias("tasks"))


@query("q43_entity_lines", """
WITH e AS (SELECT p_partkey, p_name, [p_name, upper(p_type), 'A B', upper(substring(p_brand, 1, 5)) || p_partkey % 100, 'XYZ11'] AS aliases FROM part),
t AS (SELECT p_partkey, p_name, list_filter(aliases, lambda a: a = upper(a) AND a <> lower(a) AND NOT contains(a, ' ') AND length(a) <= 8)[1:2] AS tk FROM e)
SELECT p_partkey, '- ' || p_name || CASE WHEN len(tk) > 0 THEN ' (' || array_to_string(tk, ', ') || ')' ELSE '' END AS line FROM t""")
def q43_lines(spark, sf):
    aliases = F.array(F.col("p_name"), F.upper("p_type"), F.lit("A B"),
                      F.concat(F.upper(F.substring("p_brand", 1, 5)), (F.col("p_partkey") % 100).cast("string")), F.lit("XYZ11"))
    return table(spark, sf, "part").select("p_partkey", X.entity_line(F.col("p_name"), aliases).alias("line"))


@query("q57_patterns", """
SELECT n_name, CASE WHEN n_name ILIKE '%nation_1%' THEN 'one' WHEN n_regionkey IN (0, 4) THEN 'edge' WHEN n_name NOT ILIKE '%2%' AND n_regionkey NOT IN (3) THEN 'rest' END AS class,
  count(c_custkey) AS n_customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, n_regionkey""")
def q57(spark, sf):
    name, region = F.col("n_name"), F.col("n_regionkey")
    kind = (F.when(name.ilike("%nation_1%"), "one").when(region.isin(0, 4), "edge")
            .when(~name.ilike("%2%") & ~region.isin(3), "rest"))
    nation, customer = table(spark, sf, "nation"), table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    counts = customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return nation.join(counts, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "n_name", kind.alias("class"), F.coalesce("n", F.lit(0)).alias("n_customers"))


@query("q57_placeholder_check", """
SELECT count(*) FILTER (WHERE c_name = 'Customer#000000007') AS with_name,
  count(*) FILTER (WHERE 'c' || c_custkey = 'c7' AND c_name <> 'Customer#000000007') AS id_elsewhere FROM customer""")
def q57_presence(spark, sf):
    sources = table(spark, sf, "customer").select("c_name", F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("source_id"))
    return K.presence(sources, F.col("c_name") == "Customer#000000007", F.col("source_id") == "c7")


@query("q57_sector_preview", """
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS covered_by FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 10""")
def q57_preview(spark, sf):
    chosen = K.choose_sources(table(spark, sf, "customer"), "BUILDING", "c_mktsegment")
    return K.add_column_if_missing(chosen.orderBy("c_custkey").limit(10), "covered_by", "string").select("c_custkey", "c_name", "covered_by")


@query("q40_recent_runs", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y %H:%M') AS shown FROM orders WHERE o_orderstatus <> 'P' ORDER BY o_orderdate DESC, o_orderkey LIMIT 20""")
def q40(spark, sf):
    from acervo.functions import dates as D
    from acervo.operators.reports import recent_runs

    runs = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("last_run"))
    return recent_runs(runs, "last_run", "o_orderkey").select("o_orderkey", D.display_time(F.col("last_run")).alias("shown"))
