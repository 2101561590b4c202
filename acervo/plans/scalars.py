"""Dates, money, score, vocabulary and sentiment rules over rendered columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions import dates as D
from acervo.functions import score as S
from acervo.plans.registry import query, sql_list, table
from acervo.session import widen

MONTHS = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]


@query("q16_br_dates", """
WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d, o_orderkey % 10 = 0 AS broken FROM orders)
SELECT o_orderkey, d AS br, d AS loose, d AS stamped, d AS us, CASE WHEN NOT broken THEN d END AS long_pt,
       CASE WHEN NOT broken THEN d END AS month_first, d AS short_a, d AS short_b, d AS comma, d AS iso,
       CASE WHEN broken THEN '2026-01-01' ELSE d END AS rfc, d AS file_date, d AS edition_date FROM o""")
def q16(spark, sf):
    d = F.col("o_orderdate")
    broken = F.col("o_orderkey") % 10 == 0
    month = F.when(broken, F.lit("brumário")).otherwise(F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(d)))
    day, year = F.dayofmonth(d).cast("string"), F.year(d).cast("string")

    def text(fmt):
        return F.date_format(d, fmt)

    rendered = widen(table(spark, sf, "orders").select("o_orderkey", "o_orderdate")).select(
        "o_orderkey",
        F.concat(F.lit("x Publicado em: "), text("dd/MM/yyyy"), F.lit(" por y")).alias("br"),
        F.concat(day, F.lit("/"), text("MM/"), F.when(F.year(d) >= 2000, text("yy")).otherwise(text("yyyy"))).alias("loose"),
        F.concat(text("dd/MM/yyyy"), F.lit("|"), text("dd/MM/yy, HH:mm")).alias("stamped"),
        F.when(F.year(d) >= 2000, text("dd/MM/yy, HH:mm")).alias("stamp2000"),
        text("MM/dd/yyyy").alias("us"),
        F.concat(F.lit("Em "), day, F.lit(" de "), F.initcap(month), F.lit(" de "), year).alias("long_pt"),
        F.concat(month, F.lit(" "), day, F.lit(", "), year).alias("month_first"),
        text("MMM d, yyyy").alias("short_a"), text("d MMM yyyy").alias("short_b"), text("d MMM, yyyy").alias("comma"),
        text("yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        F.when(broken, "sem data").otherwise(F.concat(text("EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))).alias("rfc"),
        F.concat(F.lit("do_"), text("dd_MM_yyyy"), F.lit(".pdf")).alias("file_date"),
        F.concat(text("yyyy.MM.dd"), F.lit(".DOE_0.pdf")).alias("edition_date"))

    def c(name):
        return F.col(name)

    return rendered.select(
        "o_orderkey", D.br_date(c("br"), "Publicado em").alias("br"), D.loose_br_date(c("loose")).alias("loose"),
        F.coalesce(D.br_datetime(c("stamp2000")), D.br_date(c("stamped"))).alias("stamped"),
        D.us_date(c("us")).alias("us"), D.long_pt_date(c("long_pt")).alias("long_pt"),
        D.month_first_pt_date(c("month_first")).alias("month_first"), D.short_month_date(c("short_a")).alias("short_a"),
        D.short_month_date(c("short_b")).alias("short_b"), D.day_month_comma_date(c("comma")).alias("comma"),
        D.iso_slice(c("iso")).alias("iso"), D.rfc2822_date(c("rfc"), F.lit("2026-01-01")).alias("rfc"),
        D.underscore_file_date(c("file_date")).alias("file_date"), D.dotted_file_date(c("edition_date")).alias("edition_date"))


@query("q17_reference_date", """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS captured,
  CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN strftime(o_orderdate - INTERVAL 2 DAY, '%Y-%m-%dT10:00:00') WHEN 2 THEN 'garbage' END AS published,
  CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') END AS listed FROM orders)
SELECT o_orderkey,
  CAST(coalesce(CAST(try_strptime(left(coalesce(nullif(published, ''), nullif(listed, '')), 10), '%Y-%m-%d') AS DATE), captured) AS VARCHAR) AS reference,
  coalesce(CASE WHEN o_orderkey % 2 = 0 THEN nullif(published, '') END, nullif(listed, ''), '2026-01-01') AS lenient,
  coalesce(CASE WHEN o_orderkey % 2 = 0 THEN nullif(published, '') ELSE nullif(listed, '') END, '2026-01-01') AS strict FROM o""")
def q17(spark, sf):
    d, key = F.col("o_orderdate"), F.col("o_orderkey")
    docs = table(spark, sf, "orders").select(
        "o_orderkey", F.to_date(d).alias("captured"),
        F.when(key % 4 == 0, "").when(key % 4 == 1, F.concat(F.date_format(F.date_sub(d, 2), "yyyy-MM-dd"), F.lit("T10:00:00"))).when(
            key % 4 == 2, "garbage").alias("published"),
        F.when(key % 3 == 0, "").when(key % 3 == 1, F.date_format(F.date_sub(d, 1), "yyyy-MM-dd")).alias("listed"))
    page, listing = F.nullif("published", F.lit("")), F.nullif("listed", F.lit(""))
    rule, as_of = key % 2 == 0, F.lit("2026-01-01")
    return docs.select(
        "o_orderkey",
        D.reference_date(F.col("published"), F.col("listed"), F.col("captured")).cast("string").alias("reference"),
        D.captured_date(listing, page, rule, as_of).alias("lenient"),
        D.captured_date(listing, page, rule, as_of, strict=True).alias("strict"))


@query("q18_money", """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 1 THEN floor(o_totalprice / 1000) >= 100 WHEN 2 THEN floor(o_totalprice / 10000) >= 10
  WHEN 3 THEN floor(o_totalprice) >= 100000 ELSE false END AS relevant FROM orders""")
def q18(spark, sf):
    price, kind = F.col("o_totalprice"), F.col("o_orderkey") % 6
    whole = F.floor(price).cast("string")
    dotted = F.regexp_replace(whole, r"(\d)(\d{3})$", "$1.$2")
    amount = (
        F.when(kind == 0, F.concat(F.lit("Valor: R$ "), dotted, F.lit(",26 à vista")))
        .when(kind == 1, F.concat(F.lit("cerca de r$ "), F.floor(price / 1000).cast("string"), F.lit(" MILHÕES em obras")))
        .when(kind == 2, F.concat(F.lit("R$0,"), F.lpad(F.floor(price / 10000).cast("string"), 2, "0"), F.lit(" bi; R$ 1,2,3 bi")))
        .when(kind == 3, F.concat(F.lit("R$ 5 e R$ "), whole, F.lit(" mil")))
        .when(kind == 4, F.lit("R$ , milhões")).otherwise(F.lit("sem valor")))
    return table(spark, sf, "orders").select("o_orderkey", S.has_relevant_amount(amount).alias("relevant"))


@query("q19_relevance", """
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 WHEN o_orderpriority = '3-MEDIUM' THEN 2 ELSE 3 END AS level,
  o_custkey % 6 AS n, floor(o_totalprice / 1000) >= 100 AS money, CASE o_orderstatus WHEN 'F' THEN ['default', 'm_a'] WHEN 'P' THEN ['litigation'] ELSE [] END AS crit
  FROM orders JOIN customer ON c_custkey = o_custkey),
w AS (SELECT *, CASE level WHEN 1 THEN 1.0 WHEN 2 THEN 0.6 ELSE 0.3 END::DOUBLE AS pl, CASE WHEN n = 0 THEN 0.0 WHEN n = 1 THEN 0.5 WHEN n <= 3 THEN 0.75 ELSE 1.0 END::DOUBLE AS pp,
  CASE WHEN money THEN 1.0 ELSE 0.0 END::DOUBLE AS pm, CASE WHEN len(crit) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS pt FROM x),
s AS (SELECT *, format('{:.3f}', least(1.0::DOUBLE, 0.30::DOUBLE * pl + 0.35::DOUBLE * pp + 0.15::DOUBLE * pm + 0.20::DOUBLE * pt))::DOUBLE AS score FROM w)
SELECT o_orderkey, score, 'prioridade_fonte=' || level || '(peso ' || pl || ') x0.30 + portfolio=' || n || ' empresa(s)(peso ' || pp ||
  ') x0.35 + valor_monetario_relevante=' || CASE WHEN money THEN 'True' ELSE 'False' END || '(peso ' || pm || ') x0.15 + tags_criticas=[' ||
  CASE len(crit) WHEN 0 THEN '' WHEN 1 THEN '''litigation''' ELSE '''default'', ''m_a''' END || '](peso ' || pt || ') x0.20 = ' || score AS rationale FROM s""")
def q19(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey")
    docs = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey",
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1).when(F.col("o_orderpriority") == "3-MEDIUM", 2).otherwise(3).alias("level"),
        F.transform(F.sequence(F.lit(1), F.lit(7)), lambda i: F.struct((i <= F.col("o_custkey") % 6).alias("in_universe"))).alias("risks"),
        F.concat(F.lit("R$ "), F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit(" milhões")).alias("text"),
        F.when(F.col("o_orderstatus") == "F", F.array(F.lit("m_a"), F.lit("esg"), F.lit("default"))).when(
            F.col("o_orderstatus") == "P", F.array(F.lit("litigation"), F.lit("litigation"))).alias("tags"))
    from acervo.operators.enrich import scored

    return scored(docs, "text", "tags", "risks", "level").select(
        "o_orderkey", F.col("relevance_score").alias("score"), F.col("relevance_rationale").alias("rationale"))


VOCAB = sql_list(P.TAG_VOCABULARY)


@query("q20_vocab", f"""
WITH t AS (SELECT event_id, CASE event_type WHEN 'error' THEN ['default', 'inventada', 'default'] WHEN 'purchase' THEN ['m_a', 'esg']
  WHEN 'signup' THEN ['x', 'ipo', 'y', 'rating_change'] WHEN 'click' THEN ['Esg'] ELSE NULL END AS tags FROM events)
SELECT event_id, array_to_string(list_filter(tags, lambda t: list_contains({VOCAB}, t)), ',') AS allowed,
  array_to_string(list_filter(tags, lambda t: NOT list_contains({VOCAB}, t)), ',') AS rejected,
  CAST(coalesce(len(list_distinct(list_filter(tags, lambda t: list_contains({sql_list(P.CRITICAL_TAGS)}, t)))), 0) AS BIGINT) AS n_critical FROM t""")
def q20(spark, sf):
    kind = F.col("event_type")

    def words(*tags):
        return F.array(*[F.lit(t) for t in tags])

    tags = (F.when(kind == "error", words("default", "inventada", "default")).when(kind == "purchase", words("m_a", "esg"))
            .when(kind == "signup", words("x", "ipo", "y", "rating_change")).when(kind == "click", words("Esg")))
    return table(spark, sf, "events").select("event_id", tags.alias("tags")).select(
        "event_id", F.array_join(S.allowed_tags(F.col("tags")), ",").alias("allowed"),
        F.array_join(S.rejected_tags(F.col("tags")), ",").alias("rejected"),
        F.size(S.critical_tags(F.col("tags"))).cast("long").alias("n_critical"))


@query("q21_enum_clamp", """
WITH e AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'positivo' WHEN 'view' THEN 'Positivo' WHEN 'error' THEN 'negativo' END AS s,
  CASE event_type WHEN 'purchase' THEN NULL WHEN 'signup' THEN NULL ELSE value / 128 - 1 END AS v FROM events)
SELECT event_id, CASE WHEN s IN ('positivo','neutro','negativo') THEN s ELSE 'neutro' END AS sentiment,
  format('{:.3f}', greatest(-1.0::DOUBLE, least(1.0::DOUBLE, coalesce(v, 0.0::DOUBLE))))::DOUBLE AS score FROM e""")
def q21(spark, sf):
    kind = F.col("event_type")
    raw = F.when(kind == "purchase", "abc").when(kind != "signup", (F.col("value") / 128 - 1).cast("string"))
    said = F.when(kind == "click", "positivo").when(kind == "view", "Positivo").when(kind == "error", "negativo")
    return table(spark, sf, "events").select(
        "event_id", S.clean_sentiment(said).alias("sentiment"), S.clean_sentiment_score(raw).alias("score"))
