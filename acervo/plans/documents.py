"""Document scans, filters, first-wins and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo.functions import text as X
from acervo.operators import dedup, filters, ordered, reports
from acervo.plans.registry import query, table
from acervo.session import widen
from acervo.sources.documents import last_days

AS_OF_DAY = "2024-01-15"
MARKERS = ["license", "disgusting", "worthless"]
GAZETTE = ["license", "Eaux", "disgusting", "étion", "pathetic", "of the"]


@query("q01_seven_day_union", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_docs,
       min(CAST(CAST(ts AS DATE) AS VARCHAR) || '_' || event_id) AS first_file_id
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-15' GROUP BY 1""")
def q01(spark, sf):
    docs = last_days(table(spark, sf, "events").select("ts", "event_id"), "ts", AS_OF_DAY, 7)
    named = docs.withColumn("day", F.to_date("ts").cast("string")).withColumn(
        "file_id", F.concat_ws("_", "day", F.col("event_id").cast("string")))
    return named.groupBy("day").agg(F.count("*").alias("n_docs"), F.min("file_id").alias("first_file_id"))


@query("q02_min_length", """
SELECT source, count(*) FILTER (WHERE length(text) >= 200) AS n_kept,
       count(*) FILTER (WHERE length(text) < 200) AS n_short FROM documents GROUP BY source""")
def q02(spark, sf):
    docs = table(spark, sf, "documents").select("source", F.length("text").alias("n"))
    return docs.groupBy("source").agg(
        F.count_if(F.col("n") >= 200).alias("n_kept"), F.count_if(F.col("n") < 200).alias("n_short"))


@query("q02_kept_documents", """
SELECT doc_id, length(text) AS n_chars FROM documents WHERE length(text) >= 200""")
def q02_kept(spark, sf):
    return filters.long_enough(table(spark, sf, "documents")).select("doc_id", F.length("text").cast("long").alias("n_chars"))


@query("q03_marker_filter", """
WITH d AS (SELECT doc_id, lower(substring(text, 1, 1500)) AS head FROM documents)
SELECT doc_id FROM d WHERE NOT (contains(head, 'license') OR contains(head, 'disgusting') OR contains(head, 'worthless'))""")
def q03(spark, sf):
    return filters.readable(table(spark, sf, "documents"), "text", MARKERS).select("doc_id")


@query("q04_window_null_kept", """
WITH e AS (SELECT event_id, event_type, CASE WHEN event_type = 'signup' THEN NULL ELSE ts END AS published FROM events)
SELECT event_type, count(*) AS n_kept, count(*) FILTER (WHERE published IS NULL) AS n_undated
FROM e WHERE published IS NULL OR published >= TIMESTAMP '2024-01-29 12:00:00' GROUP BY event_type""")
def q04(spark, sf):
    events = table(spark, sf, "events").select(
        "event_type", F.when(F.col("event_type") != "signup", F.col("ts")).alias("published"))
    as_of = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return filters.fresh(events, "published", as_of).groupBy("event_type").agg(
        F.count("*").alias("n_kept"), F.count_if(F.col("published").isNull()).alias("n_undated"))


@query("q05_manifest_anti", """
SELECT source AS source_id, count(*) AS n_new FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY source""")
def q05(spark, sf):
    items = table(spark, sf, "documents").select(F.col("source").alias("source_id"), F.col("doc_id").alias("key"))
    manifest = table(spark, sf, "labels").select(F.col("doc_id").alias("key"))
    return dedup.new_items(items, manifest, ["key"]).groupBy("source_id").agg(F.count("*").alias("n_new"))


@query("q05_manifest_extend", """
SELECT key FROM (SELECT doc_id AS key FROM labels UNION SELECT doc_id FROM documents WHERE length(text) >= 200)""")
def q05_extend(spark, sf):
    seen = table(spark, sf, "labels").select(F.col("doc_id").alias("key"))
    accepted = filters.long_enough(table(spark, sf, "documents")).select(F.col("doc_id").alias("key"))
    return dedup.extend_manifest(seen, accepted, ["key"])


@query("q08_duplicate_keys", """
WITH k AS (SELECT md5(text) AS key, doc_id FROM documents)
SELECT key, doc_id, n FROM (SELECT key, doc_id, count(*) OVER (PARTITION BY key) AS n FROM k) WHERE n > 1""")
def q08(spark, sf):
    keyed = table(spark, sf, "documents").select(F.md5("text").alias("key"), "doc_id")
    return dedup.duplicate_keys(keyed, "key", "doc_id")


@query("q25_systematic_sample", """
WITH days AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
plan AS (SELECT source, n, greatest(1, CAST(round_even(120.0 * n / sum(n) OVER (), 0) AS BIGINT)) AS quota FROM days),
stepped AS (SELECT *, greatest(1, n // quota) AS step FROM plan),
taken AS (SELECT *, least(quota, CAST(ceil(n / step) AS BIGINT)) AS taken FROM stepped),
offsets AS (SELECT *, coalesce(sum(taken) OVER (ORDER BY source DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM taken),
pos AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS p FROM documents)
SELECT doc_id, source, CAST(before + p // step AS BIGINT) AS sample_position
FROM pos JOIN offsets USING (source)
WHERE p % step = 0 AND p // step < taken AND before + p // step < 120""")
def q25(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return ordered.systematic_sample(docs, "source", "doc_id")


GAZETTE_SQL = " ".join(
    f"CASE WHEN contains(f, upper(regexp_replace(strip_accents('{t}'), '[^\\x00-\\x7F]+', '', 'g'))) THEN '{t}' END," for t in GAZETTE)


@query("q34_keyword_pages", f"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS page_no FROM documents),
f AS (SELECT doc_id, page_no, line, upper(regexp_replace(strip_accents(line), '[^\\x00-\\x7F]+', '', 'g')) AS f FROM lines),
m AS (SELECT doc_id, page_no, line, list_filter([{GAZETTE_SQL.rstrip(',')}], lambda x: x IS NOT NULL) AS terms FROM f)
SELECT doc_id, CAST(page_no AS BIGINT) AS page_no, array_to_string(terms, ', ') AS terms,
       '--- Página ' || page_no || ' (termos: ' || array_to_string(terms, ', ') || ') ---' || chr(10) || trim(line) AS block
FROM m WHERE len(terms) > 0""")
def q34(spark, sf):
    pages = widen(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).select(
        "doc_id", (F.col("p") + 1).cast("long").alias("page_no"), "line")
    kept = filters.keyword_pages(pages, "line", GAZETTE)
    blocks = reports.page_blocks(kept, "doc_id", "page_no", "terms", "line")
    # the block holds number and terms already; the terms come along for reading
    return blocks.withColumn("terms", F.regexp_extract("block", r"termos: ([^)]*)\)", 1))


@query("q42_set_difference", """
SELECT DISTINCT o_custkey AS custkey FROM orders WHERE o_totalprice > 400000
EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def q42_difference(spark, sf):
    orders = table(spark, sf, "orders")
    mentioned = orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("custkey"))
    with_file = orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("custkey"))
    return dedup.only_in_left(mentioned, with_file, ["custkey"])


@query("q42_set_intersection", """
SELECT l_orderkey AS orderkey FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'""")
def q42_intersection(spark, sf):
    left = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("orderkey"))
    right = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("orderkey"))
    return dedup.in_both(left, right, ["orderkey"])


@query("q49_escape_insert", """
WITH d AS (SELECT doc_id, text, substring(text, 40, 12) AS title FROM documents),
e AS (SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS x, text, title FROM d)
SELECT doc_id,
       md5(CASE WHEN lower(trim(text)) IN ('none','nan','nat','') THEN '' ELSE replace(x, chr(10), '<br>') END) AS escaped,
       md5(CASE WHEN strpos(text, title) > 0 AND title <> '' THEN trim(substring(text, strpos(text, title))) ELSE trim(text) END) AS cut,
       md5(CASE WHEN doc_id % 2 = 0 THEN '<body>' || doc_id || '<p></p></body>' ELSE doc_id || '<p></p>' END) AS report
FROM e""")
def q49(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", F.substring("text", 40, 12).alias("title"))
    report = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<body>"), F.col("doc_id").cast("string"), F.lit("</body>"))
                    ).otherwise(F.col("doc_id").cast("string"))
    return docs.select(
        "doc_id", F.md5(X.escape_html(F.col("text"), multiline=True)).alias("escaped"),
        F.md5(X.cut_before(F.col("text"), F.col("title"))).alias("cut"),
        F.md5(X.insert_before_body_end(report, F.lit("<p></p>"))).alias("report"))
