"""Streaming forms and sink round trips. Outputs go to the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from acervo import params as P
from acervo.functions import text as X
from acervo.functions import urls as U
from acervo.plans.registry import query, table
from acervo.session import ensure_checkpoint_dir
from acervo.sources import documents as SD
from acervo.sources import tables as ST
from acervo.streaming import incremental as I


def scratch(spark, name: str) -> str:
    """A new folder of its own for each run."""
    return f"{ensure_checkpoint_dir(spark)}/acervo-{name}-{uuid.uuid4().hex}"


def _stream(spark, sf):
    return I.read_folder(spark, sf, table(spark, sf, "events").schema, "events.parquet")


@query("q50_stream_dedup", """
SELECT DISTINCT event_type AS source_id, user_id AS key FROM events""")
def q50(spark, sf):
    out = scratch(spark, "seen")
    items = _stream(spark, sf).select(F.col("event_type").alias("source_id"), F.col("user_id").alias("key"))
    I.append_until_done(I.unseen(items, ["source_id", "key"]), f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table")


@query("q50_stream_fresh", """
SELECT event_id FROM events WHERE event_type = 'signup' OR ts >= TIMESTAMP '2024-01-29 12:00:00'""")
def q50_fresh(spark, sf):
    out = scratch(spark, "fresh")
    items = _stream(spark, sf).select("event_id", F.when(F.col("event_type") != "signup", F.col("ts")).alias("published"))
    kept = I.fresh(items, "published", F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"))
    I.append_until_done(kept, f"{out}/table", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/table").select("event_id")


@query("q50_stream_batches", """
SELECT event_id, 'dated' AS branch FROM events WHERE event_id % 50 <> 7 AND NOT (event_id % 50 = 9 AND ts < TIMESTAMP '2024-01-05')
UNION ALL SELECT event_id, 'undated' FROM events WHERE event_id % 50 = 7""")
def q50_batches(spark, sf):
    """Three batches of ten days. Each repeats the last half day of the one before and all undated items; the third also
    brings items of the first days, too late for the watermark. Dated items go by the watermark, undated by the manifest."""
    out = scratch(spark, "batches")
    events = table(spark, sf, "events").select("event_id", "ts")
    late, undated = (F.col("event_id") % 50 == 9) & (F.col("ts") < F.lit("2024-01-05").cast("timestamp_ntz")), F.col("event_id") % 50 == 7
    ends = [F.lit(d).cast("timestamp_ntz") for d in ("2024-01-01", "2024-01-11", "2024-01-21", "2100-01-01")]
    for n in range(3):
        own = (F.col("ts") >= ends[n] - F.expr("interval 12 hours")) & (F.col("ts") < ends[n + 1]) & ~late
        part = events.filter(undated | own | (late if n == 2 else F.lit(False)))
        part.select("event_id", F.when(~undated, F.col("ts")).cast("timestamp").alias("published")).coalesce(1).write.mode("append").parquet(f"{out}/in")
    stream = I.read_folder(spark, f"{out}/in", spark.read.parquet(f"{out}/in").schema, files_per_batch=1)
    dated, undated_items = I.dated_and_undated(stream, "published")
    I.append_until_done(I.unseen_within(dated, ["event_id"], "published"), f"{out}/dated", f"{out}/c1")
    I.each_batch(undated_items, I.manifest_sink(f"{out}/undated", ["event_id"], [F.col("event_id")]), f"{out}/c2")
    return spark.read.parquet(f"{out}/dated").select("event_id", F.lit("dated").alias("branch")).unionByName(
        spark.read.parquet(f"{out}/undated/items").select("event_id", F.lit("undated").alias("branch")))


@query("q50_stream_status", r"""
WITH s AS (SELECT DISTINCT source AS source_id FROM documents),
r AS (SELECT 'src' || (user_id % 40 + 1) AS source_id, event_type <> 'error' AS ok, CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS docs,
  row_number() OVER (PARTITION BY user_id % 40 ORDER BY ts DESC) AS rn FROM events)
SELECT s.source_id, CASE WHEN ok IS NULL THEN 'Não iniciada' WHEN ok THEN 'Coberta e validada em produção' ELSE 'Erro' END AS status, docs AS docs_captured
FROM s LEFT JOIN r ON r.source_id = s.source_id AND rn = 1""")
def q50_status(spark, sf):
    out = scratch(spark, "status")
    sources = table(spark, sf, "documents").select(F.col("source").alias("source_id")).distinct().select(
        "source_id", F.lit("Não iniciada").alias("status"), F.lit(None).cast("timestamp_ntz").alias("last_run"),
        F.lit(None).cast("long").alias("docs_captured"), F.lit(None).cast("string").alias("last_error"))
    ST.replace_table(sources, f"{out}/catalogue")
    runs = _stream(spark, sf).select(
        F.concat(F.lit("src"), (F.col("user_id") % 40 + 1).cast("string")).alias("source_id"), (F.col("event_type") != "error").alias("ok"),
        F.get_json_object("props", "$.k").cast("long").alias("docs"), F.lit(None).cast("string").alias("error"), F.col("ts").alias("run_at"))
    I.each_batch(runs, I.status_sink(f"{out}/catalogue"), f"{out}/checkpoint")
    return ST.read_table(spark, f"{out}/catalogue").select("source_id", "status", "docs_captured")


@query("q58_document_table", """
SELECT source AS source_id, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents GROUP BY source""")
def q58(spark, sf):
    out = scratch(spark, "documents")
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("source_id"), F.substring("text", 1, 60).alias("title"),
        F.concat(F.lit("https://x.example.com/"), F.col("doc_id").cast("string")).alias("url"), "text",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 3).cast("int")).cast("string").alias("date"))
    SD.write_documents(docs, out)
    back = spark.read.parquet(out)
    return back.groupBy("source_id").agg(F.count("*").alias("n_docs"), F.sum(F.length("text")).cast("long").alias("n_chars"))


@query("q58_json_and_quotes", """
SELECT c_custkey, 'it''s "' || c_name || '"' AS note, c_mktsegment AS sector FROM customer""")
def q58_json(spark, sf):
    out = scratch(spark, "json")
    records = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("it's \""), "c_name", F.lit("\"")).alias("note"), F.col("c_mktsegment").alias("sector"))
    ST.write_json_records(records, out, F.lit("2024-01-31"))
    return spark.read.schema("c_custkey bigint, note string, sector string").json(out).drop("day")


@query("q58_csv_with_summary", """
SELECT count(*) AS n_rows, '{"region":"BR"}' AS filters, count(DISTINCT l_suppkey) AS n_issuers FROM lineitem WHERE l_returnflag = 'R'""")
def q58_csv(spark, sf):
    out = scratch(spark, "csv")
    rows = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_suppkey")
    ST.write_csv_with_summary(rows, out, {"region": "BR"})
    issuers = spark.read.schema("l_orderkey bigint, l_linenumber int, l_suppkey bigint").option("header", True).csv(
        f"{out}/rows").agg(F.countDistinct("l_suppkey").alias("n_issuers"))
    summary = spark.read.schema("n_rows bigint, filters string").json(f"{out}/summary")
    both = summary.unionByName(issuers, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("n_rows", "filters", "n_issuers")])


@query("q58_versions", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'changed' ELSE c_mktsegment END AS sector FROM customer WHERE c_acctbal >= 0""")
def q58_versions(spark, sf):
    from acervo.operators.catalogue import delete_where, update_where

    out = scratch(spark, "catalogue")
    ST.replace_table(table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("sector"), "c_acctbal"), out)
    ST.replace_table(delete_where(ST.read_table(spark, out), F.col("c_acctbal") < 0), out)
    ST.replace_table(update_where(ST.read_table(spark, out), F.col("sector") == "BUILDING", {"sector": F.lit("changed")}), out)
    return ST.read_table(spark, out).select("c_custkey", "sector")


@query("q58_migrated_tab", """
SELECT s_suppkey IS NOT NULL AND s_suppkey % 4 <> 0 AS kept, count(*) AS n, CAST(sum(CASE WHEN s_suppkey % 4 <> 0 THEN s_nationkey END) AS BIGINT) AS nations FROM supplier GROUP BY 1""")
def q58_tab(spark, sf):
    tab = table(spark, sf, "supplier").select(
        F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).alias("Fonte"), F.col("s_nationkey").cast("string").alias("Nº"), F.lit(None).alias("Dono"))
    good, bad = ST.migrate_tab(tab, {"Fonte": "name", "Nº": "number", "Dono": "owner"}, {"number": "int"}, "name")
    return good.agg(F.count("*").alias("n"), F.sum("number").cast("long").alias("nations")).withColumn("kept", F.lit(True)).unionByName(
        bad.agg(F.count("*").alias("n")).withColumns({"nations": F.lit(None).cast("long"), "kept": F.lit(False)}))


@query("q58_create_guard", """
SELECT 'sources' AS name, count(*) AS n, true AS refused_again FROM supplier UNION ALL SELECT 'blocks', count(*), true FROM customer""")
def q58_guard(spark, sf):
    """Two control tables are created in the catalog; a second run is refused and changes nothing."""
    out = scratch(spark, "guard")
    run = out.rsplit("-", 1)[-1]
    tables = {f"acervo_{name}_{run}": table(spark, sf, source) for name, source in (("sources", "supplier"), ("blocks", "customer"))}
    ST.create_tables(tables, out)
    try:
        ST.create_tables({name: df.limit(0) for name, df in tables.items()}, out)
        refused = False
    except ValueError:
        refused = True
    counts = [spark.table(name).agg(F.count("*").alias("n")).select(F.lit(name.split("_")[1]).alias("name"), "n") for name in tables]
    return counts[0].unionByName(counts[1]).withColumn("refused_again", F.lit(refused))


@query("q58_absolute_urls", r"""
SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) || '/a/' || page_id AS rooted,
  regexp_extract(url, '^https?://', 0) || 'other.example.com/x' AS schemeless, 'https://y.example.com/' AS full_url FROM pages""")
def q58_urls(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return pages.select(
        "page_id", U.absolute(F.col("url"), F.concat(F.lit("/b/../a/"), F.col("page_id").cast("string"))).alias("rooted"),
        U.absolute(F.col("url"), F.lit("//other.example.com/x")).alias("schemeless"),
        U.absolute(F.col("url"), F.lit("https://y.example.com/")).alias("full_url"))


@query("q58_prompt_inputs", """
SELECT doc_id, CAST(least(length(text), 4000) AS BIGINT) AS n_prompt, CAST(least(length(text), 8000) AS BIGINT) AS n_embedding, md5(CAST(doc_id AS VARCHAR)) AS record_id FROM documents""")
def q58_prompts(spark, sf):
    from acervo.functions.replies import prompt_text

    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", F.length(prompt_text(text)).cast("long").alias("n_prompt"),
        F.length(prompt_text(text, P.EMBEDDING_CHARS)).cast("long").alias("n_embedding"),
        X.synthetic_key(F.col("doc_id")).alias("record_id"))


@query("q58_pages_with_links", r"""
WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS href FROM pages),
n AS (SELECT page_id, count(*) AS n_links FROM l GROUP BY 1)
SELECT p.page_id, coalesce(n_links, 0) AS n_links, length(html) AS n_text_chars, coalesce(n_links, 0) AS n_child_rows
FROM pages p LEFT JOIN n ON n.page_id = p.page_id""")
def q58_pages(spark, sf):
    out = scratch(spark, "pages")
    pages = table(spark, sf, "pages").select("page_id", F.col("html").alias("text"))
    links = pages.select("page_id", F.explode(F.regexp_extract_all("text", F.lit('href="([^"]+)"'), F.lit(1))).alias("href"))
    SD.write_pages_with_links(pages, links, out)
    child = spark.read.parquet(f"{out}/links").groupBy("page_id").agg(F.count("*").alias("n_child_rows"))
    return spark.read.parquet(f"{out}/pages").join(child, "page_id", "left").select(
        "page_id", "n_links", F.col("n_text_chars").cast("long").alias("n_text_chars"), F.coalesce("n_child_rows", F.lit(0)).alias("n_child_rows"))


@query("q58_current_and_history", """
SELECT 'current' AS kind, source, count(*) AS n FROM documents WHERE doc_id % 2 = 1 GROUP BY ALL
UNION ALL SELECT 'history 2024-01-30', source, count(*) FROM documents WHERE doc_id % 2 = 0 GROUP BY ALL
UNION ALL SELECT 'history 2024-01-31', source, count(*) FROM documents WHERE doc_id % 2 = 1 GROUP BY ALL""")
def q58_history(spark, sf):
    """Two runs: the current report is the last one, the history holds both."""
    out = scratch(spark, "report")
    docs = table(spark, sf, "documents").select("doc_id", "source")
    for day, odd in (("2024-01-30", 0), ("2024-01-31", 1)):
        ST.write_current_and_history(docs.filter(F.col("doc_id") % 2 == odd), out, day)
    past = spark.read.option("basePath", f"{out}/history").parquet(f"{out}/history").withColumn(
        "kind", F.concat(F.lit("history "), F.col("date").cast("string")))
    both = past.select("kind", "source").unionByName(spark.read.parquet(f"{out}/current").select(F.lit("current").alias("kind"), "source"))
    return both.groupBy("kind", "source").agg(F.count("*").alias("n"))


@query("q58_manifest_runs", """
SELECT event_type AS source_id, CAST(user_id AS VARCHAR) AS key FROM events GROUP BY ALL""")
def q58_manifest(spark, sf):
    """Two runs over a manifest that is absent at first; the second adds what the first has not seen."""
    out = scratch(spark, "manifest")
    items = table(spark, sf, "events").select("event_id", F.col("event_type").alias("source_id"), F.col("user_id").cast("string").alias("key"))
    from acervo.operators.dedup import new_items
    for part in (items.filter("event_id % 3 = 0"), items):
        SD.append_manifest(new_items(part, SD.read_manifest(spark, out), ["source_id", "key"]), out, F.lit("2024-01-31").cast("timestamp"))
    return SD.read_manifest(spark, out).select("source_id", "key")
