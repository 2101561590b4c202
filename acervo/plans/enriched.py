"""Flagship: documents, replies, vectors and catalogue to scored, clustered records."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo.operators import catalogue as K
from acervo.operators import clusters as G
from acervo.operators import enrich as N
from acervo.operators import entities as E
from acervo.plans.clusters import LEADERS, THRESHOLD
from acervo.plans.registry import query, sql_slug, table
from acervo.session import cut_lineage

DOCS_SQL = LEADERS.replace(
    "d AS (SELECT vec_id, vec_id % 30 AS day, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)",
    "d AS (SELECT vec_id, vec_id % 30 AS day, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents))")
TITLE_SQL = "'Notícia ' || {0} || ' de ' || {1}"


def documents(spark, sf):
    """Documents with their metadata, whether they name a relevant amount and, where there is one, their vector."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    key = F.col("doc_id").cast("string")
    texts = table(spark, sf, "documents").select("doc_id", "source", F.concat("text", F.lit(" R$ "), key, F.lit(" milhões")).alias("text"))
    docs = N.with_amounts(texts).join(vectors, "doc_id", "left")
    return docs.select(
        "doc_id", F.col("source").alias("source_id"), F.concat(F.lit("Notícia "), key, F.lit(" de "), "source").alias("title"),
        F.concat(F.lit("https://www."), "source", F.lit(".example.com/n/"), key).alias("url"),
        "relevant_amount", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("day"), "embedding",
    ).withColumns({"date": F.col("day").cast("string"), "published_at": F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("day").cast("string"))})


def replies(spark, sf):
    """One reply row per document and task, rendered from the labels and part names."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), F.initcap("p_name").alias("p"))
    labels = table(spark, sf, "labels").join(part, "doc_id")
    tags = F.when(F.col("toxic") == 1, '["esg","inventada","default"]').when(F.col("quality") == 1, '["regulatorio"]').otherwise('["m_a","x"]')
    named = F.when(F.col("doc_id") % 3 == 0, F.col("p")).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("Cia "), "p")).otherwise(F.lit("Zzyzx"))
    raw = F.array(
        F.struct(F.lit("summary").alias("task"), F.format_string('```json\n{"summary": "Resumo %d"}\n```', "doc_id").alias("raw")),
        F.struct(F.lit("sentiment").alias("task"), F.format_string(
            '{"sentiment": "%s", "sentiment_score": %s}', F.when(F.col("quality") == 1, "positivo").otherwise("ruim"),
            (F.col("doc_id") % 300 / 100).cast("string")).alias("raw")),
        F.struct(F.lit("tags").alias("task"), F.when(F.col("doc_id") % 17 == 0, "sem json").otherwise(F.format_string(
            '{"tags": %s, "tag_sugerida_fora_do_vocabulario": %s}', tags, F.when(F.col("doc_id") % 5 == 0, '"nova"').otherwise("null"))).alias("raw")),
        F.struct(F.lit("entities").alias("task"), F.format_string(
            '{"entities_mentioned": [{"name": "%s", "context": "c"}, {"name": "Qqq", "context": "c"}]}', named).alias("raw")))
    return labels.select("doc_id", F.explode(raw).alias("r")).select("doc_id", "r.task", "r.raw")


def dictionary(spark, sf):
    return table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("entity_pos")).select(
        "entity_pos", F.col("p_name").alias("canonical_id"), F.initcap("p_name").alias("main_name"), F.array("p_name").alias("aliases"))


def sources(spark, sf):
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("src"), F.col("s_suppkey").cast("string")).alias("source_id"), F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("Setor "), (F.col("s_suppkey") % 4).cast("string"))).alias("sector"),
        F.when(F.col("s_suppkey") % 4 == 0, "Alta").when(F.col("s_suppkey") % 4 == 1, "Média").alias("importance"),
        F.when(F.col("s_suppkey") % 5 == 0, "Consultoria").alias("kind")).filter("source_id <> 'src7'")


@query("q51_enriched", f"""{DOCS_SQL},
alone AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)),
heads AS (SELECT vec_id AS leader_id, day FROM led JOIN d ON vec_id = leader UNION ALL SELECT doc_id, doc_id % 30 FROM alone),
named AS (SELECT leader_id, 'cl_' || strftime(DATE '2024-01-01' + CAST(day AS INTEGER), '%Y-%m-%d') || '_' ||
  {sql_slug(TITLE_SQL.format('leader_id', 'source'), 40)} || '_' || printf('%02d', CAST(row_number() OVER (ORDER BY day, leader_id) AS INTEGER)) AS cluster_id
  FROM heads JOIN documents ON doc_id = leader_id),
m AS (SELECT a.id AS doc_id, cluster_id, source FROM (SELECT * FROM assigned UNION ALL SELECT doc_id, doc_id FROM alone) a JOIN named USING (leader_id) JOIN documents ON documents.doc_id = a.id),
st AS (SELECT cluster_id, count(*) AS cluster_size, array_to_string(list_sort(list_distinct(list(source))), ',') AS cluster_sources FROM m GROUP BY 1),
s AS (SELECT 'src' || s_suppkey AS source_id, s_name, CASE WHEN s_suppkey % 3 <> 0 THEN 'Setor ' || s_suppkey % 4 END AS sector, CASE s_suppkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS pr,
  CASE WHEN s_suppkey % 5 = 0 THEN 'blog' ELSE 'noticia' END AS kind FROM supplier WHERE s_suppkey <> 7),
x AS (SELECT m.doc_id, m.cluster_id, m.source AS source_id, coalesce(s_name, m.source) AS source_name, coalesce(kind, 'noticia') AS source_type, coalesce(sector, 'Não classificado') AS subarea, coalesce(pr, 3) AS pr,
  quality, toxic, p_name, cluster_size, cluster_sources, CASE WHEN toxic = 1 THEN 'esg,default' WHEN quality = 1 THEN 'regulatorio' ELSE 'm_a' END AS tags,
  CASE WHEN m.doc_id % 3 = 2 THEN 0 ELSE 1 END AS n_in, m.doc_id >= 100 AS money, toxic = 1 OR quality <> 1 AS crit
  FROM m JOIN st USING (cluster_id) JOIN labels l ON l.doc_id = m.doc_id JOIN part ON p_partkey = m.doc_id LEFT JOIN s ON s.source_id = m.source WHERE m.doc_id % 17 <> 0),
y AS (SELECT *, format('{{:.3f}}', 0.30::DOUBLE * CASE pr WHEN 1 THEN 1.0 WHEN 2 THEN 0.6 ELSE 0.3 END::DOUBLE + 0.35::DOUBLE * CASE n_in WHEN 1 THEN 0.5 ELSE 0.0 END::DOUBLE
  + 0.15::DOUBLE * CASE WHEN money THEN 1.0 ELSE 0.0 END::DOUBLE + 0.20::DOUBLE * CASE WHEN crit THEN 1.0 ELSE 0.0 END::DOUBLE)::DOUBLE AS score FROM x),
names AS (SELECT *, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS p FROM y)
SELECT md5(CAST(doc_id AS VARCHAR)) AS id, cluster_id, source_id, source_name, 'https://www.' || source_id || '.example.com' AS source_url, source_type,
  {TITLE_SQL.format('doc_id', 'source_id')} AS title, 'https://www.' || source_id || '.example.com/n/' || doc_id AS url,
  strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y-%m-%d') AS published_at, 'pt' AS language, '2024-01-31 12:00:00' AS captured_at, 'Infra' AS area, subarea, CAST(pr AS BIGINT) AS priority,
  CASE doc_id % 3 WHEN 0 THEN p || '=' || p_name WHEN 1 THEN 'Cia ' || p || '=' || p_name ELSE 'Zzyzx=-' END || '; Qqq=-' AS risks,
  'Resumo ' || doc_id AS summary, CASE WHEN quality = 1 THEN 'positivo' ELSE 'neutro' END AS sentiment, least(1.0::DOUBLE, (doc_id % 300)::DOUBLE / 100) AS sentiment_score,
  score AS relevance_score, 'prioridade_fonte=' || pr || '(peso ' || CASE pr WHEN 1 THEN '1.0' WHEN 2 THEN '0.6' ELSE '0.3' END || ') x0.30 + portfolio=' || n_in || ' empresa(s)(peso ' ||
  CASE n_in WHEN 1 THEN '0.5' ELSE '0.0' END || ') x0.35 + valor_monetario_relevante=' || CASE WHEN money THEN 'True(peso 1.0' ELSE 'False(peso 0.0' END || ') x0.15 + tags_criticas=[' ||
  CASE WHEN toxic = 1 THEN '''default''' WHEN quality = 1 THEN '' ELSE '''m_a''' END || '](peso ' || CASE WHEN crit THEN '1.0' ELSE '0.0' END || ') x0.20 = ' || score AS relevance_rationale,
  tags, CASE WHEN doc_id % 5 = 0 THEN 'nova' END AS suggested_tag, cluster_size, cluster_sources FROM names""")
def q51(spark, sf):
    docs = documents(spark, sf)
    # clusters over all documents, one without a vector being its own; replies only decide which records are written
    alone = docs.filter("embedding is null").select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").cast("string").alias("leader_id"))
    assigned = G.leader_clusters(docs.filter("embedding is not null"), "doc_id", "day", "doc_id", "embedding", THRESHOLD).unionByName(alone)
    ordered = docs.select("doc_id", "title", "day", (F.unix_date("day").cast("long") * 1_000_000_000_000 + F.col("doc_id")).alias("scan_order"))
    named = cut_lineage(G.name_clusters(assigned, ordered, "doc_id", "title", "day", "scan_order").select(
        F.col("id").cast("long").alias("doc_id"), "cluster_id"))
    clustered = docs.drop("embedding").join(named, "doc_id")
    stats = G.cluster_stats(clustered.select("cluster_id", "source_id"), "cluster_id", "source_id")
    looked = K.lookup_source(G.with_cluster_stats(clustered, stats, "cluster_id", "source_id"),
                             K.source_dimension(sources(spark, sf), [F.col("source_id")]))
    parsed = N.parsed_replies(replies(spark, sf))
    names = parsed.filter("entities is not null").select("doc_id", F.posexplode("entities.entities_mentioned").alias("p", "e")).select(
        "doc_id", "p", F.col("e.name").alias("name"))
    risks = E.collect_risks(E.resolve(names, E.alias_index(dictionary(spark, sf))), "doc_id", "p")
    records = N.enriched_records(looked, parsed, risks, F.lit("2024-01-31 12:00:00").cast("timestamp"))
    shown = F.array_join(F.transform("credit_risks", lambda r: F.concat(r["name"], F.lit("="), F.coalesce(r["canonical_id"], F.lit("-")))), "; ")
    return records.select(
        "id", "cluster_id", "source_id", "source_name", "source_url", "source_type", "title", "url", "published_at", "language",
        F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss").alias("captured_at"), "area", "subarea", F.col("priority").cast("long").alias("priority"), shown.alias("risks"), "summary", "sentiment", "sentiment_score",
        "relevance_score", "relevance_rationale", F.array_join("tags", ",").alias("tags"), "suggested_tag", "cluster_size",
        F.array_join("cluster_sources", ",").alias("cluster_sources"))


@query("q51_reply_quarantine", """
SELECT doc_id, 'tags' AS task FROM labels JOIN part ON p_partkey = doc_id WHERE doc_id % 17 = 0""")
def q51_quarantine(spark, sf):
    return N.invalid_replies(replies(spark, sf)).select("doc_id", "task")


@query("q51_embedding_text", """
SELECT doc_id, md5('Notícia ' || doc_id || CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN chr(10) || 'Resumo ' || doc_id ELSE '' END) AS text_md5 FROM documents""")
def q51_text(spark, sf):
    summaries = table(spark, sf, "labels").filter("quality = 1").select(
        "doc_id", F.concat(F.lit("Resumo "), F.col("doc_id").cast("string")).alias("summary"))
    titled = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("Notícia "), F.col("doc_id").cast("string")).alias("title"))
    joined = N.apply_model(titled, lambda _: summaries)
    return joined.select("doc_id", F.md5(N.embedding_text(F.col("title"), F.col("summary"))).alias("text_md5"))
