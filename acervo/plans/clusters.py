"""Similarity joins, leader clusters, title clusters and macro themes."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from acervo.functions.html import read_pages
from acervo.operators import clusters as G
from acervo.operators.themes import centroids, macro_themes, nearest_centroid, unit_vectors
from acervo.plans.registry import query, sql_slug, table
from acervo.session import cut_lineage

# The test vectors hold no pair at 0.85, so the queries pass a lower threshold.
THRESHOLD = 0.30

EDGES = f"""
d AS (SELECT vec_id, vec_id % 30 AS day, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
edges AS (SELECT a.vec_id AS hi, b.vec_id AS lo, list_cosine_similarity(a.e, b.e) AS sim, b.day AS lo_day FROM d a JOIN d b
  ON abs(a.day - b.day) <= 3 AND (b.day < a.day OR (b.day = a.day AND b.vec_id < a.vec_id)) WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD})"""

# The greedy scan as a recursive walk in (day, vec_id) order over the precomputed edges.
LEADERS = f"""
WITH RECURSIVE {EDGES},
o AS (SELECT vec_id, day, row_number() OVER (ORDER BY day, vec_id) AS i FROM d),
near AS (SELECT o.i, o.vec_id, coalesce(list(lo) FILTER (WHERE lo IS NOT NULL), []) AS los FROM o LEFT JOIN edges ON hi = o.vec_id GROUP BY 1, 2),
scan AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS leaders
  UNION ALL SELECT n.i, CASE WHEN list_has_any(s.leaders, n.los) THEN s.leaders ELSE list_append(s.leaders, n.vec_id) END FROM scan s JOIN near n ON n.i = s.i + 1),
led AS (SELECT unnest(leaders) AS leader FROM scan WHERE i = (SELECT max(i) FROM scan)),
joined AS (SELECT hi AS id, lo AS leader_id, row_number() OVER (PARTITION BY hi ORDER BY sim DESC, lo_day, lo) AS rn FROM edges JOIN led ON leader = lo WHERE hi NOT IN (SELECT leader FROM led)),
assigned AS (SELECT id, leader_id FROM joined WHERE rn = 1 UNION ALL SELECT leader, leader FROM led)"""


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("vec_id") % 30).cast("int")).alias("day"), "embedding", "label")


def _assigned(spark, sf):
    return G.leader_clusters(_vectors(spark, sf), "vec_id", "day", "vec_id", "embedding", THRESHOLD)


@query("q30_similar_pairs", f"WITH {EDGES} SELECT CAST(hi AS VARCHAR) AS hi, CAST(lo AS VARCHAR) AS lo FROM edges")
def q30(spark, sf):
    return G.similar_pairs(_vectors(spark, sf), "vec_id", "day", "vec_id", "embedding", THRESHOLD).select("hi", "lo")


@query("q30_crowded_days", f"WITH {EDGES} SELECT CAST(hi AS VARCHAR) AS hi, CAST(lo AS VARCHAR) AS lo FROM edges")
def q30_crowded(spark, sf):
    """The path of crowded days: small slices, so days are cut by direction."""
    return G.similar_pairs(_vectors(spark, sf), "vec_id", "day", "vec_id", "embedding", THRESHOLD, slice_rows=8).select("hi", "lo")


@query("q31_crowded_days", f"""{LEADERS} SELECT CAST(id AS VARCHAR) AS id, CAST(leader_id AS VARCHAR) AS leader_id FROM assigned""")
def q31_crowded(spark, sf):
    return G.leader_clusters(_vectors(spark, sf), "vec_id", "day", "vec_id", "embedding", THRESHOLD, slice_rows=8)


@query("q31_leader_clusters", f"""{LEADERS} SELECT CAST(id AS VARCHAR) AS id, CAST(leader_id AS VARCHAR) AS leader_id FROM assigned""")
def q31(spark, sf):
    return _assigned(spark, sf)


CLUSTER_ID = f"""'cl_' || strftime(DATE '2024-01-01' + CAST(day AS INTEGER), '%Y-%m-%d') || '_' || {sql_slug("'Título número ' || vec_id", 40)}"""


@query("q31_cluster_stats", f"""{LEADERS},
named AS (SELECT vec_id AS leader_id, {CLUSTER_ID} || '_' || printf('%02d', CAST(row_number() OVER (ORDER BY day, vec_id) AS INTEGER)) AS cluster_id
  FROM led JOIN d ON vec_id = leader),
m AS (SELECT id, cluster_id, CASE WHEN vec_id % 6 = 0 THEN '' ELSE 's' || label END AS source FROM assigned JOIN named USING (leader_id) JOIN embeddings ON vec_id = id),
st AS (SELECT cluster_id, count(*) AS cluster_size, array_to_string(list_sort(list_distinct(list(source) FILTER (WHERE source <> ''))), ',') AS sources,
  count(DISTINCT nullif(source, '')) AS n_sources FROM m GROUP BY 1)
SELECT cluster_id, cluster_size, coalesce(sources, '') AS cluster_sources, n_sources FROM st""")
def q31_stats(spark, sf):
    vectors = _vectors(spark, sf)
    # leaders are numbered in scan order: date first, then position
    docs = vectors.select(
        "vec_id", "day", F.concat(F.lit("Título número "), F.col("vec_id").cast("string")).alias("title"),
        (F.datediff("day", F.lit("2024-01-01").cast("date")).cast("long") * 1_000_000_000 + F.col("vec_id")).alias("scan_order"))
    named = G.name_clusters(_assigned(spark, sf), docs, "vec_id", "title", "day", "scan_order")
    members = named.join(vectors.select(
        F.col("vec_id").cast("string").alias("id"),
        F.when(F.col("vec_id") % 6 == 0, "").otherwise(F.concat(F.lit("s"), F.col("label").cast("string"))).alias("source")), "id")
    stats = G.cluster_stats(members, "cluster_id", "source")
    heard = G.corroboration(members, "cluster_id", "source").select("cluster_id", "n_sources")
    return stats.join(heard, "cluster_id").select(
        "cluster_id", "cluster_size", F.array_join("cluster_sources", ",").alias("cluster_sources"), "n_sources")


@query("q54_top_topics", """
WITH c AS (SELECT label * 100 + vec_id % 40 AS topic, count(*) AS n_items, count(DISTINCT vec_id % 12) AS n_sources,
  max(vec_id % 7) / 10 AS relevance, bool_or(vec_id % 13 = 0) AS in_universe FROM embeddings GROUP BY 1)
SELECT topic, n_sources, n_items FROM c ORDER BY in_universe DESC, relevance DESC, n_sources DESC, topic LIMIT 8""")
def q54(spark, sf):
    from acervo.operators.reports import top_topics

    members = table(spark, sf, "embeddings").select(
        (F.col("label") * 100 + F.col("vec_id") % 40).alias("topic"), (F.col("vec_id") % 12).cast("string").alias("source"),
        (F.col("vec_id") % 7 / 10).alias("relevance"), (F.col("vec_id") % 13 == 0).alias("in_universe"))
    heard = G.corroboration(members, "topic", "source")
    ranked = members.groupBy("topic").agg(F.max("relevance").alias("relevance"), F.bool_or("in_universe").alias("in_universe"))
    return top_topics(heard.join(ranked, "topic"), "in_universe", "relevance", "n_sources", "topic").select("topic", "n_sources", "n_items")


@query("q32_title_clusters")
def q32(spark, sf):
    """Page headings, page_id % 30 as the capture day."""
    read = read_pages(table(spark, sf, "pages"), ["page_id"], ["h1s"]).select(
        "page_id", F.get("h1s", F.lit(0)).alias("title"), (F.col("page_id") % 30).alias("day"))
    return G.title_clusters(read, "page_id", "day", "page_id", "title")


@query("q32_known_titles", """
WITH RECURSIVE p AS (SELECT p_partkey AS id, p_partkey % 25 AS day, p_partkey % 9 + 2 AS k, p_size % 4 AS d, p_partkey // 25 % 7 + 1 AS y,
  row_number() OVER (PARTITION BY p_partkey % 25 ORDER BY p_partkey) AS i FROM part),
near AS (SELECT a.day, a.i, a.id AS hi, b.id AS lo FROM p a JOIN p b ON a.day = b.day AND b.i < a.i
  WHERE 2.0 * (least(a.k, b.k) + CASE WHEN a.d = b.d THEN least(a.y, b.y) ELSE 0 END) / (a.k + a.y + b.k + b.y) >= 0.55),
o AS (SELECT p.day, p.i, p.id, coalesce(list(lo) FILTER (WHERE lo IS NOT NULL), []) AS los FROM p LEFT JOIN near ON p.id = hi GROUP BY ALL),
scan AS (SELECT DISTINCT day, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS leaders FROM p
  UNION ALL SELECT s.day, o.i, CASE WHEN list_has_any(s.leaders, o.los) THEN s.leaders ELSE list_append(s.leaders, o.id) END FROM scan s JOIN o ON o.day = s.day AND o.i = s.i + 1),
led AS (SELECT day, unnest(leaders) AS leader FROM scan WHERE i = (SELECT max(s.i) FROM scan s WHERE s.day = scan.day)),
f AS (SELECT hi AS id, min(lo) AS leader_id FROM near JOIN led ON led.leader = lo WHERE hi NOT IN (SELECT leader FROM led) GROUP BY 1)
SELECT CAST(id AS VARCHAR) AS id, CAST(leader_id AS VARCHAR) AS leader_id FROM (SELECT * FROM f UNION ALL SELECT leader, leader FROM led)
""")
def q32_known(spark, sf):
    """Titles whose ratio is known: the first k letters of the alphabet, then one letter y times; ratios on both sides of the threshold."""
    part = table(spark, sf, "part").select(
        "p_partkey", (F.col("p_partkey") % 25).alias("day"),
        F.concat(F.expr("substring('abcdefghijkl', 1, cast(p_partkey % 9 + 2 as int))"),
                 F.expr("repeat(substring('wxyz', cast(p_size % 4 + 1 as int), 1), cast(p_partkey div 25 % 7 + 1 as int))")).alias("title"))
    return G.title_clusters(part, "p_partkey", "day", "p_partkey", "title")


UNIT_SQL = """
u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS v
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
x AS (SELECT vec_id, label, unnest(v) AS val, generate_subscripts(v, 1) AS dim FROM u),
c AS (SELECT label, dim, avg(val) AS mean, count(*) AS size FROM x GROUP BY 1, 2)"""


@query("q33_centroids", f"WITH {UNIT_SQL} SELECT CAST(label AS BIGINT) AS label, CAST(dim AS BIGINT) AS dim, round(mean, 6) AS mean, size FROM c")
def q33_centroids(spark, sf):
    unit = unit_vectors(table(spark, sf, "embeddings"), "embedding")
    means = centroids(unit, "label", "unit").select("label", "size", F.posexplode(vector_to_array("centroid")).alias("pos", "mean"))
    return means.select(F.col("label").cast("long").alias("label"), (F.col("pos") + 1).cast("long").alias("dim"),
                        F.round("mean", 6).alias("mean"), "size")


@query("q33_nearest_centroid", f"""
WITH {UNIT_SQL}, d AS (SELECT x.vec_id, c.label AS near, sum((x.val - c.mean) * (x.val - c.mean)) AS dist FROM x JOIN c USING (dim) GROUP BY 1, 2)
SELECT vec_id, CAST(arg_min(near, dist) AS BIGINT) AS near FROM d GROUP BY 1""")
def q33_nearest(spark, sf):
    unit = unit_vectors(table(spark, sf, "embeddings"), "embedding")
    centers = [(r["label"], list(r["centroid"].toArray())) for r in centroids(unit, "label", "unit").collect()]
    return nearest_centroid(unit, "unit", centers, "near").select("vec_id", F.col("near").cast("long").alias("near"))


MANY_SQL = UNIT_SQL.replace("SELECT vec_id, label,", "SELECT vec_id, vec_id % 300 AS label,", 1).replace(
    "(SELECT vec_id, label, CAST", "(SELECT vec_id, CAST")


@query("q33_nearest_of_many", f"""
WITH {MANY_SQL}, d AS (SELECT x.vec_id, c.label AS near, sum((x.val - c.mean) * (x.val - c.mean)) AS dist FROM x JOIN c USING (dim) GROUP BY 1, 2)
SELECT vec_id, CAST(arg_min(near, dist) AS BIGINT) AS near FROM d GROUP BY 1""")
def q33_nearest_many(spark, sf):
    """Labels that grow with the table: up to 300 centroids."""
    unit = unit_vectors(table(spark, sf, "embeddings").select("vec_id", (F.col("vec_id") % 300).alias("label"), "embedding"), "embedding")
    centers = [(r["label"], list(r["centroid"].toArray())) for r in centroids(unit, "label", "unit").collect()]
    return nearest_centroid(unit, "unit", centers, "near").select("vec_id", "near")


@query("q33_theme_invariants", """
SELECT count(*) AS n_vectors, count(DISTINCT vec_id) AS n_distinct, CAST(count(*) AS BIGINT) AS total_of_sizes, true AS at_most_five FROM embeddings""")
def q33_invariants(spark, sf):
    """What holds of any themes: each vector once, sizes adding up to the table, at most five labels."""
    placed = cut_lineage(macro_themes(table(spark, sf, "embeddings"), "vec_id", "embedding"))
    sizes = placed.groupBy("theme").agg(F.count("*").alias("n"), F.countDistinct("vec_id").alias("d"))
    return sizes.agg(F.sum("n").alias("n_vectors"), F.sum("d").alias("n_distinct"), F.sum("n").alias("total_of_sizes"),
                     (F.count("*") <= 5).alias("at_most_five"))


@query("q33_macro_themes")
def q33(spark, sf):
    return macro_themes(table(spark, sf, "embeddings"), "vec_id", "embedding")
