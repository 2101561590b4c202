"""Feeds, JSON listings, rating actions, editions, paging and node streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from acervo.functions import replies as R
from acervo.operators import capture as C
from acervo.operators import feeds, filters, ordered
from acervo.plans.registry import query, table


def _k():
    return F.get_json_object("props", "$.k")


@query("q22_json_replies", r"""
WITH r AS (SELECT event_id, event_type, CASE event_id % 3 WHEN 2 THEN NULL ELSE CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) END AS k FROM events)
SELECT event_type, count(k) AS n_valid, CAST(sum(k) AS BIGINT) AS sum_k, count(*) - count(k) AS n_invalid FROM r GROUP BY event_type""")
def q22(spark, sf):
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(
        F.col("event_id") % 3 == 1, F.concat(F.lit("  "), "props", F.lit("\n"))).otherwise(F.concat(F.lit("Segue: "), "props"))
    parsed = table(spark, sf, "events").select("event_type", R.parse_reply(raw, "k bigint").alias("r"))
    return parsed.groupBy("event_type").agg(
        F.count("r.k").alias("n_valid"), F.sum("r.k").alias("sum_k"), F.count_if(F.col("r").isNull()).alias("n_invalid"))


@query("q22_search_listing", """
SELECT event_id, p AS pos, CASE p WHEN 0 THEN event_type ELSE 'b' END AS title, '/n/' || event_id || '/' || p AS url, strftime(ts, '%Y-%m-%d') AS published_at
FROM events, (VALUES (0), (1)) v(p) WHERE event_id % 4 <> 0""")
def q22_listing(spark, sf):
    item = '{{"title":"{0}","@id":"/n/%d/{1}","effective":"%sT00:00:00"}}'
    payload = F.format_string('{"items":[' + item.format("%s", 0) + "," + item.format("b", 1) + "]}",
                              F.col("event_type"), F.col("event_id"), F.date_format("ts", "yyyy-MM-dd"),
                              F.col("event_id"), F.date_format("ts", "yyyy-MM-dd"))
    broken = F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("<html>"), payload)).otherwise(payload)
    rows = table(spark, sf, "events").select("event_id", broken.alias("payload"))
    return feeds.search_items(rows, ["event_id"], "payload")


@query("q23_block_flatten", """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
k AS (SELECT doc_id, list_reverse(list_filter(lines, lambda x, i: i % 3 <> 0 AND trim(x) <> '')) AS kept FROM l)
SELECT doc_id, md5(array_to_string(kept, chr(10) || chr(10))) AS text_md5, CAST(len(kept) AS BIGINT) AS n_blocks FROM k""")
def q23(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    entries = F.transform("lines", lambda x, i: F.struct(
        F.concat(F.lit("b"), i.cast("string")).alias("key"),
        F.struct(F.when((i + 1) % 3 == 0, "image").otherwise("slate").alias("type"), x.alias("plaintext")).alias("value")))
    order = F.reverse(F.transform(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.concat(F.lit("b"), i.cast("string"))))
    kept = F.size(F.filter("lines", lambda x, i: ((i + 1) % 3 != 0) & (F.trim(x) != "")))
    built = docs.select("doc_id", F.map_from_entries(entries).alias("blocks"), order.alias("order"), kept.alias("n"))
    return built.select("doc_id", F.md5(feeds.block_text(F.col("blocks"), F.col("order"))).alias("text_md5"),
                        F.col("n").cast("long").alias("n_blocks"))


@query("q24_carry_forward", """
SELECT conv_id, turn, role,
  last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER w AS heading,
  last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER w AS heading_turn,
  first_value(CASE WHEN role = 'assistant' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_reply
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q24(spark, sf):
    nodes = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.col("text").alias("head"))
    carried = C.dated_stream(nodes, ["conv_id"], "turn", F.col("role") == "user",
                             {"heading": F.col("head"), "heading_turn": F.col("turn")}).drop("head")
    replies = carried.withColumn("next_reply", F.when(F.col("role") == "assistant", F.col("turn")))
    return ordered.carry_backward(replies, ["conv_id"], "turn", ["next_reply"])


@query("q26_paging_stop", r"""
WITH i AS (SELECT user_id, event_id // 2000 + 1 AS page, event_type || CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) % 7 AS key, event_id FROM events),
n AS (SELECT user_id, page, count(*) AS n FROM i GROUP BY 1, 2),
f AS (SELECT user_id, page, count(*) AS fresh FROM (SELECT user_id, key, min(page) AS page FROM i GROUP BY 1, 2) GROUP BY 1, 2),
s AS (SELECT user_id, min(CASE WHEN n < 12 THEN page END) AS short, min(CASE WHEN fresh IS NULL THEN page END) AS stale FROM n LEFT JOIN f USING (user_id, page) GROUP BY 1)
SELECT user_id, count(*) AS n_items, max(page) AS last_page FROM i JOIN s USING (user_id)
WHERE page <= least(coalesce(short, 5), coalesce(stale - 1, 5), 5) GROUP BY user_id""")
def q26(spark, sf):
    items = table(spark, sf, "events").select(
        "user_id", "event_id", (F.floor(F.col("event_id") / 2000) + 1).alias("page"),
        F.concat("event_type", (_k().cast("long") % 7).cast("string")).alias("key"))
    kept = ordered.paging_stop(items, "user_id", "page", "key", page_size=12, max_pages=5)
    return kept.groupBy("user_id").agg(F.count("*").alias("n_items"), F.max("page").alias("last_page"))


@query("q35_edition_of_day", """
WITH l AS (SELECT o_custkey % 50 AS listing, o_orderkey AS pos, 'https://do.example.com/do_' || strftime(o_orderdate, '%d_%m_%Y') || '.pdf' AS href FROM orders)
SELECT listing, min(pos) AS pos, arg_min(href, pos) AS href FROM l WHERE href LIKE '%28_05_1997.pdf' GROUP BY listing""")
def q35_day(spark, sf):
    links = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 50).alias("listing"), F.col("o_orderkey").alias("pos"),
        F.concat(F.lit("https://do.example.com/do_"), F.date_format("o_orderdate", "dd_MM_yyyy"), F.lit(".pdf")).alias("href"))
    return filters.edition_of_day(links, ["listing"], "href", "pos", F.lit("1997-05-28")).select("listing", "pos", "href")


@query("q35_full_editions", """
SELECT DISTINCT strftime(o_orderdate, '%Y.%m.%d') || '.DOE_0.pdf' AS file, strftime(o_orderdate, '%Y-%m-%d') AS edition_date
FROM orders WHERE o_orderkey % 2 = 0 AND strftime(o_orderdate, '%Y-%m-%d') = '1997-05-28'""")
def q35_full(spark, sf):
    day = F.date_format("o_orderdate", "yyyy.MM.dd")
    suffix = F.when(F.col("o_orderkey") % 2 == 0, ".DOE_0.pdf").otherwise(".DOE_1.pdf")
    pages = table(spark, sf, "orders").select(
        F.concat(F.lit("<a href='"), day, suffix, F.lit("'>1</a> <a href='1990.01.01.DOE_0.pdf'>2</a>")).alias("html"))
    return filters.full_editions(pages, "html", F.lit("1997-05-28"))


FEED_SQL = r"feed AS (SELECT event_id, event_type, user_id % 3 AS feed_pos, CASE WHEN user_id % 17 <> 0 THEN '/n/' || regexp_extract(props, '(\d+)', 1) END AS link FROM events)"


def _feed(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "event_type", (F.col("user_id") % 3).alias("feed_pos"),
        F.when(F.col("user_id") % 17 != 0, F.concat(F.lit("/n/"), _k())).alias("link"))


@query("q36_feed_first_wins", f"""
WITH {FEED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY event_type, link ORDER BY feed_pos, event_id) AS rn FROM feed)
SELECT event_type, link, event_id FROM r WHERE rn = 1 OR link IS NULL""")
def q36(spark, sf):
    kept = feeds.combine_feeds(_feed(spark, sf), "event_type", "link", [F.col("feed_pos"), F.col("event_id")])
    return kept.select("event_type", "link", "event_id")


@query("q36_active_feed", f"""
WITH {FEED_SQL}, c AS (SELECT * FROM feed WHERE NOT (event_type = 'click' AND feed_pos = 0) AND NOT (event_type = 'view' AND feed_pos < 2))
SELECT event_type, feed_pos, count(*) AS n FROM c WHERE feed_pos = (SELECT min(feed_pos) FROM c d WHERE d.event_type = c.event_type) GROUP BY 1, 2""")
def q36_active(spark, sf):
    some = _feed(spark, sf).filter("not (event_type = 'click' and feed_pos = 0) and not (event_type = 'view' and feed_pos < 2)")
    return feeds.active_feed(some, "event_type", "feed_pos").groupBy("event_type", "feed_pos").agg(F.count("*").alias("n"))


@query("q36_category_filter", """
SELECT event_id FROM events WHERE user_id % 2 = 1 OR event_type IN ('purchase', 'error')""")
def q36_category(spark, sf):
    tags = F.when(F.col("event_type") == "purchase", F.array(F.lit("Política"), F.lit("INFRAESTRUTÚRA e Obras"))).when(
        F.col("event_type") == "error", F.array(F.lit("infraestrutura"))).when(F.col("event_type") == "view", F.array(F.lit("esporte")))
    items = table(spark, sf, "events").select(
        "event_id", tags.alias("tags"), F.when(F.col("user_id") % 2 == 0, "general").otherwise("dedicated").alias("feed_type"))
    return filters.in_category(items, "tags", "feed_type", "Infraestrutura").select("event_id")


RATING = ["l_orderkey", "l_linenumber"]


def _ratings(spark, sf, since: str | None = None, until: str | None = None):
    """Rating actions of the days from `since` up to, not with, `until`; the range is on the stored column, so it is pushed."""
    line = table(spark, sf, "lineitem")
    if since:
        line = line.filter((F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz")) & (F.col("l_shipdate") < F.lit(until).cast("timestamp_ntz")))
    return line.select(
        *RATING, F.date_format("l_shipdate", "yyyy-MM-dd").alias("ratingActionDate"), F.lit("AFF").alias("actionTypeCode"),
        F.col("l_suppkey").cast("string").alias("entityId"), F.concat(F.lit("Emissor "), F.col("l_suppkey").cast("string")).alias("sourceProvidedName"),
        F.col("l_returnflag").alias("class"), F.when(F.col("l_linestatus") == "O", "brAA").alias("ratingTo"),
        F.concat(F.lit("A"), (F.col("l_partkey") % 5).cast("string")).alias("actionName"), F.lit("LT").alias("ratingType"))


@query("q56_rating_actions", """
SELECT md5(l_suppkey || '|' || strftime(l_shipdate, '%Y-%m-%d') || '|LT|' || l_returnflag || '|' || CASE WHEN l_linestatus = 'O' THEN 'brAA' ELSE '' END || '|A' || l_partkey % 5) AS synthetic_id,
  count(*) AS n, max('') AS rating_from FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-01-08' GROUP BY 1""")
def q56(spark, sf):
    line = _ratings(spark, sf, "1998-01-01", "1998-01-08")
    return feeds.rating_actions(line).groupBy("synthetic_id").agg(F.count("*").alias("n"), F.max("ratingFrom").alias("rating_from"))


@query("q56_published_items", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS published_at, 'https://news.example.com/item?id=' || o_orderkey AS url FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate <= TIMESTAMP '1997-06-30 00:00:00' AND (o_orderkey % 3 = 0 OR o_orderdate + INTERVAL 30 DAY >= TIMESTAMP '1997-06-30 00:00:00')
  AND o_orderpriority = '2-HIGH'""")
def q56_published(spark, sf):
    orders = table(spark, sf, "orders").withColumn(
        "expires", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")))
    as_of = F.lit("1997-06-30 00:00:00").cast("timestamp_ntz")
    shown = filters.published_items(orders, as_of, "o_orderstatus", "o_orderdate", "expires", "F", "o_orderpriority", "2-HIGH")
    payload = F.format_string(
        '{"d":{"results":[{"Id":"%d","Title":"T","Subtitle":null,"PublishDate":"%sT03:00:00Z"}]}}', F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    items = feeds.odata_items(shown.select(payload.alias("payload")), "payload", "https://news.example.com/item?id=")
    return items.select(F.col("id").cast("long").alias("o_orderkey"), "published_at", "url")


@query("q40_newest_per_source", """
SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""")
def q40_newest(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return feeds.newest_items(orders, ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query("q60_query_expansion", r"""
WITH q AS (SELECT DISTINCT upper(p_name) AS query FROM part WHERE p_size > 10),
h AS (SELECT upper(p_name) AS query, p_partkey, regexp_replace(regexp_extract(url, '^https?://([^/]+)', 1), '^www\.', '') AS domain, p_type AS title
  FROM part JOIN pages ON page_id = p_partkey % (SELECT count(*) FROM pages)),
j AS (SELECT h.* FROM h JOIN q USING (query))
SELECT domain, title, max(p_partkey) AS p_partkey, arg_max(query, p_partkey) AS query FROM j GROUP BY 1, 2""")
def q60(spark, sf):
    from acervo.functions import urls as U

    part, pages = table(spark, sf, "part"), table(spark, sf, "pages").select("page_id", "url")
    queries = part.filter("p_size > 10").select(F.upper("p_name").alias("query"))
    hits = part.join(pages, F.col("page_id") == F.col("p_partkey") % pages.count()).select(
        F.upper("p_name").alias("query"), "p_partkey", U.domain_or_unknown(F.col("url")).alias("domain"), F.col("p_type").alias("title"))
    return feeds.last_hit_wins(feeds.expand_queries(queries, hits, "query"), "domain", "title", [F.col("p_partkey")]).select(
        "domain", "title", "p_partkey", "query")


@query("q36_sources_without_feed", """
SELECT DISTINCT source FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE lang = 'es' AND doc_id % 7 = 0)""")
def q36_without(spark, sf):
    docs = table(spark, sf, "documents")
    items = docs.filter("lang = 'es' and doc_id % 7 = 0")
    return feeds.sources_without_feed(docs.select("source").distinct(), items, "source")


@query("q47_with_required", """
SELECT doc_id FROM documents WHERE doc_id % 5 <> 0 AND lang <> 'fr'""")
def q47_required(spark, sf):
    """Rows in which every required field holds something; null and empty are both missing."""
    from acervo.operators.filters import with_required

    docs = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("origin"), F.when(F.col("lang") == "fr", "").otherwise(F.col("lang")).alias("tongue"))
    return with_required(docs, ["origin", "tongue"]).select("doc_id")
