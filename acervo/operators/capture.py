"""Capture: raw pages and rule rows to items, links and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acervo import params as P
from acervo.functions import dates as D
from acervo.functions import text as X
from acervo.functions import urls as U
from acervo.functions.html import read_pages
from acervo.operators import filters
from acervo.operators.dedup import extend_manifest, first_wins, new_wide_items
from acervo.operators.ordered import carry_backward, carry_forward

# One row per source. Null or empty means the rule does not apply.
RULE = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("url_regex", T.StringType()),
    T.StructField("url_prefix", T.StringType()),
    T.StructField("forbid_query", T.BooleanType()),
    T.StructField("exclude", T.ArrayType(T.StringType())),
    T.StructField("min_anchor", T.IntegerType()),
    T.StructField("title_stop", T.ArrayType(T.StringType())),
    T.StructField("heading", T.StringType()),
    T.StructField("card_css", T.StringType()),
    T.StructField("title_css", T.StringType()),
    T.StructField("link_css", T.StringType()),
    T.StructField("date_css", T.StringType()),
    T.StructField("summary_css", T.StringType()),
    T.StructField("date_format", T.StringType()),
    T.StructField("title_mode", T.StringType()),
    T.StructField("page_date_label", T.StringType()),
    T.StructField("page_date_format", T.StringType()),
    T.StructField("requires_date", T.BooleanType()),
    T.StructField("title_required", T.BooleanType()),
    T.StructField("following_date", T.BooleanType()),
    T.StructField("page_date_css", T.StringType()),
])

DATE_FORMATS = {
    "br": D.br_date, "br_loose": D.loose_br_date, "br_time": D.br_datetime, "us": D.us_date,
    "long_pt": D.long_pt_date, "month_first_pt": D.month_first_pt_date, "short_month": D.short_month_date,
    "day_month_comma": D.day_month_comma_date, "iso": D.iso_slice,
}


def parse_by_format(text: Column, fmt: Column) -> Column:
    """Date text read in the format named by the row's rule."""
    out = F.when(fmt == "br", D.br_date(text))
    for name, reader in DATE_FORMATS.items():
        if name != "br":
            out = out.when(fmt == name, reader(text))
    return out


def first_per_url(links: Column) -> Column:
    """Of an array of links the first of each URL. A page is one row, so no shuffle is needed."""
    return X.let(links, lambda found: X.let(F.transform(found, lambda x: x["url"]), lambda seen: F.filter(
        found, lambda x, i: F.array_position(seen, x["url"]) == i + 1)))


def _link_rows(read: DataFrame, keys: list[str], usable: Column, **more: Column) -> DataFrame:
    exploded = read.withColumn("l", F.explode_outer(usable)).filter("l is not null")
    return exploded.select(
        *keys, F.col("l.pos").alias("pos"), F.col("l.text").alias("anchor_text"), F.col("l.href").alias("href"),
        F.col("l.url").alias("link_url"), F.col("l.heading").alias("heading"), *[c.alias(n) for n, c in more.items()])


def page_links(pages: DataFrame, keys: list[str]) -> DataFrame:
    """One row per navigable link of a page, first occurrence per URL, in document order."""
    read = read_pages(pages, keys, ["links"])
    return _link_rows(read, keys, first_per_url(F.filter("links", lambda x: U.is_navigable(x["href"]))))


def rule_test(url: Column, title: Column, heading: Column) -> Column:
    """URL and title predicates of the row's rule."""
    def unless_set(name: str, test: Column) -> Column:
        return F.col(name).isNull() | test

    return (
        unless_set("url_regex", F.regexp_like(url, F.col("url_regex")))
        & unless_set("url_prefix", F.startswith(url, F.col("url_prefix")) & (F.rtrim(url, F.lit("/")) != F.rtrim(F.col("url_prefix"), F.lit("/"))))
        & unless_set("forbid_query", ~F.col("forbid_query") | ~url.contains("?"))
        & unless_set("exclude", ~F.exists("exclude", lambda e: url.contains(e)))
        & unless_set("min_anchor", F.length(title) >= F.col("min_anchor"))
        & unless_set("title_stop", ~F.exists("title_stop", lambda t: F.lower(title).contains(F.lower(t))))
        & unless_set("heading", F.coalesce(F.col("heading") == heading, F.lit(False))))


def rule_links(pages: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """Listing items of every source in one job: links that pass their source's rule, then the first of each URL.

    The rule comes before the first-wins, so a link turned down (an image without text) does not hide a later one of the
    same URL. `title_required` drops an item whose first link has no title, after it has taken its URL.
    `following_date` gives the first date at or after the link.
    """
    read = read_pages(pages, [*keys, "source_id"], ["links"]).join(rules, "source_id")
    passed = first_per_url(F.filter("links", lambda x: U.is_navigable(x["href"]) & rule_test(x["url"], x["text"], x["heading"])))
    titled = F.filter(passed, lambda x: ~F.coalesce("title_required", F.lit(False)) | (F.trim(x["text"]) != ""))
    dated = F.when(F.col("following_date"), D.loose_br_date(F.col("l.dated")))
    return _link_rows(read, [*keys, "source_id"], titled, published_at=dated)


def fragment_text(df: DataFrame, keys: list[str], html: str, drop: list[str] | None = None) -> DataFrame:
    """Text of an HTML fragment, whole; `drop` names elements to leave out."""
    return read_pages(df, keys, ["text"], html_col=html, base_col=None, article_mode="never", selectors=[], junk=drop or [])


def links_by_rule(links: DataFrame, rules: DataFrame) -> DataFrame:
    """The same predicates on a table of links (source_id, link_url, anchor_text, heading)."""
    packed = links.select(F.struct("*").alias("_l"), "source_id").join(rules, "source_id")
    return packed.filter(rule_test(F.col("_l.link_url"), F.col("_l.anchor_text"), F.col("_l.heading"))).select("_l.*")


def pdf_links(links: DataFrame, from_file: bool = False) -> DataFrame:
    """PDF links; a blank anchor gets its title from the file name, with `from_file` every one does."""
    title = U.file_title(F.col("link_url")) if from_file else F.when(F.coalesce(F.col("anchor_text"), F.lit("")) == "", U.file_title(F.col("link_url"))).otherwise(
        F.col("anchor_text"))
    return links.filter(U.is_pdf(F.col("href"))).withColumn("title", title)


def card_items(pages: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """Listing cards of every source in one job, the selectors taken from its rule row."""
    joined = pages.join(rules.filter("card_css is not null"), "source_id")
    read = read_pages(joined, [*keys, "source_id", "date_format"], ["cards"])
    rows = read.select(*keys, "source_id", "date_format", F.explode("cards").alias("c")).select(
        *keys, "source_id", F.col("c.pos").alias("pos"), F.col("c.title").alias("title"),
        F.col("c.url").alias("item_url"), F.col("c.summary").alias("summary"),
        F.coalesce(D.iso_slice(F.col("c.date_attr")), parse_by_format(F.col("c.date_text"), F.col("date_format"))
                   ).alias("published_at"))
    kept = rows.join(rules.select("source_id", "exclude"), "source_id").filter(
        F.col("exclude").isNull() | ~F.exists("exclude", lambda e: F.col("item_url").contains(e))).drop("exclude")
    return first_wins(kept, ["source_id", "item_url"], [F.col(k) for k in keys] + [F.col("pos")])


def dated_stream(nodes: DataFrame, partition: list[str], position: str, heading: Column,
                 columns: dict[str, Column]) -> DataFrame:
    """Node stream with the last heading's fields carried to the nodes after it."""
    marked = nodes.withColumns({name: F.when(heading, value) for name, value in columns.items()})
    return carry_forward(marked, partition, position, list(columns))


def following_date(nodes: DataFrame, partition: list[str], position: str, text: str, name: str = "next_date") -> DataFrame:
    """First date at or after each node."""
    return carry_backward(nodes.withColumn(name, D.loose_br_date(F.col(text))), partition, position, [name])


def resolve_files(items: DataFrame, item_url: str, detail_pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Second hop: item -> its detail page -> first PDF link. Also the items without a file."""
    first_file = F.get(F.filter("links", lambda x: U.is_pdf(x["href"])), F.lit(0))["url"]
    read = read_pages(detail_pages, ["url"], ["links"]).select(F.col("url").alias(item_url), first_file.alias("file_url"))
    files = first_wins(read.filter("file_url is not null"), [item_url], [F.col("file_url")])
    return items.join(files, item_url), items.join(files, item_url, "left_anti")


def pick_title(h1s: Column, page_title: Column, listing: Column, domain: Column, mode: Column) -> Column:
    """Title by the rule's mode, with the listing title and then the domain as fallback."""
    first_h1 = F.try_element_at(F.filter(h1s, lambda h: h != ""), F.lit(1))
    content_h1 = F.try_element_at(F.filter(
        h1s, lambda h: (F.length(h) > 15) & ~F.lower(h).isin(*P.SECTION_HEADINGS)), F.lit(1))
    chosen = (F.when(mode == "none", F.lit(None).cast("string")).when(mode == "content_h1", content_h1)
              .when(mode == "page_title", page_title).otherwise(first_h1))
    return F.coalesce(F.when(chosen != "", chosen), F.when(listing != "", listing), domain)


def capture_documents(pages: DataFrame, manifest: DataFrame, rules: DataFrame, as_of: Column,
                      strict_dates: bool = False) -> tuple[DataFrame, DataFrame]:
    """New pages to documents, and the manifest after the run.

    `pages` has source_id, url, html and optionally listing_title, listing_date.
    Seen URLs are dropped before any HTML is parsed; a rule that requires a date
    drops undated items before the fallback date is filled in.
    """
    for name in ("listing_title", "listing_date"):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.lit(None).cast("string"))
    # a URL met twice in one run is one document
    once = first_wins(pages.select("source_id", F.col("url").alias("key"), "url", "html", "listing_title", "listing_date"), ["source_id", "key"],
                      [F.col("listing_date").isNull(), F.col("listing_date"), F.col("listing_title").isNull(), F.col("listing_title"), F.xxhash64("html")])
    fresh = new_wide_items(once, manifest, ["source_id", "key"])
    keys = ["source_id", "url", "key", "listing_title", "listing_date"]
    chosen = rules.select("source_id", "page_date_css")
    read = read_pages(fresh.join(chosen, "source_id", "left"), keys, ["text", "h1s", "page_title", "date_text"])
    ruled = read.join(rules.select(
        "source_id", "sector", "title_mode", "page_date_label", "page_date_css", "page_date_format", "date_format", "requires_date"), "source_id", "left")
    labelled = F.expr("regexp_extract(text, concat(page_date_label, '\\\\s*:?\\\\s*([^\\\\n]{1,40})'), 1)")
    by_label = F.when(F.col("page_date_label") != "", labelled)
    page_date = parse_by_format(F.coalesce("date_text", by_label), F.coalesce("page_date_format", "date_format"))
    dated = ruled.withColumns({
        "title": pick_title(F.col("h1s"), F.col("page_title"), F.col("listing_title"), U.domain_or_unknown(F.col("url")),
                            F.coalesce("title_mode", F.lit("h1"))),
        "_page_date": page_date,
        "_has_rule": F.coalesce(F.col("page_date_label") != "", F.lit(False)) | F.col("page_date_css").isNotNull(),
    })
    known = F.coalesce("_page_date", "listing_date").isNotNull()
    accepted = filters.long_enough(dated.filter(~F.coalesce("requires_date", F.lit(False)) | known))
    documents = accepted.select(
        X.document_id(F.col("source_id"), F.col("title"), F.col("url")).alias("doc_id"),
        "source_id", "title", "url", "key", "sector", "text",
        as_of.cast("string").alias("date"),
        D.captured_date(F.col("listing_date"), F.col("_page_date"), F.col("_has_rule"), as_of.cast("string"),
                        strict_dates).alias("published_at"),
        F.length("text").alias("n_chars"),
    )
    return documents, extend_manifest(manifest, documents, ["source_id", "key"])
