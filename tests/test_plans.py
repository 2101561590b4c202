"""Shapes of the physical plans: what reaches the scan, what is never there."""

import re

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", list(entry.queries()))
def test_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_date_range_is_pushed_and_columns_pruned(spark):
    text = plan(entry.queries()["q01_seven_day_union"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>", text)


def test_first_wins_combines_before_the_shuffle(spark):
    text = plan(entry.queries()["q36_feed_first_wins"](spark, SF_DIR))
    assert "Window" not in text and text.count("partial_min") >= 1


def test_links_of_a_page_are_distinct_without_a_shuffle(spark):
    text = plan(entry.queries()["q09_links"](spark, SF_DIR))
    assert text.count("Exchange (") <= text.count("RoundRobinPartitioning") + 1 and "hashpartitioning" not in text


def test_top_k_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(entry.queries()["q40_newest_per_source"](spark, SF_DIR))


def test_mention_scan_has_no_shuffle_of_text(spark):
    from acervo.operators.entities import alias_index, scan_mentions
    from acervo.plans.entities import dictionary
    from acervo.plans.registry import table

    docs = table(spark, SF_DIR, "documents")
    assert "Exchange" not in plan(scan_mentions(docs, alias_index(dictionary(spark)), "doc_id", "text"))


@pytest.mark.parametrize("name", ["q39_block_match", "q29_known_ratios"])
def test_exploded_rows_are_not_broadcast(spark, name):
    """The optimizer takes grams and tokens for as many as the rows they come from, so its size check says nothing of them."""
    assert "BroadcastHashJoin" not in plan(entry.queries()[name](spark, SF_DIR))


def test_grams_of_fuzzy_names_are_never_rows(spark):
    """Pairs of names with a gram in common grow with the square of the names; they stay inside tasks."""
    tree = entry.queries()["q29_known_ratios"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "gram#" not in tree and "grams#" not in tree


def test_reply_texts_are_made_once_for_equal_replies(spark):
    """Events outnumber users; the texts stand above the aggregate that makes replies distinct, and are never broadcast."""
    tree = entry.queries()["q59_reply_quality"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "repeat(abc " in tree and "Aggregate" in tree[tree.index("repeat(abc "):] and "Broadcast" not in tree


def test_reply_quality_of_odd_events(spark, tmp_path):
    rows = [(i, user, kind, value) for i, (user, kind, value) in enumerate(
        [(u, k, v) for u in (None, 0, 74, 75, 125, 126, 13) for k in (None, "error", "view") for v in (None, float("nan"), 49.0, 50.0, 51.5)] * 2)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")

    def expected(user, kind, value):
        bad = []
        # NaN counts as above all numbers
        above, below = (value is not None and (value != value or value >= 50), value is not None and value <= 50)
        if value is None or (above if kind == "error" else below):
            bad.append("sentiment_sign")
        if user is None or not 1 <= user % 6 <= 4:
            bad.append("tag_count")
        if user is None or not 300 <= 4 * user <= 500:
            bad.append("summary_length")
        if user is None or user % 20 > 12:
            bad.append("rationale_words")
        return ",".join(bad)

    got = entry.queries()["q59_reply_quality"](spark, str(tmp_path)).collect()
    assert sorted((r["event_id"], r["violations"]) for r in got) == [(i, expected(*row)) for i, *row in rows]


def test_rating_range_is_pushed(spark):
    from acervo.plans.feeds import _ratings

    scan = plan(_ratings(spark, SF_DIR, "1998-01-01", "1998-01-08"))
    pushed = scan[scan.index("PushedFilters"):].splitlines()[0]
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed


def test_enriched_records_shuffle_no_texts(spark):
    """Of a text only its amount is asked for, which is found where the text is read."""
    tree = entry.queries()["q51_enriched"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in tree.splitlines() if "text#" in line]
    assert lines and all("Join" not in line for line in lines)
    # nothing but a scan and a projection stands between a text and its flag
    assert all(line.lstrip(" +-:").startswith(("Project", "Relation", "Filter")) for line in lines)
