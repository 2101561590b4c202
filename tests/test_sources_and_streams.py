"""Readers, sinks and the streaming forms, on files of their own."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from acervo.sources import documents as SD
from acervo.sources import tables as ST
from acervo.streaming import incremental as I


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content, encoding="utf-8")


@pytest.fixture
def pairs(tmp_path):
    meta = {"source_id": "s", "title": "T", "url": "u", "date": "2026-01-02", "termos": ["a", "b"]}
    put(tmp_path, "2026-01-02/a.json", json.dumps(meta))
    put(tmp_path, "2026-01-02/a.txt", "linha 1\nlinha 2")
    put(tmp_path, "2026-01-02/deep/er/b.json", json.dumps({"title": "só título"}, indent=2))
    put(tmp_path, "2026-01-02/deep/er/b.txt", "  \n ")
    put(tmp_path, "2026-01-02/c.json", "[1]")            # not an object
    put(tmp_path, "2026-01-02/c.txt", "x")
    put(tmp_path, "2026-01-02/d.json", "{quebrado")      # not JSON
    put(tmp_path, "2026-01-02/d.txt", "x")
    put(tmp_path, "2026-01-02/e.json", json.dumps(meta))  # no text
    put(tmp_path, "2025-12-20/a.json", json.dumps(meta))
    put(tmp_path, "2025-12-20/a.txt", "velho")
    return tmp_path


def test_document_pairs(spark, pairs):
    got = SD.read_document_pairs(spark, str(pairs / "2026-01-02")).orderBy("file_id").collect()
    assert [(r["file_id"], r["title"], r["source_id"], r["text"]) for r in got] == [
        ("a", "T", "s", "linha 1\nlinha 2"), ("b", "só título", "", "  \n ")]
    assert got[0]["extra"] == {"termos": '["a","b"]'}
    assert SD.read_document_pairs(spark, str(pairs / "2026-01-02"), strict=True).count() == 1
    assert SD.read_document_pairs(spark, str(pairs / "absent")).count() == 0


def test_week(spark, pairs):
    got = SD.read_week(spark, str(pairs), "2026-01-03")
    assert sorted(r["file_id"] for r in got.collect()) == ["2026-01-02_a", "2026-01-02_b"]
    with pytest.raises(ValueError):
        SD.read_week(spark, str(pairs), "2020-01-01")


def test_manifest_roundtrip(spark, tmp_path):
    path = str(tmp_path / "manifest")
    assert SD.read_manifest(spark, path).count() == 0
    keys = spark.createDataFrame([("s", "k"), ("s", "k"), ("s", "j")], "source_id string, key string")
    SD.append_manifest(keys, path, F.lit("2026-01-01 00:00:00"))
    assert SD.read_manifest(spark, path).count() == 2


def test_page_sink(spark, tmp_path):
    pages = spark.createDataFrame([(1, "abc"), (2, "")], "page_id long, text string")
    links = spark.createDataFrame([(1, "u"), (1, "v")], "page_id long, url string")
    SD.write_pages_with_links(pages, links, str(tmp_path / "p"))
    got = spark.read.parquet(str(tmp_path / "p" / "pages")).orderBy("page_id").collect()
    assert [(r["n_links"], r["n_text_chars"]) for r in got] == [(2, 3), (0, 0)]


def test_current_and_history(spark, tmp_path):
    path = str(tmp_path / "r")
    for day in ("2026-01-01", "2026-01-02"):
        ST.write_current_and_history(spark.createDataFrame([(day,)], "html string"), path, day)
    assert spark.read.parquet(f"{path}/current").first()[0] == "2026-01-02"
    assert spark.read.parquet(f"{path}/history").count() == 2


def test_versions_switch_after_the_write(spark, tmp_path):
    path = str(tmp_path / "t")
    assert ST.current_version(spark, path) == 0
    ST.replace_table(spark.range(3), path)
    before = ST.read_table(spark, path)
    ST.replace_table(before.filter("id > 0"), path)
    assert ST.current_version(spark, path) == 2 and ST.read_table(spark, path).count() == 2


def test_refuse_existing(spark):
    spark.range(1).createOrReplaceTempView("acervo_probe")
    with pytest.raises(ValueError):
        ST.refuse_existing(spark, ["acervo_probe"])
    ST.refuse_existing(spark, ["acervo_absent"])


SCHEMA = "source_id string, key string, published timestamp"


def batch(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    t = dt.datetime(2026, 1, 1)
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        items = I.unseen(I.read_folder(spark, src, schema, files_per_batch=1), ["source_id", "key"])
        I.append_until_done(items, out, ck)

    batch(spark, src, [("a", "1", t), ("a", "1", t), ("b", "1", t)])
    run()
    batch(spark, src, [("a", "1", t), ("a", "2", None)])
    run()
    run()
    got = sorted((r[0], r[1]) for r in spark.read.parquet(out).select("source_id", "key").collect())
    assert got == [("a", "1"), ("a", "2"), ("b", "1")]


def test_watermark_form_and_undated_branch(spark, tmp_path):
    src, ck = str(tmp_path / "src"), str(tmp_path)
    t = dt.datetime(2026, 1, 1)
    schema = spark.createDataFrame([], SCHEMA).schema
    batch(spark, src, [("a", "1", t), ("a", "1", t + dt.timedelta(hours=1)), ("a", "2", None), ("a", "2", None)])
    dated, undated = I.dated_and_undated(I.read_folder(spark, src, schema), "published")
    I.append_until_done(I.unseen_within(dated, ["source_id", "key"], "published"), f"{ck}/o1", f"{ck}/c1")
    I.append_until_done(I.unseen(undated, ["source_id", "key"]), f"{ck}/o2", f"{ck}/c2")
    assert spark.read.parquet(f"{ck}/o1").count() == 1 and spark.read.parquet(f"{ck}/o2").count() == 1


def test_manifest_sink_survives_a_restart(spark, tmp_path):
    """Batches run twice, as after a failure, leave the same rows; null keys stay, a forgotten key may return."""
    out = str(tmp_path / "out")
    batches = [[("s", "a", 1), ("s", "a", 2), ("s", None, 3)], [("s", "a", 4), ("t", "a", 5), ("s", None, 6)], [("s", "b", 7), ("t", "a", 8)]]
    frames = [spark.createDataFrame(b, "source_id string, key string, n int") for b in batches]
    step = I.manifest_sink(out, ["source_id", "key"], [F.col("n")])
    for number, frame in [(0, frames[0]), (1, frames[1]), (1, frames[1]), (2, frames[2]), (0, frames[0])]:
        step(frame, number)
    assert sorted(r["n"] for r in spark.read.parquet(f"{out}/items").collect()) == [1, 3, 5, 6, 7]
    I.manifest_sink(out, ["source_id", "key"], [F.col("n")], forget_after=1)(frames[0], 3)
    assert sorted(r["n"] for r in spark.read.parquet(f"{out}/items/batch=3").collect()) == [1, 3]


def test_week_reads_only_its_days(spark, pairs):
    week = SD.read_week(spark, str(pairs), "2026-01-03")
    assert week.inputFiles() and all("/2026-01-02/" in f for f in week.inputFiles())
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_tables_are_created_once(spark, tmp_path):
    name = f"acervo_once_{tmp_path.name.replace('-', '_')}"
    ST.create_tables({name: spark.range(3)}, str(tmp_path))
    with pytest.raises(ValueError):
        ST.create_tables({f"{name}_2": spark.range(1), name: spark.range(9)}, str(tmp_path))
    assert spark.table(name).count() == 3 and not spark.catalog.tableExists(f"{name}_2")


def test_inversions_across_partitions(spark):
    from acervo.operators.reports import by_name, inversions
    names = ["b", None, "a", "c", "c", "é", "z", "", "d"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    plain = [n or "" for n in names]
    for parts in (1, 4):
        stood = df.repartitionByRange(parts, "i").sortWithinPartitions("i")
        assert tuple(inversions(stood, "name").first()) == (9, sum(a > b for a, b in zip(plain, plain[1:])))
    assert tuple(inversions(by_name(df, "name"), "name").first()) == (9, 0)
    assert tuple(inversions(df.limit(0), "name").first()) == (0, 0)
