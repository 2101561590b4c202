"""Document pairs in, document tables out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from acervo import params as P
from acervo.functions import text as X

METADATA = ["source_id", "title", "description", "url", "date", "published_at"]
_DAY = r"/(\d{4}-\d{2}-\d{2})/"


def _whole_files(spark: SparkSession, folders: list[str], suffix: str) -> DataFrame:
    """(stem, content) of every file with the suffix at any depth; folders that do not exist hold none."""
    found = None
    for folder in folders:
        try:
            files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{suffix}")
            files = files.select(
                F.regexp_replace(F.col("_metadata.file_path"), f"\\{suffix}$", "").alias("stem"), F.col("value"))
            files.schema  # resolves the path now
        except AnalysisException:
            continue
        found = files if found is None else found.unionByName(files)
    return spark.createDataFrame([], "stem string, value string") if found is None else found


def read_document_pairs(spark: SparkSession, folder: str | list[str], strict: bool = False) -> DataFrame:
    """Metadata joined to the text of the same stem.

    The metadata files are the small side: below the optimizer's size bound they
    are sent to the texts, which then stay where they were read. Metadata must be a JSON object and its text file must exist; missing keys
    are empty text, other keys stay in `extra`. `strict` also drops blank texts.
    """
    folders = [folder] if isinstance(folder, str) else folder
    meta = _whole_files(spark, folders, ".json").select(
        "stem", F.when(F.json_object_keys("value").isNotNull(), F.from_json("value", "map<string,string>")).alias("m"))
    text = _whole_files(spark, folders, ".txt").select("stem", F.col("value").alias("text"))
    pairs = meta.filter("m is not null").join(text, "stem")
    if strict:
        pairs = pairs.filter(F.regexp_replace("text", r"\s+", "") != "")
    return pairs.select(
        F.regexp_extract("stem", r"([^/]+)$", 1).alias("file_id"),
        F.regexp_extract("stem", _DAY, 1).alias("folder_date"),
        *[F.coalesce(F.try_element_at("m", F.lit(k)), F.lit("")).alias(k) for k in METADATA],
        "text", F.map_filter("m", lambda k, _: ~k.isin(*METADATA)).alias("extra"),
    )


def last_days(docs: DataFrame, timestamp: str, as_of: str, days: int = P.WEEK_DAYS) -> DataFrame:
    """Rows of the day and the days before it; a plain range, so it reaches the scan."""
    end = F.date_add(F.lit(as_of).cast("date"), 1).cast("timestamp_ntz")
    start = F.date_sub(F.lit(as_of).cast("date"), days - 1).cast("timestamp_ntz")
    return docs.filter((F.col(timestamp) >= start) & (F.col(timestamp) < end))


def read_week(spark: SparkSession, root: str, as_of: str, days: int = P.WEEK_DAYS) -> DataFrame:
    """Documents of the last days; file ids carry their date. No documents is an error.

    Each day is a folder of its own below `root`: only the folders of these days are listed and read.
    """
    last = dt.date.fromisoformat(as_of)
    folders = [f"{root.rstrip('/')}/{last - dt.timedelta(days=n)}" for n in range(days)]
    week = read_document_pairs(spark, folders).withColumn("file_id", F.concat_ws("_", "folder_date", "file_id"))
    if week.limit(1).isEmpty():
        raise ValueError(f"no documents in the {days} days to {as_of}")
    return week


def write_documents(docs: DataFrame, path: str, mode: str = "append") -> None:
    """One table instead of file pairs, partitioned by capture date."""
    docs.withColumn("doc_id", X.document_id(F.col("source_id"), F.col("title"), F.col("url"))).write.mode(mode).partitionBy(
        "date").parquet(path)


def write_pages_with_links(pages: DataFrame, links: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Page rows with `n_links` and `n_text_chars`, and the links as a child table."""
    counts = links.groupBy("page_id").agg(F.count("*").alias("n_links"))
    (pages.join(counts, "page_id", "left")
     .withColumns({"n_links": F.coalesce("n_links", F.lit(0)), "n_text_chars": F.length("text")})
     .write.mode(mode).parquet(f"{path}/pages"))
    links.write.mode(mode).parquet(f"{path}/links")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Seen keys; an absent or unreadable manifest is empty."""
    try:
        return spark.read.schema("source_id string, key string, first_seen timestamp").parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], "source_id string, key string, first_seen timestamp")


def append_manifest(accepted: DataFrame, path: str, seen_at: Column) -> None:
    """Add accepted keys; readers treat the table as a set."""
    accepted.select("source_id", "key").distinct().withColumn("first_seen", seen_at.cast("timestamp")).write.mode(
        "append").parquet(path)
