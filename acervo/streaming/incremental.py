"""Incremental capture as Structured Streaming: same results as the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from acervo.functions.dates import within_hours
from acervo.operators.catalogue import upsert_run_status
from acervo.operators.dedup import first_wins, new_items
from acervo.sources.tables import read_table, replace_table


def read_folder(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def unseen(items: DataFrame, keys: list[str]) -> DataFrame:
    """Items whose key has not been seen in any batch, for streams of few keys: the operator's state holds all of them.

    `manifest_sink` is the form for streams that never end.
    """
    return items.dropDuplicates(keys)


def manifest_sink(out: str, keys: list[str], order: list[Column], forget_after: int | None = None) -> Callable[[DataFrame, int], None]:
    """Batch step that appends the first row of every key not seen before to `{out}/items`, and the keys to `{out}/manifest`.

    The seen keys are a table with a partition for each batch, so the stream keeps
    no state and executors hold none. A batch overwrites its own partitions and
    reads only those of earlier ones: run again after a failure it leaves the same
    rows. Rows with a null in their key are kept in every batch, as in the batch
    form. With `forget_after`, keys of batches further back are not read and may
    come in again.
    """
    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema.fields if f.name in keys)
        known = F.lit(False)
        for key in keys:
            known = known | F.col(key).isNull()
        firsts = first_wins(batch.filter(~known), keys, order).unionByName(batch.filter(known))
        try:
            seen = spark.read.schema(f"{plain}, batch long").parquet(f"{out}/manifest").filter(F.col("batch") < number)
            if forget_after is not None:
                seen = seen.filter(F.col("batch") >= number - forget_after)
            firsts = new_items(firsts, seen, keys)
        except AnalysisException:
            pass  # the first batch
        firsts.write.mode("overwrite").parquet(f"{out}/items/batch={number}")
        spark.read.schema(batch.schema).parquet(f"{out}/items/batch={number}").select(*keys).dropna().write.mode(
            "overwrite").parquet(f"{out}/manifest/batch={number}")

    return step


def unseen_within(items: DataFrame, keys: list[str], published: str, delay: str = "24 hours") -> DataFrame:
    """Bounded state: keys are forgotten once the watermark has passed them."""
    return items.withWatermark(published, delay).dropDuplicatesWithinWatermark(keys)


def fresh(items: DataFrame, published: str, as_of: Column, hours: int = 24) -> DataFrame:
    """Freshness window per batch; undated items pass."""
    return items.filter(within_hours(F.col(published), as_of, hours))


def dated_and_undated(items: DataFrame, published: str) -> tuple[DataFrame, DataFrame]:
    """The branch under the watermark, and the undated rows that must go round it."""
    return items.filter(F.col(published).isNotNull()), items.filter(F.col(published).isNull())


def append_until_done(items: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, append to a table, stop."""
    query = (items.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(path))
    query.awaitTermination()
    return query


def each_batch(items: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    query = (items.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def status_sink(catalogue_path: str, key: str = "source_id") -> Callable[[DataFrame, int], None]:
    """Batch step that upserts run outcomes into the published catalogue."""
    def step(batch: DataFrame, _: int) -> None:
        if batch.isEmpty():
            return
        sources = read_table(batch.sparkSession, catalogue_path)
        replace_table(upsert_run_status(sources, batch, key, [F.col("run_at")]), catalogue_path)

    return step
