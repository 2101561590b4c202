"""Helpers shared by the operators: staged tables, Arrow passes, words and hashes over UTF-8 bytes."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acervo.session import ensure_checkpoint_dir

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
WORD_P = np.uint64(0x9E3779B97F4A7C15 | 1)
GRAM_P = np.uint64(0xC2B2AE3D27D4EB4F | 1)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends, executors may be lost."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: str = "text") -> Column:
    """The column's UTF-8 bytes; null stays null."""
    return F.col(column).cast("string").cast("binary")


def arrow_pass(df: DataFrame, fn: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]], schema: str,
               rows: int = 256) -> DataFrame:
    """Run fn over column lists of a few hundred rows at a time; fn sees one partition's iterator."""
    types = arrow_schema(df.sparkSession, schema)
    names = types.names

    def run(batches):
        def chunks():
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    yield batch.slice(at, rows)
        for out in fn(chunks()):
            yield pa.RecordBatch.from_arrays([pa.array(out[n], types[i].type) for i, n in enumerate(names)], schema=types)

    return df.mapInArrow(run, schema)


def worker_store(kind: str, version: str, make: Callable):
    """One object per Python worker, kept for its later tasks until another kind or version is asked for.

    It must only hold what any task could make again.
    """
    store = sys.modules.setdefault("acervo_worker_store", types.ModuleType("acervo_worker_store")).__dict__
    if store.get("key") != (kind, version):
        store["key"] = store["held"] = None
        store["held"] = make()
        store["key"] = (kind, version)
    return store["held"]


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def squeezed(raw: bytes) -> bytes:
    """Texts that are shuffled several times travel compressed."""
    import zstandard
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unsqueezed(raw: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(raw)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


class Rolling:
    """Hashes of ranges of a sequence of uint64 values, equal for equal ranges wherever they stand."""

    def __init__(self, base: np.uint64):
        self.base, self.back = base, inverse(base)
        self.forward_powers = powers(base, 1024)
        self.back_powers = powers(self.back, 1024)

    def _grow(self, n: int) -> None:
        if n > len(self.forward_powers):
            n = max(n, 2 * len(self.forward_powers))
            self.forward_powers, self.back_powers = powers(self.base, n), powers(self.back, n)

    def sums(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.forward_powers[:len(values)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.back_powers[starts])

    def grams(self, sums: np.ndarray, k: int) -> np.ndarray:
        """Hash of every run of k values."""
        n = len(sums) - k
        return mix((sums[k:] - sums[:n]) * self.back_powers[:n]) if n > 0 else np.empty(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes as an array, and start and end of each run without ASCII white space."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return data, edges[::2], edges[1::2]


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def byte_values(data: np.ndarray) -> np.ndarray:
    """A fixed 64-bit value for each byte."""
    return _BYTE_VALUES[data]


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """For each window of w consecutive hashes the position of its leftmost minimum."""
    n = len(hashes) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    blocks = -(-len(hashes) // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(hashes)] = hashes
    # the low bits hold the offset in a double block, so one minimum finds value and leftmost place
    bits = np.uint64((2 * w - 1).bit_length())
    place = np.arange(len(padded), dtype=np.uint64)
    best = (padded >> bits) << bits
    left = (best.reshape(blocks, w) | (place.reshape(blocks, w) % np.uint64(w)))
    tail = np.minimum.accumulate(left[:, ::-1], axis=1)[:, ::-1].ravel()
    head = np.minimum.accumulate(left + np.uint64(w), axis=1).ravel()
    starts = np.arange(n)
    ends = starts + w - 1
    mask = (np.uint64(1) << bits) - np.uint64(1)
    low, high = tail[:n], head[ends]
    same = starts % w == 0
    pick = np.where(same | (low <= high), low, high)
    return (starts // w) * w + (pick & mask).astype(np.int64)
