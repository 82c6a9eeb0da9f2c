"""Helpers shared by the operators: reading tables, cutting lineage, words and
hashes, and streaming over sorted Arrow batches."""
from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from huddlekit.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, removed when the driver
    ends. The path names its file system, so that what opens it without Spark
    finds the same folder."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}"))
    files = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    files.deleteOnExit(hpath)
    return files.makeQualified(hpath).toString()


def drop_folder(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: later
    stages (and retries after a lost executor) start from the files."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give freed memory back to the system. A reused Python worker otherwise
    keeps, to the end of the application, what its largest task held."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc has it
    if trim:
        trim(0)


@contextmanager
def batch_bytes(spark: SparkSession, limit: int) -> Iterator[None]:
    """Within the block at most about ``limit`` bytes are handed to Python at a time."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    former = spark.conf.get(name)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, former)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema) -> DataFrame:
    """``mapInArrow`` that leaves nothing behind in the worker: what ``run``
    holds ends with its batches, and the memory is given back."""
    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()
    return df.mapInArrow(lean, schema)


class WordHash(dict):
    """word bytes -> 64-bit hash, memoized up to a fixed number of words."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z: exactly what the
    byte-string methods do."""
    return text.lower().split()


def mix(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Order-dependent 64-bit combination of two hash arrays."""
    h = x * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += y
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, in text order; with fewer words the
    whole sequence is the one shingle, with none there is no shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(k, n)
    h = hashes[:n - width + 1].copy()
    for j in range(1, width):
        h = mix(h, hashes[j:n - width + 1 + j])
    return h * np.uint64(0x94D049BB133111EB) + np.uint64(width)


def blobs(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def chunks_by_bytes(texts: list[bytes | None], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts hold about ``limit`` bytes together."""
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t or b"") + 16
        if size >= limit:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of sorted input in which no group of ``key`` is cut in two.

    Only the open last group is carried over, so memory holds one batch and
    one group; callers bound their groups."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key)
        last = keys[-1]
        if rest and rest[-1].column(key)[-1] == last and keys[0] == last:
            rest.append(batch)
            continue
        col = keys.to_numpy(zero_copy_only=False)
        start = int(np.flatnonzero(col != col[-1])[-1]) + 1 if (col != col[-1]).any() else 0
        if start == 0 and not rest:
            rest = [batch]
            continue
        done = [*rest, batch.slice(0, start)] if start else rest
        yield pa.Table.from_batches(done)
        rest = [batch.slice(start)]
    if rest:
        yield pa.Table.from_batches(rest)
