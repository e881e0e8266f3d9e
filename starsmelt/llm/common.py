"""What the operators share: staged tables, text batches and chunked vocabularies."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that an operator turns into numpy arrays at once; a longer text is taken alone.
SLICE_BYTES = 4 << 20

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local master, as in tests, may leave it unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="llm-"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared store and scan it from there.

    Later steps read the files, so a lost executor costs no earlier step. The folder goes when
    the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    _forget(spark, path)
    release_memory()
    return spark.read.schema(df.schema).parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    """Have the folder deleted when the application ends."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


@contextmanager
def bucketed(df: DataFrame, name: str, *keys: str) -> Iterator[DataFrame]:
    """``df`` as a table bucketed on ``keys`` in the shared store, for as long as the block lasts.

    Joins on all the keys then read it without a shuffle, as often as they like.
    """
    spark = df.sparkSession
    table = f"llm_{name}_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_folder(spark)}/{table}"
    df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    _forget(spark, path)
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns under fixed names, so that no other column of ``docs`` can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def whole_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def release_memory() -> None:
    """Give the system back what freed objects held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text",
                  limit: int = 2 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in parts of about ``limit`` bytes of ``column``, without a copy.

    A Python worker outlives its tasks, so it first gives back what the last one left.
    """
    release_memory()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def byte_slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes; every text is in exactly one."""
    first, size = 0, 0
    for at, text in enumerate(texts):
        if at > first and size + len(text) > limit:
            yield first, at
            first, size = at, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def chunk_codes(data: bytes, starts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Chunks that tile ``data`` from the given starts: a code for each, and the distinct chunks."""
    offsets = np.append(starts, len(data)).astype(np.int32)
    chunks = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    encoded = pc.dictionary_encode(chunks)
    return encoded.indices.to_numpy(), encoded.dictionary.to_pylist()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[k] .. starts[k] + lengths[k] - 1`` for every k, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def range_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[k]:bounds[k + 1]]`` for every k; an empty range gives 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def null_to_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))
