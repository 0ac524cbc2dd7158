"""Spark helpers of the operators: reading tables, Arrow batch sizes, bucket sums."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapbook import session
from snapbook.session import configure, new_folder

__all__ = ["Stored", "bit_table", "bucket_sums", "cut", "emit_buckets", "has_bit", "map_arrow", "read", "ready", "tidy"]

# A batch handed to Python stays below this size whatever the length of its texts.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and Arrow batches bounded by bytes."""
    configure(spark, filters=False)
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def cut(df: DataFrame) -> DataFrame:
    """As ``session.cut`` with the session's own compression: these steps are bound by CPU."""
    return session.cut(df, None)


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def give_back() -> None:
    """Hand freed memory back to the system: Python workers live on from task to task, and an executor's workers share its memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for one task, with its memory given back at the end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def map_arrow(df: DataFrame, make: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``make`` on each Arrow batch of a frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from make(batch)

    return df.mapInArrow(tidy(run), schema)


class Stored:
    """A frame written to a folder of its own in the shared folder, which ``drop`` deletes once nothing reads it any more."""

    def __init__(self, df: DataFrame, label: str):
        self.spark, self.folder = df.sparkSession, new_folder(df.sparkSession, label)
        df.write.parquet(self.folder)
        self.frame = self.spark.read.schema(df.schema).parquet(self.folder)

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


SEGMENT = 1 << 14
BUCKET_SCHEMA = "segment int, counts binary"


def emit_buckets(counts: np.ndarray, kind: str = "<i8") -> Iterator[tuple[int, bytes]]:
    """A task's bucket counts (or sums) cut into packed segments; empty segments are left out."""
    for i in range(0, len(counts), SEGMENT):
        part = counts[i : i + SEGMENT]
        if part.any():
            yield i // SEGMENT, zlib.compress(part.astype(kind).tobytes(), 1)


def bucket_sums(parts: DataFrame, buckets: int, kind: str = "<i8") -> np.ndarray:
    """Sum of all tasks' bucket counts; ``buckets`` alone bounds what reaches the driver.

    ``parts`` has the columns ``segment`` and ``counts`` of ``emit_buckets``. Segments are dealt out by number and
    added up as they stream by, so no task holds more than its own sums.
    """
    segments = -(-buckets // SEGMENT)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(c), kind)
                sums[s] = sums[s] + part if s in sums else part
        if sums:
            yield pa.RecordBatch.from_pydict(
                {"segment": pa.array(list(sums), pa.int32()), "counts": [zlib.compress(v.tobytes(), 1) for v in sums.values()]}
            )

    total = np.zeros(segments * SEGMENT, kind)
    few = parts.select("segment", "counts").repartition(min(segments, 16), F.col("segment"))
    for row in few.mapInArrow(tidy(add), BUCKET_SCHEMA).toLocalIterator():
        at = row["segment"] * SEGMENT
        part = np.frombuffer(zlib.decompress(row["counts"]), kind)
        total[at : at + len(part)] += part
    return total[:buckets]


def bit_table(rows: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bytes of a bit table of fixed size with the bits that ``column`` (whole numbers) modulo ``bits`` names set.

    Each task sets its own table and hands on the segments it touched; segments are joined by OR as they stream by.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False) & (bits - 1)
            np.bitwise_or.at(table, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        segments = list(emit_buckets(table, "u1"))
        if segments:
            yield pa.RecordBatch.from_pydict({"segment": pa.array([s for s, _ in segments], pa.int32()), "counts": [c for _, c in segments]})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(c), np.uint8)
                tables[s] = tables[s] | part if s in tables else part
        if tables:
            yield pa.RecordBatch.from_pydict({"segment": pa.array(list(tables), pa.int32()), "counts": [zlib.compress(v.tobytes(), 1) for v in tables.values()]})

    parts = rows.select(F.col(column).cast("long")).filter(F.col(column).isNotNull()).mapInArrow(tidy(mark), BUCKET_SCHEMA)
    whole = np.zeros(bits // 8, np.uint8)
    for row in parts.repartition(16, F.col("segment")).mapInArrow(tidy(join), BUCKET_SCHEMA).toLocalIterator():
        part = np.frombuffer(zlib.decompress(row["counts"]), np.uint8)
        whole[row["segment"] * SEGMENT : row["segment"] * SEGMENT + len(part)] = part
    return whole


def has_bit(table: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Whether the bits of whole numbers are set in a bit table."""
    at = numbers & (8 * len(table) - 1)
    return (table[at >> 3] >> (at & 7)) & 1 > 0
