"""Reading source tables, from a folder of Parquet files or from the catalog.

Tables of a folder may be written in buckets by a key (``write_buckets``). Spark then knows where a key's rows are, so joins and
reductions by that key read them without an exchange.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, types as T

from snapbook.operators.asof import Names, as_list
from snapbook.session import bytes_of, folder_exists, read_note, write_note

BUCKETS = "_buckets"
BUCKET_BYTES = 16 << 20


def _table(root: str, name: str) -> str:
    """A catalog name for a table of a folder; other folders have other names."""
    return f"snapbook_{hashlib.md5(root.encode()).hexdigest()[:12]}_{name}"


def bucket_count(*frames: DataFrame) -> int:
    """Buckets for tables joined by one key: one for each core, and more where the files of the largest would fill a bucket past ``BUCKET_BYTES``.

    A bucket is sorted, read and reduced by one task, so a fixed number would let its memory grow with the table.
    """
    spark = frames[0].sparkSession
    largest = max(bytes_of(spark, frame.inputFiles()) for frame in frames)
    return max(spark.sparkContext.defaultParallelism, -(-largest // BUCKET_BYTES))


def write_buckets(df: DataFrame, root: str, name: str, key: Names, buckets: int) -> None:
    """Write ``root/name.parquet`` in so many buckets by ``key``, sorted by it, one file each, and note that beside the tables.

    Tables that are joined by a key need the same number of buckets. Null keys share a bucket.
    """
    spark, keys, root = df.sparkSession, as_list(key), root.rstrip("/")
    spark.sql(f"drop table if exists {_table(root, name)}")
    # Dealt out the way buckets are, so every task writes one file.
    placed = df.repartition(buckets, *keys)
    placed.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{root}/{name}.parquet").format("parquet").saveAsTable(_table(root, name))
    note = {"keys": keys, "buckets": buckets, "columns": df.schema.jsonValue()}
    write_note(spark, f"{root}/{BUCKETS}/{name}.json", json.dumps(note))


def read_buckets(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The table of a folder with its buckets, where it was written in buckets. A session that does not know it yet enters it in its catalog."""
    root = root.rstrip("/")
    note = read_note(spark, f"{root}/{BUCKETS}/{name}.json")
    if note is None:
        return None
    known = json.loads(note)
    table = _table(root, name)
    if not spark.catalog.tableExists(table):
        columns = spark.createDataFrame([], T.StructType.fromJson(known["columns"]))._jdf.schema().toDDL()
        keys = ", ".join(f"`{k}`" for k in known["keys"])
        spark.sql(f"create table {table} ({columns}) using parquet clustered by ({keys}) sorted by ({keys}) into {known['buckets']} buckets location '{root}/{name}.parquet'")
    return spark.table(table)


def read_source(spark: SparkSession, name: str, root: str | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """A source table: ``root/name.parquet`` when a folder is given, else the catalog table."""
    if root is None:
        return spark.table(name)
    bucketed = read_buckets(spark, root, name)
    if bucketed is not None:
        return bucketed
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/{name}.parquet")


class Sources(Mapping[str, DataFrame]):
    """Input frames by name, read on first use; given frames win over stored ones.

    ``schemas`` declares stored tables by name; without a declaration a table has the schema of its files.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, schemas: Mapping[str, T.StructType] | None = None,
                 **frames: DataFrame) -> None:
        self._spark = spark
        self._root = root
        self._schemas = dict(schemas or {})
        self._frames: dict[str, DataFrame] = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = read_source(self._spark, name, self._root, self._schemas.get(name))
        return self._frames[name]

    def __contains__(self, name: object) -> bool:
        """Whether a frame is given or its table is there; looks, reads nothing."""
        if name in self._frames:
            return True
        if self._root is None:
            return self._spark.catalog.tableExists(str(name))
        return folder_exists(self._spark, f"{self._root}/{name}.parquet")

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)
