"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

# Settable at run time. AQE picks the partition count and turns a join into a broadcast only after it
# has measured the side; the skew rule splits hot keys even when that costs one more exchange.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# A table from 64 MB on that meets a set of keys too large to be broadcast is cut down in its scan by a filter of 16 MB at
# most, before the exact join moves what is left. When the filter fills up, more rows travel and the result is the same.
FILTER_CONF = {
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": str(16 << 20),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(16 << 20),
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(16 << 23),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(16 << 23),
}

# Bytes of Parquet a scan task takes at most. Narrow rows unfold to some fifteen times that in a sort or hash table, which
# a task then holds without spilling, however large the table is.
SCAN_BYTES = 16 << 20


def configure(spark: SparkSession, filters: bool = True) -> SparkSession:
    """Apply the run-time settings the plans are written for; a smaller scan size that is set stays. Without ``filters`` runtime filters are left as they are set."""
    for key, value in (RUNTIME_CONF | FILTER_CONF if filters else RUNTIME_CONF).items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > SCAN_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SCAN_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # Spark appends one folder of its own below the configured one.
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="snapbook-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the folder of this application in the shared folder; its owner drops one run by dropping that."""
    return f"{shared_dir(spark)}/run-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def folder_exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there, on whatever file system it names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _place(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def sub_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder; none when it does not exist. A listing, no job."""
    fs, path = _place(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()) if fs.exists(path) else []


def bytes_of(spark: SparkSession, files: Sequence[str]) -> int:
    """Size of files given as ``DataFrame.inputFiles`` names them. A look at each, no job."""
    uri, path = spark._jvm.java.net.URI, spark._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    places = [path(uri(f)) for f in files]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in places)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    fs, path = _place(spark, folder)
    fs.delete(path, True)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that fit a pattern, in one listing; none when nothing fits."""
    fs, path = _place(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(path) or ())


def make_folder(spark: SparkSession, folder: str) -> None:
    """Create a folder and those above it."""
    fs, path = _place(spark, folder)
    fs.mkdirs(path)


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file or folder to a name that is not taken, in one rename; False when it is taken or its folder is gone.

    Whether two movers can both win depends on the file system's rename: HDFS decides it in one step, a local disk looks first and renames then.
    """
    jvm = spark._jvm.org.apache.hadoop.fs
    one, two = jvm.Path(source), jvm.Path(target)
    context = jvm.FileContext.getFileContext(one.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(one, two, spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 0))
    except Py4JJavaError as problem:
        if problem.java_exception.getClass().getSimpleName() in ("FileAlreadyExistsException", "FileNotFoundException"):
            return False
        raise
    return True


def read_note(spark: SparkSession, name: str) -> str | None:
    """A small text file, or None."""
    fs, path = _place(spark, name)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_note(spark: SparkSession, name: str, text: str) -> None:
    """Write a small text file in the place of a former one."""
    fs, path = _place(spark, name)
    stream = fs.create(path, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def cut(df: DataFrame, compression: str | None = "zstd") -> DataFrame:
    """Cut lineage: write the frame as a table in the shared folder and go on from there.

    Lost executors cost no recomputation, later steps read only the columns they need, and the planner
    sees the real size.
    """
    folder = new_folder(df.sparkSession, "step")
    (df.write if compression is None else df.write.option("compression", compression)).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# A written set of keys carries this column, and reading it filters on it: the planner makes runtime filters only of frames that are filtered.
LISTED = "_listed"


def listed(df: DataFrame) -> DataFrame:
    """A frame whose keys other frames are cut down to, to be written with ``cut``."""
    return df.withColumn(LISTED, F.lit(1))


def keys_of(df: DataFrame, *keys: str) -> DataFrame:
    """The keys of a written frame, by way of its mark where it has one."""
    return (df.filter(F.col(LISTED) == 1) if LISTED in df.columns else df).select(*keys)


def broadcast_size(df: DataFrame) -> bool:
    """Whether the planner takes a frame for small enough to broadcast it. No job; for a written frame its size is real."""
    plan, conf = df._jdf.queryExecution().optimizedPlan(), df.sparkSession._jsparkSession.sessionState().conf()
    return int(str(plan.stats().sizeInBytes())) <= conf.autoBroadcastJoinThreshold()


def dictionary(df: DataFrame) -> DataFrame:
    """A dictionary worked out once and written to the shared folder; its measured size decides whether it is broadcast."""
    return cut(df)
