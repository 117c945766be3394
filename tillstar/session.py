"""Session settings, the shared work folder and plan-time size checks."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


COMPRESSION = "zstd"  # of files that are written once and read a few times


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tillstar")
    for key, value in {**_SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(input_bytes: int, executor_cores: int) -> dict[str, str]:
    """Session settings for a large load or report run, to be passed to the session builder.

    Shuffles start with a partition per 128 MB of input and at least two per core; adaptive execution
    merges what turns out small and splits what turns out skewed.
    """
    partitions = max(2 * executor_cores, -(-input_bytes // (128 * 2**20)))
    return {
        **_SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def new_work_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    files, place = hadoop_path(spark, path)
    return files.exists(place)


def is_loaded(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has finished and left at least one row."""
    return path_exists(spark, f"{path}/_SUCCESS") and not _without_files(spark, path) and not spark.read.parquet(path).isEmpty()


def _without_files(spark: SparkSession, path: str) -> bool:
    files, place = hadoop_path(spark, path)
    listed = files.listFiles(place, True)
    while listed.hasNext():
        if listed.next().getPath().getName().endswith(".parquet"):
            return False
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of stored rows that nothing reads any more."""
    files, place = hadoop_path(spark, path)
    files.delete(place, True)


def write_if_empty(df: DataFrame, path: str) -> None:
    """Load a table unless it holds rows; an empty or half-written one is replaced."""
    if not is_loaded(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut, sizes known.

    The folder goes when the application ends, if not before.
    """
    path = new_work_folder(df.sparkSession, label)
    df.write.option("compression", COMPRESSION).parquet(path)
    files, place = hadoop_path(df.sparkSession, path)
    files.deleteOnExit(place)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_stored(df: DataFrame) -> None:
    """Delete the folder that ``stored`` wrote for ``df``, once nothing reads it any more."""
    for path in {name.rpartition("/")[0] for name in df.inputFiles()[:1]}:
        remove(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Give back what finished work leaves behind: plans in the driver, broadcasts, shuffle files of the executors.

    Spark cleans up what the driver's collector finds unused, and the collector lets the heap grow to its limit first.
    """
    gc.collect()  # Python's frames refer to plans
    spark.sparkContext._jvm.System.gc()


_UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which Spark broadcasts a join side; -1 switches broadcasting off."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * _UNITS[unit]


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a scan and projection (file sizes scaled by the columns read).

    Not for joins: without column statistics Catalyst multiplies the sizes of both sides.
    """
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame) -> bool:
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)


def as_lookup(df: DataFrame) -> DataFrame:
    """A scan with one row per key, as the right side of a join with a much longer table.

    Spark broadcasts it while it is small. A larger one is hashed partition by partition, so the longer side is streamed: it
    is not sorted, which spills as soon as a partition outgrows its task, and skewed partitions of it can still be split.
    """
    return df if fits_broadcast(df) else df.hint("shuffle_hash")
