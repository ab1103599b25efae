"""Shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import functions as F

# Key sets up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000

_ROOTS: dict[str, str] = {}


def _hadoop(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with its filesystem, as Spark understands it, for use inside tasks."""
    filesystem, target = _hadoop(spark, path)
    return filesystem.makeQualified(target).toString()


def exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _hadoop(spark, path)
    return filesystem.exists(target)


def workspace(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables.

    Taken from `spark.checkpoint.dir`, which on a cluster names storage every
    executor reaches.  Only where it is unset (single-machine runs, tests) is a
    local folder used.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="releasemill-")
        _ROOTS[app] = f"{qualified(spark, root).rstrip('/')}/releasemill-{uuid.uuid4().hex}"
    return _ROOTS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once as a parquet table in the workspace and read it back.

    Unlike a cache it survives lost executors, and unlike an RDD checkpoint it
    stays columnar, so later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the workspace tables that `df` reads, and nothing else."""
    spark = df.sparkSession
    root = workspace(spark)
    for path in {file.removesuffix("/").rpartition("/")[0] for file in df.inputFiles()}:
        filesystem, target = _hadoop(spark, path)
        if qualified(spark, path).startswith(f"{root}/"):
            filesystem.delete(target, True)


def small_side(keys: DataFrame, count: int) -> DataFrame:
    """Side of a join that is broadcast only if its counted size allows."""
    return F.broadcast(keys) if count <= BROADCAST_ROWS else keys
