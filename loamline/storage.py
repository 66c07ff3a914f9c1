"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; unset, a temp folder in local mode, and an error on a cluster, whose executors would not see it."""
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_to:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        set_to = f"file://{tempfile.mkdtemp(prefix='loamline-')}"
        spark.conf.set("spark.checkpoint.dir", set_to)
    return set_to.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it back; the files go when the JVM ends.

    Cuts the lineage: a lost executor costs a reread of these files, never of what led to them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loamline/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """Among how many tasks files are dealt: four a core, and no fewer than shuffles have."""
    return max(4 * max(spark.sparkContext.defaultParallelism, 8), int(spark.conf.get("spark.sql.shuffle.partitions")))


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What is run within sends at most about ``size`` bytes to a Python worker at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)
