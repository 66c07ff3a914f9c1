"""Control of streams and caches: cancelling, and clearing what was held."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def cancel(spark: SparkSession, name: str | None = None, checkpoint: str | None = None) -> list[str]:
    """Stops the running streams, or that of a name, and forgets the positions in ``checkpoint``: what waited will be seen anew.  Returns the ids."""
    stopped = []
    for q in spark.streams.active:
        if name is None or q.name == name:
            q.stop()
            stopped.append(str(q.id))
    if checkpoint is not None:
        path, fs = _path(spark, checkpoint)
        fs.delete(path, True)
    return stopped


def cache_results(rows: DataFrame, path: str, kind: str) -> None:
    """Adds results (key, ...) of one kind of work to the cache at ``path``; what is known of a key is not added twice."""
    spark = rows.sparkSession
    jvm_path, fs = _path(spark, f"{path}/kind={kind}")
    if fs.exists(jvm_path):
        rows = rows.join(spark.read.parquet(jvm_path.toString()).select("key"), "key", "left_anti")
    rows.withColumn("kind", F.lit(kind)).write.mode("append").partitionBy("kind").parquet(path)


def cache_clear(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Deletes the cached results of all kinds of work that begin with ``prefix``, and returns those kinds."""
    root, fs = _path(spark, path)
    gone = []
    if fs.exists(root):
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith(f"kind={prefix}"):
                fs.delete(status.getPath(), True)
                gone.append(name.removeprefix("kind="))
    return sorted(gone)
