"""Shared helpers of the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the plain contract: runs of anything but ASCII white space.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
#: Separators of the alphanumeric contract: ASCII that is neither letter nor digit.
PUNCT_CLASS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; unset, a temp folder in local mode, and an error on a cluster."""
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not set_to:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that the driver and all executors share")
        set_to = f"file://{tempfile.mkdtemp(prefix='loamline-')}"
        spark.conf.set("spark.checkpoint.dir", set_to)
    return set_to.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back; the files go when the JVM ends.

    Cuts the lineage: a lost executor costs a reread of these files, never of what led to them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/loamline/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = hadoop_path
    if _scratch:
        _scratch[-1].append(out)
    return out


_scratch: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """The tables that are written within, so that they can be released together."""
    _scratch.append([])
    try:
        yield _scratch[-1]
    finally:
        _scratch.pop()


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs within sends at most about ``size`` bytes to a Python worker at once."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def release(*tables: DataFrame) -> None:
    """Deletes what :func:`materialize` wrote of ``tables``, which nothing reads any more."""
    for t in tables:
        path = t.__dict__.pop("_written_to", None)
        if path is not None:
            path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id's decimal text; null counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def plain_words(text: Column) -> Column:
    """Array of ``[^\\x20\\x09-\\x0D]+`` words; null text gives an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_CLASS)
    return drop_outer_blanks(parts)


def alnum_words(text: Column) -> Column:
    """Array of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` words; null text gives an empty array."""
    return drop_outer_blanks(F.split(F.coalesce(text, F.lit("")), PUNCT_CLASS))


def drop_outer_blanks(parts: Column) -> Column:
    """Splitting on runs leaves an empty string at the front, the end or both; nowhere else."""
    first = F.when(F.element_at(parts, 1) == "", 2).otherwise(1)
    return F.slice(parts, first, F.greatest(word_count_of(parts), F.lit(0)))


def word_count_of(parts: Column) -> Column:
    n = F.size(parts)
    head = (F.element_at(parts, 1) == "").cast("int")
    tail = ((n > 1) & (F.element_at(parts, -1) == "")).cast("int")
    return n - head - tail


def plain_word_count(text: Column) -> Column:
    return word_count_of(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased.  Other letters may be too, but none turns into ASCII: the two that would are left out of ``lower``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(text.rlike("[\u0130\u212A]"), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it stands in ``body`` and its lambdas."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with as many underscores as make it differ from all ``taken`` (case aside)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def quoted(df: DataFrame, without: tuple[str, ...] = ()) -> list[Column]:
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c not in without]
