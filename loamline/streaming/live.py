"""The same operators on streams: files that arrive, and messages that reply to each other in any order."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loamline.plans.ingest import crawled, ingest_files

LINKS = "collection string, entity_id string, reply_to string"
STATE = "held string"


def ingest_stream(
    spark: SparkSession, path: str, out: str, checkpoint: str, files_per_batch: int = 1000, then: Callable[[DataFrame], DataFrame] | None = None, then_out: str | None = None, once: bool = True
) -> StreamingQuery:
    """Extracts files as they arrive below ``path`` and appends their fragments, partitioned by batch, to ``out``.

    The next stage ``then`` (such as the tags of an analysis) goes on with the fragments of each batch, to ``then_out``.  A batch that is run again
    after a failure overwrites its own partitions, so each file's fragments are there once.  The stream ends when all that is there has been
    processed, unless ``once`` is false.
    """
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(fs_path).toString().rstrip("/")
    schema = "path string, modificationTime timestamp, length long, content binary"
    arriving = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(path)

    def write(batch: DataFrame, number: int) -> None:
        files, folders = crawled(batch.select("path", "content"), root)
        written = f"{out}/batch={number}"
        ingest_files(files).fragments.unionByName(folders).write.mode("overwrite").parquet(written)
        if then is not None:
            then(batch.sparkSession.read.parquet(written)).write.mode("overwrite").parquet(f"{then_out}/batch={number}")

    return arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**({"availableNow": True} if once else {"processingTime": "5 seconds"})).start()


def link_replies(key: tuple[str, str], rows: Iterator[pd.DataFrame], state: GroupState, keep_ms: int) -> Iterator[pd.DataFrame]:
    """For one message id: who has it and who replies to it, whichever came first."""
    if state.hasTimedOut:
        state.remove()
        return
    named, asked = (set(x) for x in json.loads(state.get[0])) if state.exists else (set(), set())
    out = []
    for frame in rows:
        for entity, is_reply in zip(frame["entity_id"], frame["is_reply"], strict=True):
            mine, others = (asked, named) if is_reply else (named, asked)
            if entity in mine:
                continue
            mine.add(entity)
            out += [(key[0], entity, o) if is_reply else (key[0], o, entity) for o in sorted(others) if o != entity]
    state.update((json.dumps([sorted(named), sorted(asked)]),))
    state.setTimeoutDuration(keep_ms)
    if out:
        yield pd.DataFrame(out, columns=["collection", "entity_id", "reply_to"])


def thread_links_stream(messages: DataFrame, keep_ms: int = 86_400_000) -> DataFrame:
    """(collection, entity_id, reply_to) of a stream of messages (collection, entity_id, message_id, in_reply_to).

    The state of a message id lives ``keep_ms`` beyond its last use.  Links do not depend on the order of arrival.
    """
    sides = F.array(F.struct(F.col("message_id").alias("id"), F.lit(False).alias("is_reply")), F.struct(F.col("in_reply_to").alias("id"), F.lit(True).alias("is_reply")))
    rows = messages.select("collection", "entity_id", F.explode(sides).alias("s")).select("collection", "entity_id", "s.id", "s.is_reply").where("id is not null")
    return rows.groupBy("collection", "id").applyInPandasWithState(
        lambda key, frames, state: link_replies(key, frames, state, keep_ms), LINKS, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout
    )
