"""Commands: ``python -m loamline ingest|process|analyze|debug|cancel|cache-clear``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from loamline.model import merge
from loamline.plans.analyze import analyze
from loamline.plans.ingest import ingest
from loamline.streaming.control import cache_clear, cancel
from loamline.streaming.live import ingest_stream


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="loamline")
    commands = out.add_subparsers(dest="command", required=True)

    def add(name: str, says: str, *args: str) -> argparse.ArgumentParser:
        own = commands.add_parser(name, help=says)
        for a in args:
            own.add_argument(a)
        return own

    add("ingest", "extract all files below PATH into fragments at OUT", "path", "out")
    add("analyze", "tag the fragments at PATH; tags and mentions go below OUT", "path", "out")
    process = add("process", "extract and tag files as they arrive below PATH, until stopped", "path", "out", "checkpoint")
    process.add_argument("--once", action="store_true", help="end when all that is there has been processed")
    add("debug", "show the merged entities of the files below PATH", "path")
    add("cancel", "forget the positions of a stream in CHECKPOINT", "checkpoint")
    add("cache-clear", "delete cached results at PATH", "path").add_argument("--prefix", default="")
    return out


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    asked = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("loamline").getOrCreate()
    if asked.command == "ingest":
        ingest(spark, asked.path).fragments.write.mode("append").parquet(asked.out)
    elif asked.command == "analyze":
        out = analyze(spark.read.parquet(asked.path))
        out.tags.write.mode("overwrite").parquet(f"{asked.out}/tags")
        out.mentions.write.mode("overwrite").parquet(f"{asked.out}/mentions")
    elif asked.command == "process":
        then = lambda fragments: analyze(fragments).tags
        stream = ingest_stream(spark, asked.path, f"{asked.out}/fragments", asked.checkpoint, then=then, then_out=f"{asked.out}/tags", once=asked.once)
        stream.awaitTermination()
    elif asked.command == "debug":
        merge(ingest(spark, asked.path).fragments).show(truncate=False)
    elif asked.command == "cancel":
        cancel(spark, checkpoint=asked.checkpoint)
    else:
        print("\n".join(cache_clear(spark, asked.path, asked.prefix)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
