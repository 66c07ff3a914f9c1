"""Files in, fragments out: crawl, auction, extraction, and again for the files found inside, until there are none."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline import registry
from loamline.functions import text as T
from loamline.model import SEPARATOR, entity_id, make_id
from loamline.operators.relational import auction
from loamline.registry import Extractor
from loamline.sources import documents, mail, ole, packages, pdf, tables
from loamline.sources.base import ENCRYPTED, NOT_SUPPORTED, Child, Extract, Failed, File, Result, collapse
from loamline.sources.programs import PROGRAMS
from loamline.storage import arrow_batches, materialize, tasks

FILE = "entity_id string, schema string, file_name string, mime string, content binary, parent string, ancestors array<string>"
ROW = "kind string, entity_id string, fragment string, schema string, props map<string,array<string>>, file_name string, mime string, content binary, parent string, ancestors array<string>, extractor string, status string, file_size long, seconds double"
AGENT = "loamline"

#: What each extractor does; :func:`register` adds one.
EXTRACT: dict[str, Extract] = {
    "ignore": lambda file: Result(), "html": documents.html, "xml": documents.xml, "plain": documents.plain, "opendoc": tables.opendoc, "ooxml": tables.ooxml,
    "zip": packages.unzip, "tar": packages.untar, "gz": packages.gunzip, "bz2": packages.bunzip2, "olm": mail.olm, "opfmsg": mail.opf_message, "msg": mail.rfc822, "emlx": mail.emlx,
    "vcard": documents.vcard, "calendar": documents.calendar, "csv": tables.csv_file, "sqlite": tables.sqlite, "xlsx": tables.xlsx, "ods": tables.ods, "mbox": mail.mbox, "dbf": tables.dbf,
    "svg": documents.svg, "json": documents.json_file, "pdf": pdf.pdf, "olemsg": ole.outlook_message, "xls": ole.xls, **PROGRAMS,
}


@dataclass(frozen=True)
class Ingested:
    fragments: DataFrame
    runs: DataFrame


def crawl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(files, folder fragments) below ``path``.  Hidden version folders and the like are left out."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(fs_path).toString().rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    # The scan leaves out files of no bytes; the listing that it is planned from, which the driver holds as for any scan, has them.
    listed = spark.createDataFrame(((f,) for f in found.inputFiles()), "value string")
    names = F.url_decode(F.replace(F.regexp_replace("value", r"^(\w+):///", "$1:/"), F.lit("+"), F.lit("%2B")))
    empty = listed.select(names.alias("path")).join(found.select("path"), "path", "left_anti").withColumn("content", F.lit(b""))
    return crawled(found.unionByName(empty), root)


def crawled(found: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(files, folder fragments) of rows (path, content) of a crawl of ``root``."""
    parts = F.filter(F.split(F.expr(f"substring(path, {len(root) + 1})"), "/"), lambda p: p != "")
    rows = found.withColumn("parts", parts).where(~F.exists("parts", lambda p: p.isin(sorted(packages.SKIPPED))) & (F.size("parts") > 0))
    step = lambda acc, name: F.sha1(F.concat_ws(SEPARATOR, acc, name).cast("binary"))
    folder_ids = F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda k: F.aggregate(F.slice("parts", 1, k), F.lit(None).cast("string"), step))
    rows = rows.withColumn("above", F.when(F.size("parts") > 1, folder_ids).otherwise(F.array().cast("array<string>")))
    name = F.element_at("parts", -1)
    files = rows.select(
        entity_id(name, F.sha1("content")).alias("entity_id"), F.lit("Document").alias("schema"), name.alias("file_name"), F.lit(None).cast("string").alias("mime"), "content",
        F.try_element_at("above", F.lit(-1)).alias("parent"), F.col("above").alias("ancestors"),
    )
    places = rows.where(F.size("above") > 0).select("parts", "above", F.posexplode("above").alias("k", "entity_id"))
    upper = F.slice("above", 1, F.col("k"))
    texts = lambda c: F.array(c)
    props = F.map_from_arrays(F.array(F.lit("fileName"), F.lit("parent"), F.lit("ancestors")), F.array(texts(F.get("parts", F.col("k"))), F.filter(texts(F.get("above", F.col("k") - 1)), lambda x: x.isNotNull()), upper))
    folders = places.select("entity_id", F.lit("").alias("fragment"), F.lit("Folder").alias("schema"), F.map_filter(props, lambda _, v: F.size(v) > 0).alias("props"))
    return files, folders.dropDuplicates(["entity_id"])


def register(extractor: Extractor, extract: Extract, family: tuple[str, int] | None = None) -> None:
    """Adds a format: its bid, and the function that extracts it.  One of a name that is known takes its place.

    ``family``: the start of media types, such as ``image/``, and what is bid for any other file of those.  The function goes to the tasks with
    the plan, so it need not be installed on the executors.
    """
    registry.add(extractor, family)
    EXTRACT[extractor.name] = extract


def run_one(extract: dict[str, Extract], extractor: str | None, file: File, mime: str | None) -> Result:
    """Result of one file; what it streams is still to come."""
    if mime == "application/encrypted":
        raise Failed(ENCRYPTED)
    if extractor is None:
        raise Failed(NOT_SUPPORTED)
    if extractor not in extract:
        raise Failed(f"The extractor for this format is unavailable: {extractor}")
    return extract[extractor](file)


#: Rows, and bytes of files and of texts, that make a batch.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def extracting(extract: dict[str, Extract]):
    """A mapInArrow function: files with their extractor to rows of fragments and of files inside, written as they are found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ROW.split(", ")]
        types = [pa.string()] * 4 + [pa.map_(pa.string(), pa.list_(pa.string()))] + [pa.string()] * 2 + [pa.binary(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64(), pa.float64()]
        schema = pa.schema(list(zip(names, types, strict=True)))
        none = dict.fromkeys(names)
        held, size = [], 0
        for batch in batches:
            columns = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names)]
            for k in range(batch.num_rows):
                for r in rows_of(extract, {n: c[k].as_py() for n, c in columns}):
                    held.append(none | r)
                    size += weight(r)
                    if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema)

    return run


def weight(row: dict) -> int:
    """About the bytes of a row's content and texts."""
    return len(row.get("content") or b"") + sum(len(v) for _, values in row.get("props") or () for v in values)


def rows_of(extract: dict[str, Extract], row: dict) -> Iterator[dict]:
    """What one file gives, and last its own row with the status.  No file makes the task fail."""
    content = row["content"] or b""
    above = tuple(row["ancestors"] or ())
    file = File(row["entity_id"], row["file_name"], content, row["mime"], above)
    began = time.monotonic()
    result, status, error = Result(), "success", None
    try:
        result = run_one(extract, row["extractor"], file, row["mime"])
        for x in (*result.fragments, *result.children):
            yield row_of(file, x)
        for x in result.stream:
            yield row_of(file, x)
    except Failed as failed:
        status, error = "failure", str(failed)
    except Exception as unknown:  # noqa: BLE001  an unknown error is this file's failure alone
        status, error = "failure", f"{type(unknown).__name__}: {unknown}"
    schema = result.schema or row["schema"]
    props = {k: v for k, v in result.props.items() if v}
    base = {
        "fileName": [file.name], "contentHash": [hashlib.sha1(content).hexdigest()], "fileSize": [str(len(content))], "mimeType": [row["mime"], *props.pop("mimeType", [])], "parent": [row["parent"]], "ancestors": [*above],
        "processingStatus": [status], "processingAgent": [AGENT], "processingError": [error],
    }
    props |= {k: known for k, vs in base.items() if (known := [v for v in dict.fromkeys(vs) if v])}
    yield {
        "kind": "fragment", "entity_id": file.entity_id, "fragment": "", "schema": schema, "props": list(props.items()), "extractor": row["extractor"], "status": status, "file_size": len(content),
        "seconds": time.monotonic() - began,
    }


def row_of(file: File, x: Child | tuple) -> dict:
    if not isinstance(x, Child):
        entity, fragment, kind, own = x
        return {"kind": "fragment", "entity_id": entity, "fragment": fragment, "schema": kind, "props": list(own.items())}
    name = collapse(x.name)
    return {
        "kind": "child", "entity_id": x.entity_id or make_id(name, hashlib.sha1(x.content).hexdigest()), "schema": x.schema, "file_name": name, "mime": x.mime, "content": x.content,
        "parent": x.parent or file.entity_id, "ancestors": list(x.ancestors) or [*file.ancestors, file.entity_id],
    }


def ingest_files(files: DataFrame) -> Ingested:
    """Extracts files (``FILE``), what is inside them, and so on until there is nothing inside.

    Each round is written once, so nothing is extracted twice.
    """
    fragments, runs, todo = [], [], files
    extract = extracting(dict(EXTRACT))
    while not fragments or not todo.isEmpty():
        sized = todo.withColumn("file_size", F.coalesce(F.octet_length("content"), F.lit(0)).cast("long")).withColumn("sniffed", T.sniff(F.col("content")))
        sized = sized.withColumn("mime", F.coalesce("mime", "sniffed"))
        routed = auction(sized).select("entity_id", "schema", "file_name", "mime", "content", "parent", "ancestors", "extractor")
        with arrow_batches(files.sparkSession, BATCH_BYTES):
            done = materialize(routed.mapInArrow(extract, ROW), "extracted")
        fragments.append(done.where("kind = 'fragment'").select("entity_id", "fragment", "schema", "props"))
        runs.append(done.where("status is not null").select("entity_id", "extractor", "status", "file_size", "seconds"))
        todo = done.where("kind = 'child'").select("entity_id", "schema", "file_name", "mime", "content", "parent", "ancestors")
        # A file inside itself is there already.  Files inside are small but take long, so they are dealt to as many tasks as made ones, where few bytes would become few tasks.
        todo = todo.where(~F.array_contains("ancestors", F.col("entity_id"))).repartition(tasks(files.sparkSession), "entity_id", "parent").dropDuplicates(["entity_id", "parent"])
    every, all_runs = fragments[0], runs[0]
    for f, r in zip(fragments[1:], runs[1:], strict=True):
        every, all_runs = every.unionByName(f), all_runs.unionByName(r)
    return Ingested(every, all_runs)


def ingest(spark: SparkSession, path: str) -> Ingested:
    """All files below ``path``."""
    files, folders = crawl(spark, path)
    out = ingest_files(files)
    return Ingested(out.fragments.unionByName(folders), out.runs)
