"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Rows get gapless numbers 0..N-1 by (hash bucket, id, checksum), in two steps: a count for each bucket, then a
rank within the bucket, so that no task sees more than a bucket.  A keyed Feistel network over Z_a x Z_b
(a*b >= N, a*b - N < a) permutes the numbers; a result beyond N is walked on until it falls inside.  Shard is
the permuted number modulo the shard count, slot its quotient: shard sizes differ by one at most and both can be
computed for any row number without data.

Law: ``rows``.  Null text: size 1, crc 0.  Null ids sort first.  Repeated rows get numbers of their own and,
as they are equal, may swap them.  An empty table gives an empty result.  Extra columns are ignored by
:func:`shard_rows`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamline.llm.common import fresh, materialize, quoted

ROUNDS = 4
#: Steps of cycle walking.  At most a - 1 numbers lie beyond N, so one step fails with a chance under
#: 1/sqrt(N), and for N up to 1000 this many steps always reach the inside.
WALKS = 33


def halves(n: Column) -> tuple[Column, Column]:
    a = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    a = F.greatest(a, F.lit(1))
    return a, F.greatest(F.ceil(n.cast("double") / a).cast("long"), F.lit(1))


def round_value(i: Column, x: Column, seed: int) -> Column:
    """A keyed 32-bit function of x for round i, from the first 8 hex digits of an md5."""
    text = F.concat_ws(":", F.lit(str(seed)), i.cast("string"), x.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def feistel(x: Column, a: Column, b: Column, seed: int) -> Column:
    """One pass of the network over 0..a*b-1, a permutation for any a and b."""

    def step(acc: Column, i: Column) -> Column:
        left, right = acc["l"], acc["r"]
        return F.when(i % 2 == 0, F.struct(((left + round_value(i, right, seed)) % a).alias("l"), right.alias("r"))).otherwise(
            F.struct(left.alias("l"), ((right + round_value(i, left, seed)) % b).alias("r"))
        )

    start = F.struct(F.floor(x / b).cast("long").alias("l"), (x % b).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda acc: acc["l"] * b + acc["r"])


def permuted(row: Column, n: Column, a: Column, b: Column, seed: int) -> Column:
    """Row number to permuted row number: walks the cycle until the result is below n."""

    def step(acc: Column, _: Column) -> Column:
        return F.when((acc >= 0) & (acc < n), acc).otherwise(feistel(F.when(acc < 0, -acc - 1).otherwise(acc), a, b, seed))

    # -row-1 marks a number that has not been through the network yet.
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), -row - 1, step)


def numbered(rows: DataFrame, order: list[str], buckets: int | None = None) -> DataFrame:
    """Adds ``row`` (0..N-1 by hash bucket and ``order``), ``n`` = N, and the bucket's number."""
    if buckets is None:
        buckets = max(1024, rows.count() // 50_000)
    slim = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.orderBy("bucket")
    starts = (
        slim.groupBy("bucket").agg(F.count(F.lit(1)).alias("in_bucket"))
        .withColumn("row_from", F.sum("in_bucket").over(before) - F.col("in_bucket"))
        .withColumn("n", F.sum("in_bucket").over(before.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select("bucket", "row_from", "n")
    )
    ranked = slim.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy(*order)))
    return ranked.join(starts, "bucket").withColumn("row", F.col("row_from") + F.col("rank") - 1).drop("rank", "row_from")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the whole row as ``doc``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    figures = [F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]
    return docs.select(*figures, F.struct(*quoted(docs)).alias("doc"))


def shard_rows(docs: DataFrame, shards: int = 8, seed: int = 20240607, buckets: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row for each row of ``docs`` (doc_id, text)."""
    out = placed(numbered(materialize(sized(docs).drop("doc"), "rows"), ["doc_id", "text_crc32", "size"], buckets), shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row")


def shard_docs(docs: DataFrame, shards: int = 8, seed: int = 20240607, buckets: int | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, and shard and slot (with underscores behind them where ``docs`` has such columns)."""
    out = placed(numbered(sized(docs), ["doc_id", "text_crc32", "size"], buckets), shards, seed)
    named = [F.col(c).alias(fresh(c, docs.columns)) for c in ("shard", "slot")]
    return out.select(*[F.col("doc")[c].alias(c) for c in docs.columns], *named)


def placed(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    """Adds shard and slot to rows that carry ``row`` and ``n``."""
    a, b = halves(F.col("n"))
    at = rows.withColumn("a", a).withColumn("b", b).withColumn("at", permuted(F.col("row"), F.col("n"), F.col("a"), F.col("b"), seed))
    return at.withColumn("shard", (F.col("at") % shards).cast("int")).withColumn("slot", F.floor(F.col("at") / shards).cast("long")).drop("a", "b", "at")
