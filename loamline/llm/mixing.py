"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets.  Sources share ``share`` of all words by weight; none is taken more than ``most`` times, and what
that leaves over goes to the others by weight.  Sorted by the level at which each source is full, this is one running
sum.  A target is rounded to whole words.

Blocks.  A source's documents lie in an order permuted by a keyed hash, cut into blocks of about equal numbers of words at document
bounds.  The position of a document is a sum over hash buckets plus a sum within its bucket, so no task holds a source.
Blocks of a source are drawn without replacement, in a permuted order, another in each pass; every block is drawn once before any is
drawn again.  Draws go on up to the target, so the last block drawn is taken in part.

Quotas.  What a source's draws come to is its exact quota of blocks.  A splitting tree halves the output shards again and
again: at each node every source's quota is divided by drawing without replacement, so that both sides get their
exact number of blocks and the composition follows the multivariate hypergeometric law.  Drawn blocks, permuted once more, are dealt to the
shards by these quotas.  A document is taken as its block was dealt, and in no other way; each shard's rows have a local shuffle key.

Null text has size 0 and takes nothing.  Null sources are a source of their own, last in order.  Repeated rows are
rows of their own.  An empty table, or one without words, takes nothing.  Extra columns are ignored.  Sources are few against documents: one
row for each, and one for each of the blocks, go through one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamline.llm.common import fresh, materialize, plain_word_count, quoted

ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target (double) from (source, source_size).

    One row for each source goes through one window; rows of documents never do.
    """
    # Spark orders strings by their UTF-8 bytes, which is the order of code points.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    which = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (which + 1).cast("int"))
    cap = F.col("source_size") * F.lit(float(most))
    # Held in whole numbers as long as possible: running sums of longs don't depend on their order.
    rows = sizes.select("source", "source_size", weight.alias("weight")).withColumn("cap", cap).withColumn("level", F.col("cap") / F.col("weight"))
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    everything = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(*ALL)
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("open", F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
    rows = rows.withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    # The water level is set by the first source that does not fill up.
    rows = rows.withColumn("reach", F.col("open") / F.col("open_weight"))
    level = F.min(F.when(F.col("reach") < F.col("level"), F.struct("level", "reach"))).over(everything)["reach"]
    return rows.withColumn("water", level).select(
        "source", "source_size", F.when(F.col("water").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("water") * F.col("weight"))).alias("target")
    )


def random_key(*parts: Column) -> Column:
    """Hexadecimal md5 of the parts: a key that other engines give too."""
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def positions(rows: DataFrame, seed: int, buckets: int) -> DataFrame:
    """Adds ``at``: the words that stand before a row (doc_id, digest, source, size) in its source's permuted order.

    A bucket is a range of the random key, so rows in order of (bucket, key) are in order of the key.
    """
    rows = rows.withColumn("key", random_key(F.lit(seed), F.col("doc_id"), F.col("digest"))).drop("digest")
    rows = rows.withColumn("bucket", F.shiftright(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(buckets), 32).cast("int"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = Window.partitionBy("source").orderBy("bucket")
    sums = sums.select("source", "bucket", (F.sum("in_bucket").over(before) - F.col("in_bucket")).alias("bucket_from"))
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = rows.withColumn("upto", F.sum("size").over(within)).alias("r")
    joined = ranked.join(sums.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.bucket") == F.col("s.bucket")))
    return joined.select("r.doc_id", "r.source", "r.size", (F.col("s.bucket_from") + F.col("r.upto") - F.col("r.size")).alias("at"))


def mix(docs: DataFrame, shards: int = 8, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5, most: int = 2, seed: int = 20240607, blocks: int = 4096, buckets: int | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken, and for each pass ``take0``.. (words) and ``shard0``.. (null if it takes nothing).

    One row for each row of ``docs`` (doc_id, text, source).  The sources are cut into about ``blocks`` blocks in all, one more for each source at
    most.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), plain_word_count(text).alias("size"), F.md5(text.cast("binary")).alias("digest"),
    )
    rows = materialize(rows, "sizes")
    if buckets is None:
        buckets = max(256, rows.count() // 50_000)
    # The shares of sources are few rows; they are written so that nothing below counts them again.
    aims = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, float(most))
    width = F.greatest(F.lit(1).cast("long"), F.ceil(F.sum("source_size").over(Window.partitionBy(F.lit(1)).rowsBetween(*ALL)) / blocks))
    aims = materialize(aims.withColumn("words", F.round("target").cast("long")).withColumn("width", width), "targets")
    placed = positions(rows, seed, buckets).alias("r").join(aims.alias("a"), F.col("r.source").eqNullSafe(F.col("a.source"))).select("r.*", F.floor(F.col("at") / F.col("a.width")).cast("long").alias("block"))
    placed = materialize(placed, "placed")
    dealt = dealt_blocks(placed, aims, shards, most, seed)
    out = placed.alias("r").join(aims.alias("a"), F.col("r.source").eqNullSafe(F.col("a.source"))).select("r.*", "a.source_size", "a.target")
    out = out.alias("r").join(dealt.alias("d"), F.col("r.source").eqNullSafe(F.col("d.source")) & (F.col("r.block") == F.col("d.block")), "left")
    none = F.lit(0).cast("long")
    taken = [F.when(F.col(f"d.room{k}").isNull(), none).otherwise(F.greatest(none, F.least(F.col("r.size"), F.col(f"d.room{k}") - F.col("r.at") + F.col("d.start")))).alias(f"take{k}") for k in range(most)]
    out = out.select("r.doc_id", "r.size", "r.source_size", "r.target", *taken, *[F.col(f"d.shard{k}").alias(f"shard{k}") for k in range(most)])
    every = sum((F.col(f"take{k}") for k in range(1, most)), F.col("take0"))
    return out.select("doc_id", "size", "source_size", "target", every.alias("taken"), *[f"take{k}" for k in range(most)], *[F.when(F.col(f"take{k}") > 0, F.col(f"shard{k}")).alias(f"shard{k}") for k in range(most)])


def splitting_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source, blocks) to (source, shard, blocks): exact quotas, hypergeometric composition.

    Every block has a token.  A node shuffles its tokens and the first go left, as many as the left half of its shards takes:
    the sources' shares of that half then follow the multivariate hypergeometric law.  There are as many tokens as blocks, whatever the input.
    """
    tokens = quotas.where("blocks > 0").select("source", F.explode(F.sequence(F.lit(1).cast("long"), F.col("blocks"))).alias("token"))
    everything = Window.partitionBy(F.lit(1)).rowsBetween(*ALL)
    node = tokens.withColumn("all", F.count(F.lit(1)).over(everything)).withColumn("low", F.lit(0)).withColumn("high", F.lit(shards))
    upto = lambda shard: F.floor(F.col("all") * shard / F.lit(shards))  # noqa: E731  whole numbers of blocks before a shard
    for level in range(max(1, (shards - 1).bit_length())):
        half = F.ceil((F.col("low") + F.col("high")) / 2).cast("int")
        shuffled = Window.partitionBy("low", "high").orderBy(random_key(F.lit(seed), F.lit("tree"), F.lit(level), F.col("source"), F.col("source").isNull(), F.col("token")))
        node = node.withColumn("half", half).withColumn("left", F.row_number().over(shuffled) <= upto(F.col("half")) - upto(F.col("low")))
        node = node.select("source", "token", "all", F.when(F.col("left"), F.col("low")).otherwise(F.least("half", F.col("high") - 1)).alias("low"), F.when(F.col("left"), F.col("half")).otherwise(F.col("high")).alias("high"))
    return node.groupBy("source", F.col("low").alias("shard")).agg(F.count(F.lit(1)).alias("blocks"))


def dealt_blocks(placed: DataFrame, aims: DataFrame, shards: int, most: int, seed: int) -> DataFrame:
    """(source, block, start) of drawn blocks, and for each pass the shard that got it and the words that it may give (``room``)."""
    held = placed.groupBy("source", "block").agg(F.sum("size").alias("words"), F.min("at").alias("start")).where("words > 0")
    held = held.alias("h").join(aims.alias("a"), F.col("h.source").eqNullSafe(F.col("a.source"))).select("h.*", F.col("a.words").alias("aim"))
    offered = held.select("*", F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass"))
    named = lambda what: random_key(F.lit(seed), F.lit(what), F.col("pass"), F.col("source"), F.col("source").isNull(), F.col("block"))
    earlier = Window.partitionBy("source").orderBy("pass", named("draw"), "block").rowsBetween(Window.unboundedPreceding, -1)
    drawn = offered.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0).cast("long"))).where("before < aim")
    drawn = materialize(drawn.select("source", "block", "start", "pass", F.least("words", F.col("aim") - F.col("before")).alias("room")), "drawn")
    running = Window.partitionBy("source").orderBy("shard")
    tree = splitting_tree(drawn.groupBy("source").agg(F.count(F.lit(1)).alias("blocks")), shards, seed)
    ends = tree.withColumn("upto", F.sum("blocks").over(running)).select("source", "shard", F.explode(F.sequence(F.col("upto") - F.col("blocks") + 1, F.col("upto"))).alias("place"))
    numbered = drawn.withColumn("place", F.row_number().over(Window.partitionBy("source").orderBy(named("deal"), "pass", "block")))
    dealt = numbered.alias("d").join(ends.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d.place") == F.col("e.place"))).select("d.*", "e.shard")
    of = lambda k, c: F.max(F.when(F.col("pass") == k, F.col(c))).alias(f"{c}{k}")
    return materialize(dealt.groupBy("source", "block", "start").agg(*[of(k, c) for k in range(most) for c in ("shard", "room")]), "dealt")


def mix_into_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, source_size, target, taken, shard0, shard1 for each row of ``docs`` (doc_id, text, source)."""
    return mix(docs, shards).select("doc_id", "size", "source_size", "target", "taken", "shard0", "shard1")


def copies(docs: DataFrame, shards: int = 8, seed: int = 20240607) -> DataFrame:
    """The mix itself: the rows of ``docs``, once for each pass that takes some of them, with ``shard`` and ``order``.

    A row that a pass takes in part is there whole: its source then has at most that row's words more than its target.
    """
    row, shard, order = (fresh(n, docs.columns) for n in ("row", "shard", "order"))
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "docs")
    placed = mix(rows.select(F.col(row).alias("doc_id"), "text", "source"), shards)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("pass"), F.col(f"shard{k}").alias("shard"), F.col(f"take{k}").alias("words")) for k in range(2)]))
    taken = placed.select(F.col("doc_id").alias(row), each.alias("p")).where("p.words > 0")
    taken = taken.select(row, F.col("p.shard").alias(shard), F.xxhash64(F.lit(seed), row, "p.pass").alias(order))
    return rows.join(taken, row).select(*quoted(docs), shard, order)
