"""Quality rules: how many documents of a host share a line.

Lines are normalised (lower case, digits to 0, white space to one blank, trimmed) and hashed, each host's distinct
documents are counted for each line, lines above the limits are removed, and documents that lose too much are rejected.

A line is above the limits if more than ``max_docs`` documents of one host hold it *and* these are more than
``max_share`` of the host's documents.  A document is depleted if less than ``keep_share`` of its words are left, or
fewer than ``min_words``.  Equal lines within a document count once.

The base rules look at each text alone: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

Null text has no words and no lines.  A null source is a host of its own.  Repeated rows are documents of their
own.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import SPACE_CLASS, drop_outer_blanks, let, materialize, word_count_of

SYMBOLS = r"[#*$%&|<>]"
PLACE_BITS = 20


def window_hash(first: Column, second: Column, third: Column) -> Column:
    return F.xxhash64(first, second, third)


def n_repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice.

    Windows are hashed, and hash and place are packed into one long, so that equal windows are neighbours after a
    sort of plain longs.  Neighbours with equal hashes are compared word by word.  Texts of more words than a place has
    bits for carry hash and place side by side.
    """
    n = F.size(words)
    mask = F.lit((1 << PLACE_BITS) - 1)
    hashes = F.transform(F.slice(words, 1, F.greatest(n - 2, F.lit(0))), lambda w, i: window_hash(w, F.get(words, i + 1), F.get(words, i + 2)))
    packed = lambda h: F.transform(h, lambda x, i: F.shiftleft(F.shiftrightunsigned(x, PLACE_BITS), PLACE_BITS).bitwiseOR(i.cast("long")))
    paired = lambda h: F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    small = lambda h: covered(F.sort_array(packed(h)), words, lambda x: x.bitwiseAND(mask).cast("int"), lambda x: F.shiftrightunsigned(x, PLACE_BITS))
    large = lambda h: covered(F.sort_array(paired(h)), words, lambda x: x["i"], lambda x: x["h"])
    counted = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).when(n <= 1 << PLACE_BITS, small(h)).otherwise(large(h))
    return F.when(n < 4, F.lit(0)).otherwise(let(hashes, counted))


def covered(ordered: Column, words: Column, place, key) -> Column:
    """Words that the windows of ``ordered`` cover which equal a neighbour.

    Of different windows with one hash, those that are equal may be parted by another; windows are then sorted by their words.
    """
    same = lambda x, y: equal_words(words, place(x), place(y))
    beside = lambda o: F.zip_with(o, F.slice(o, 2, F.size(o)), lambda x, y: F.when(y.isNotNull() & (key(x) == key(y)), same(x, y)))
    by_words = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(*[F.get(words, i + k).alias(f"w{k}") for k in range(3)], i.alias("i"))))
    next_equal = lambda o: F.zip_with(o, F.slice(o, 2, F.size(o)), lambda x, y: F.coalesce(equal_words(words, x["i"], y["i"]), F.lit(False)))
    exact = let(by_words, lambda o: repeats(o, next_equal(o), lambda x: x["i"]))
    judged = lambda o, e: F.when(F.exists(e, lambda x: ~x), exact).otherwise(repeats(o, F.transform(e, lambda x: F.coalesce(x, F.lit(False))), place))
    return let(ordered, lambda o: let(beside(o), lambda e: judged(o, e)))


def equal_words(words: Column, x: Column, y: Column) -> Column:
    equal = F.get(words, x) == F.get(words, y)
    for k in (1, 2):
        equal = equal & (F.get(words, x + k) == F.get(words, y + k))
    return equal


def repeats(ordered: Column, equals_next: Column, place) -> Column:
    """Words that the windows of ``ordered`` cover of which ``equals_next`` tells that they equal the next or the one before."""
    either = F.zip_with(equals_next, F.concat(F.array(F.lit(False)), F.slice(equals_next, 1, F.size(equals_next) - 1)), lambda x, y: x | y)
    starts = F.sort_array(F.array_compact(F.zip_with(ordered, either, lambda x, f: F.when(f, place(x)))))
    # Each start adds the words that the start before it does not cover.
    added = lambda s: F.zip_with(s, F.concat(F.array(F.lit(-3)), F.slice(s, 1, F.size(s) - 1)), lambda x, y: F.least(F.lit(3), x - y))
    total = lambda s: F.when(F.size(s) == 0, F.lit(0)).otherwise(F.aggregate(added(s), F.lit(0), lambda acc, x: acc + x))
    return let(starts, total)


def base_columns(text: Column) -> tuple[Column, dict[str, Column]]:
    """The word array, and the base figures given that array as column ``words``."""
    words = drop_outer_blanks(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS))
    return words, {
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": (F.length(F.coalesce(text, F.lit(""))) - F.length(F.regexp_replace(F.coalesce(text, F.lit("")), SYMBOLS, ""))).cast("long"),
    }


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def normal_hash(line: Column) -> Column:
    bare = F.trim(F.regexp_replace(F.lower(line), SPACE_CLASS, " "))
    return F.xxhash64(F.regexp_replace(bare, "[0-9]", "0"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, the base figures and ``lines``: array of (hash, words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words, figures = base_columns(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("words", words).withColumn("kept_lines", lines_with_words(text))
    hashed = F.transform("kept_lines", lambda x: F.struct(normal_hash(x).alias("h"), word_count_of(F.split(x, SPACE_CLASS)).alias("n")))
    distinct = F.size(F.array_distinct("kept_lines"))
    return rows.select(
        "doc_id", "source", *[c.alias(k) for k, c in figures.items()],
        (F.size("kept_lines") - distinct).cast("long").alias("n_dup_lines"), n_repeat_words(F.col("words")).cast("long").alias("n_repeat_words"), hashed.alias("lines"),
    )


def assess(docs: DataFrame, max_docs: int = 50, max_share: float = 0.05, keep_share: float = 0.3, min_words: int = 20) -> DataFrame:
    """doc_id, the base figures, base_failed, n_removed (words in removed lines), kept for each row of ``docs`` (doc_id, text, source)."""
    rows = materialize(measured(docs).withColumn("row", F.monotonically_increasing_id()), "measured")
    hosts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("host_docs"))
    lines = rows.select("row", "source", F.explode("lines").alias("line")).select("row", "source", "line.h", "line.n")
    per_doc = rows.select("source", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    often = per_doc.groupBy("source", "h").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > max_docs)
    often = often.alias("o").join(hosts.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).where(F.col("docs") > max_share * F.col("host_docs")).select("o.source", "o.h")
    often = materialize(often, "frequent")
    removed = lines.alias("l").join(often.alias("o"), (F.col("l.h") == F.col("o.h")) & F.col("l.source").eqNullSafe(F.col("o.source")), "left_semi")
    removed = removed.groupBy("row").agg(F.sum("n").cast("long").alias("n_removed"))
    out = rows.drop("lines").join(removed, "row", "left").withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed")
    depleted = (F.col("n_removed") > 0) & ((left < keep_share * F.col("n_words")) | (left < min_words))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "n_removed",
    )
