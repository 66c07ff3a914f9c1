"""Near-duplicate detection by min-max hashing.

A document's set holds its distinct 4-word shingles (fewer words: the whole sequence as one).  Each of 64 random
permutations gives two signature values, the minimum and the maximum of the permuted set, so 128 values cost 64
hash evaluations.  32 bands of 4 values (both ends of two permutations) find candidates: a pair at similarity 0.8
shares no band with a chance of 5e-8.  Links are confirmed on full sets.

Equal sets are one class, found by a 128-bit fingerprint, before anything is paired.  Within a band's bucket of
up to ``SMALL`` classes all pairs are candidates; in larger ones each class is paired with the bucket's centre, another in
every band, which is linear in the bucket.  What this leaves in different components is matched by the rarest
elements in which it differs from a centre (:func:`across`), which misses no link.

Null text, and text without words, has the empty set: n_shingles 0, linked with nothing.  Repeated rows and exact
copies share a class; a null id is never the smallest of a component that has others.  An empty table gives an
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamline.llm.common import arrow_batches, fresh, materialize, quoted, release, scratch

SHINGLE, PERMUTATIONS, BANDS, SMALL = 4, 64, 32, 8
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEGMENT = 1 << 20
#: Bytes that a worker is sent at once.
BATCH_BYTES = 32 << 20
_random = np.random.default_rng(20240607)
BYTE_VALUES = _random.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C17)
PLACES = _random.integers(1, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLIERS = (_random.integers(1, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
MASKS = _random.integers(1, 1 << 63, PERMUTATIONS, np.uint64)[:, None]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, _held: list[np.ndarray] = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006  grows once in a worker
    if len(_held[0]) < n:
        out = np.full(max(n, 4096), STEP, np.uint64)
        out[0] = 1
        _held[0] = np.multiply.accumulate(out)
    return _held[0]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each run of non-blank bytes, after A-Z is lower-cased."""
    text = text.translate(LOWER)
    out, at = [], 0
    while at < len(text):
        end = min(at + SEGMENT, len(text))
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        out.append(segment_hashes(np.frombuffer(text, np.uint8, end - at, at)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def segment_hashes(raw: np.ndarray) -> np.ndarray:
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[1], blank.view(np.int8), [1]]))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    inside = raw[~blank]
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(inside)) - np.repeat(offsets, lengths)
    return mix(np.add.reduceat(BYTE_VALUES[inside] * powers(int(lengths.max()))[place], offsets))


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    joined = [t or b"" for t in texts]
    out: list[np.ndarray] = []
    start = 0
    while start < len(joined):  # texts are hashed together up to a segment's size
        end, size = start, 0
        while end < len(joined) and (end == start or size + len(joined[end]) <= SEGMENT):
            size += len(joined[end])
            end += 1
        group = joined[start:end]
        words = word_hashes(b" ".join(group))
        counts = [len(t.split()) for t in group]
        at = 0
        for n in counts:
            out.append(shingles(words[at : at + n]))
            at += n
        start = end
    return out


def shingles(words: np.ndarray) -> np.ndarray:
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE:
        return mix((words * PLACES[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
    m = n - SHINGLE + 1
    return np.unique(mix(sum(words[i : i + m] * PLACES[i] for i in range(SHINGLE))))


def bands_of(shingle_set: np.ndarray) -> np.ndarray:
    """A key for each band of the min-max signature."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingle_set), 2048):
        values = (shingle_set[None, at : at + 2048] ^ MASKS) * MULTIPLIERS
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    ends = mix(low + STEP) + high * PLACES[0]
    pairs = mix(ends.reshape(BANDS, -1) * PLACES[None, : PERMUTATIONS // BANDS])
    return mix(pairs.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * STEP)


def fingerprint(shingle_set: np.ndarray) -> bytes:
    n = np.uint64(len(shingle_set))
    a = mix(shingle_set + STEP).sum(dtype=np.uint64) + n
    b = mix(shingle_set ^ PLACES[1]).sum(dtype=np.uint64) * PLACES[2]
    return a.tobytes() + b.tobytes()


SIGNED = "doc_id long, n_shingles long, k binary, bands array<long>"


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                sets = shingle_sets(part.column(1).cast(pa.binary()).to_pylist())
                filled = [s for s in sets if len(s)]
                keys = np.concatenate([bands_of(s) for s in filled]).view(np.int64) if filled else np.zeros(0, np.int64)
                offsets = np.concatenate([[0], np.cumsum([BANDS if len(s) else 0 for s in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys, pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "k", "bands"],
                )


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, text) to (k, set) where the text has that fingerprint."""
    with np.errstate(over="ignore"):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = shingle_sets(part.column(1).cast(pa.binary()).to_pylist())
                both = [(k, s.tobytes()) for k, s in zip(part.column(0).to_pylist(), sets, strict=True) if len(s) and fingerprint(s) == k]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in both], pa.binary()), pa.array([x[1] for x in both], pa.binary())], names=["k", "shingles"])


def confirm(percent: int):
    """(a, b, set of a, set of b) to the pairs with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = batch.columns
            linked = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    linked.append(i)
            at = pa.array(linked, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(at), b.take(at)], names=["a", "b"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(k, root) of every node of ``edges`` (a, b); a component's root is one of its nodes.

    Each round hooks every node onto its smallest neighbour.  That makes trees whose roots are pairs that chose each other, of
    which the smaller is the root; pointers jump until all show their root, and links between the trees are the next round's.
    Each tree has two nodes at least, so rounds are at most the logarithm of the nodes, and jumps that of a tree's depth.
    """
    one_way = edges.where("a <> b").select("a", "b")
    live = materialize(one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = None
    while labels is None or live.limit(1).count():
        trees, before = hooked(live), labels
        labels = trees if before is None else materialize(jumped(before, trees).select("k", "root"), "labels")
        from_root, to_root = (trees.select(F.col("k").alias(c), F.col("root").alias(f"{c}_root")) for c in "ab")
        between = live.join(from_root, "a").join(to_root, "b").where("a_root <> b_root")
        between = materialize(between.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), "links")
        if before is not None:
            release(before, trees)
        release(live)
        live = between
    release(live)
    return labels


def hooked(links: DataFrame) -> DataFrame:
    """(k, root) of the trees that the nodes of ``links`` (a, b in both directions) make with their smallest neighbours."""
    least = materialize(links.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("up")), "hooks")
    above = least.select(F.col("k").alias("at"), F.col("up").alias("next"))
    first = F.when(F.col("next") == F.col("k"), F.least("k", "up")).otherwise(F.least("up", "next"))
    trees = materialize(least.join(above, F.col("up") == F.col("at")).select("k", first.alias("root")), "trees")
    release(least)
    while True:
        found = materialize(jumped(trees, trees), "trees")
        release(trees)
        if found.where("root <> was").limit(1).count() == 0:
            return kept(found.select("k", "root"), found)
        trees = kept(found.select("k", "root"), found)


def kept(view: DataFrame, table: DataFrame) -> DataFrame:
    """``view``, to be released in the place of the table that it reads."""
    view._written_to = table.__dict__.pop("_written_to")
    return view


def jumped(labels: DataFrame, trees: DataFrame) -> DataFrame:
    """(k, was, root): the root of each label's root, which stays where ``trees`` has none."""
    above = trees.select(F.col("k").alias("at"), F.col("root").alias("up"))
    named = labels.select("k", F.col("root").alias("was"))
    return named.join(above, F.col("was") == F.col("at"), "left").select("k", "was", F.coalesce("up", "was").alias("root"))


def link_classes(docs: DataFrame, percent: int = 80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signed rows, classes with k and rep, confirmed links a-b between classes)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(source.mapInArrow(sign, SIGNED), "signed")
    some = signed.where("n_shingles > 0")
    classes = some.groupBy("k", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = materialize(classes, "classes")
    member = classes.select("k", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    centre = F.min(F.struct(F.xxhash64("k", "band").alias("h"), "k", "n"))
    buckets = member.groupBy("band").agg(F.count(F.lit(1)).alias("held"), centre.alias("centre")).where("held > 1")
    members = materialize(member.join(buckets, "band").select("band", "k", "n", "held", F.col("centre.k").alias("centre"), F.col("centre.n").alias("centre_n")), "members")
    # Small buckets: all pairs of at most SMALL classes.
    listed = members.where(F.col("held") <= SMALL).groupBy("band").agg(F.array_sort(F.collect_list(F.struct("k", "n"))).alias("all"))
    small = listed.select(F.explode("all").alias("x"), "all").select("x", F.explode("all").alias("y")).where("x.k < y.k")
    small = small.select(F.col("x.k").alias("a"), F.col("x.n").alias("an"), F.col("y.k").alias("b"), F.col("y.n").alias("bn"))
    large = members.where((F.col("held") > SMALL) & (F.col("k") != F.col("centre")))
    first_is_k = F.col("k") < F.col("centre")
    large = large.select(
        F.when(first_is_k, F.col("k")).otherwise(F.col("centre")).alias("a"), F.when(first_is_k, F.col("n")).otherwise(F.col("centre_n")).alias("an"),
        F.when(first_is_k, F.col("centre")).otherwise(F.col("k")).alias("b"), F.when(first_is_k, F.col("centre_n")).otherwise(F.col("n")).alias("bn"),
    )
    tried = materialize(sized(small.unionByName(large), percent).distinct(), "tried")
    reps = classes.select("k", "rep")
    linked = confirmed(tried, reps, source, percent)
    release(tried)
    linked = across(members, linked, reps, source, percent)
    release(members)
    return signed, reps, linked


def sized(pairs: DataFrame, percent: int) -> DataFrame:
    """Sets of too different sizes can't be similar enough."""
    return pairs.where(100 * F.least("an", "bn") >= percent * F.greatest("an", "bn")).select("a", "b")


def across(members: DataFrame, linked: DataFrame, reps: DataFrame, source: DataFrame, percent: int) -> DataFrame:
    """``linked`` and the links inside large buckets that their centres did not show.

    A group holds the classes of the large buckets that have one centre.  With D the symmetric difference of a set and the
    centre's, and W = (100 + percent) |D| - (100 - percent) |set|, two sets are similar enough just if
    |D ∩ D'| >= (W + W') / 2 / (100 + percent).  So whatever can be linked without a common element of D is linked to the
    group's set of least W, and those that this leaves in other components need many common elements: their rarest elements of D,
    as many as must hold the first of them, are matched.  What edits each copy alone has is never paired.
    """
    large = members.where(F.col("held") > SMALL).select("band", "k", "n")
    centres = large.groupBy("band").agg(F.min(F.struct(F.xxhash64("k").alias("h"), "k"))["k"].alias("centre"))
    groups = materialize(large.join(centres, "band").select("centre", "k", "n").distinct(), "groups")
    if groups.limit(1).count() == 0:
        return linked
    labelled = with_roots(groups, linked)
    open_groups = labelled.groupBy("centre").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("centre")
    labelled = materialize(labelled.join(open_groups, "centre", "left_semi"), "open")
    sets = sets_of(labelled.select("k").union(labelled.select("centre")).distinct(), reps, source)
    own = labelled.select("centre", "k", "n").join(sets.withColumnRenamed("shingles", "own"), "k")
    both = own.join(sets.select(F.col("k").alias("centre"), F.col("shingles").alias("middle")), "centre").select("centre", "k", "n", "own", "middle")
    weight = (100 + percent) * F.size("tokens") - (100 - percent) * F.col("n")
    diffs = materialize(both.mapInArrow(differences, "centre binary, k binary, n long, tokens array<long>").withColumn("w", weight.cast("long")), "differences")
    release(sets, labelled)
    low = materialize(diffs.groupBy("centre").agg(F.min(F.struct("w", "k", "n")).alias("low")), "lowest")
    star = diffs.join(low, "centre").where(F.col("k") != F.col("low.k")).select(F.col("k").alias("x"), F.col("n").alias("xn"), F.col("low.k").alias("y"), F.col("low.n").alias("yn"))
    stars = confirmed(ordered(star, percent), reps, source, percent)
    linked = materialize(linked.unionByName(stars), "linked")
    release(stars)
    # Whose component is not that of the set of least W is minor; only pairs with a minor are open.
    rooted = with_roots(diffs, linked)
    main = rooted.join(low, "centre").where(F.col("k") == F.col("low.k")).select("centre", F.col("root").alias("main"), F.col("low.w").alias("low_w"))
    rooted = rooted.join(main, "centre").withColumn("minor", F.col("root") != F.col("main"))
    minors = rooted.where("minor").groupBy("centre").agg(F.min("w").alias("minor_w"))
    rooted = rooted.join(minors, "centre")
    unit = 2 * (100 + percent)
    first = lambda other: F.size("tokens") - F.greatest(F.lit(1), F.ceil((F.col("w") + F.col(other)) / F.lit(float(unit)))) + 1
    # Of a minor, against any other and against another minor; of the rest, against a minor.
    rooted = rooted.withColumn("narrow", first("minor_w")).withColumn("keep", F.when(F.col("minor"), first("low_w")).otherwise(F.col("narrow"))).where("keep > 0")
    size = F.size("tokens").cast("long").alias("d")
    tokens = materialize(rooted.select("centre", "k", "n", "w", size, "root", "minor", "narrow", "keep", F.explode("tokens").alias("token")), "tokens")
    held = tokens.groupBy("centre", "token").agg(F.count(F.lit(1)).alias("df"))
    rare = F.row_number().over(Window.partitionBy("centre", "k").orderBy("df", "token"))
    prefix = tokens.join(held, ["centre", "token"]).withColumn("place", rare).where("place <= keep and df > 1")
    # What is left of d from a place on bounds what two sets have in common, if it is their first.
    prefix = prefix.select("centre", "token", "k", "n", "root", "minor", (F.col("place") <= F.col("narrow")).alias("narrow"), "w", (unit * (F.col("d") - F.col("place") + 1)).alias("room"))
    prefix = materialize(prefix, "prefix")
    named = lambda c: [F.col("k").alias(c), *[F.col(x).alias(c + x[0]) for x in ("n", "root", "w")], F.col("room").alias(c + "room")]
    x = prefix.where("minor").select("centre", "token", F.col("narrow").alias("x_narrow"), *named("x"))
    y = prefix.where("narrow").select("centre", "token", "minor", *named("y"))
    fits = (F.col("xw") + F.col("yw") <= F.col("xroom")) & (F.col("xw") + F.col("yw") <= F.col("yroom"))
    pairs = x.join(y, ["centre", "token"]).where((F.col("xr") != F.col("yr")) & (~F.col("minor") | (F.col("x_narrow") & (F.col("x") < F.col("y")))) & fits)
    pairs = ordered(pairs, percent)
    release(groups, diffs, low, tokens, prefix)
    rest = confirmed(pairs, reps, source, percent)
    release(pairs)
    return linked.unionByName(rest)


def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(centre, k, n, set of k, set of the centre) to the elements of one set alone; those of the centre are marked."""
    with np.errstate(over="ignore"):
        for batch in batches:
            rows = []
            for own, middle in zip(batch.column(3), batch.column(4), strict=True):
                a, b = np.frombuffer(own.as_buffer(), np.uint64), np.frombuffer(middle.as_buffer(), np.uint64)
                rows.append(np.concatenate([np.setdiff1d(a, b, assume_unique=True), mix(np.setdiff1d(b, a, assume_unique=True) + STEP)]))
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            flat = pa.array(np.concatenate(rows).view(np.int64) if rows else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(pa.array(offsets), flat)], names=["centre", "k", "n", "tokens"])


def with_roots(rows: DataFrame, linked: DataFrame) -> DataFrame:
    return rows.join(components(linked), "k", "left").withColumn("root", F.coalesce("root", "k"))


def ordered(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) with a < b from (x, xn, y, yn), where sizes allow a link."""
    first_is_x = F.col("x") < F.col("y")
    pairs = pairs.select(F.when(first_is_x, F.col("x")).otherwise(F.col("y")).alias("a"), F.col("xn").alias("an"), F.when(first_is_x, F.col("y")).otherwise(F.col("x")).alias("b"), F.col("yn").alias("bn"))
    return materialize(sized(pairs, percent).distinct(), "pairs")


def sets_of(nodes: DataFrame, reps: DataFrame, source: DataFrame) -> DataFrame:
    """(k, shingles): the full sets of classes ``nodes`` (k), read again from a text of each."""
    wanted = nodes.join(reps, "k").select("k", F.col("rep").alias("doc_id"))
    texts = source.join(wanted, source.doc_id.eqNullSafe(wanted.doc_id)).select("k", "text")
    return materialize(texts.mapInArrow(full_sets, "k binary, shingles binary").dropDuplicates(["k"]), "sets")


def confirmed(pairs: DataFrame, reps: DataFrame, source: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that are similar enough on their full sets."""
    sets = sets_of(pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b").alias("k"))).distinct(), reps, source)
    left = sets.select(F.col("k").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("k").alias("b"), F.col("shingles").alias("right"))
    found = materialize(pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(confirm(percent), "a binary, b binary"), "confirmed")
    release(sets)
    return found


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text)."""
    with arrow_batches(docs.sparkSession, BATCH_BYTES):  # pairs carry two sets each
        signed, reps, linked = link_classes(docs, percent)
    roots = components(linked)
    rooted = reps.join(roots, "k", "left").select("k", "rep", F.coalesce("root", "k").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = rooted.join(least, "root").select("k", "component_id")
    out = signed.select("doc_id", "n_shingles", "k").join(of_class, "k", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, less all but one of each component: that of the smallest doc_id stays."""
    row = fresh("row", docs.columns)
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "docs")
    with scratch() as tables:
        found = near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), percent).select(F.col("doc_id").alias("row"), "component_id")
    named = found.join(rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id")), "row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row"))["row"].alias(row))
    first = materialize(first.select(row), "first")
    release(*tables)
    return rows.join(first, row, "left_semi").select(*quoted(docs))
