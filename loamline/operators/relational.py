"""The relational operators: routing, tags, mentions, threads, trees, caches, metrics and tables."""

from __future__ import annotations

import functools
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamline.functions import text as T
from loamline.model import entity_id, is_a
from loamline.registry import EXTRACTORS, FAMILY_BIDS
from loamline.registry import offers as offers_by
from loamline.storage import materialize

#: At most one more than this many tag keys are taken of an entity.
MAX_TAGS = 10_000
#: Tag values below this confidence reject their whole group.
MIN_CONFIDENCE = 0.85
# Upper bounds of the histogram of extraction times, in seconds.
DURATION_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 5, 15, 60, 300, 900)


def auction(files: DataFrame, sniffed: str | None = None) -> DataFrame:
    """Adds ``extractor`` and ``score`` to files (file_name, mime): the highest bid, and of equal ones the first registered.

    A media type that an extractor knows decides over its extensions; with ``sniffed``, the name of a column of media types by
    content, a file that names no type of its own is taken for that.  Files of no bytes are ignored (column file_size, if there).
    The registry has a few hundred rows and is broadcast for that fixed bound.
    """
    spark = files.sparkSession
    mime = F.lower(F.trim(F.substring_index(F.coalesce("mime", sniffed) if sniffed else F.col("mime"), ";", 1)))
    rows = files.withColumn("mime_", mime).withColumn("ext_", T.path_extension(F.col("file_name")))
    rows = rows.join(F.broadcast(offers_by(spark, "mime").select(F.col("key").alias("mime_"), F.col("offers").alias("by_mime"))), "mime_", "left")
    rows = rows.join(F.broadcast(offers_by(spark, "ext").select(F.col("key").alias("ext_"), F.col("offers").alias("by_ext"))), "ext_", "left")
    none = F.array().cast("array<struct<extractor:string,score:int,ordinal:int>>")
    order = {e.name: k for k, e in enumerate(EXTRACTORS)}
    offers = F.concat(F.coalesce("by_mime", none), F.coalesce("by_ext", none))
    for name, family, score in FAMILY_BIDS:
        one = F.array(F.struct(F.lit(name).alias("extractor"), F.lit(score).alias("score"), F.lit(order[name]).alias("ordinal")))
        # Only where the extractor has no regular bid.
        offers = F.concat(offers, F.when(F.coalesce(F.col("mime_").startswith(family), F.lit(False)) & ~F.exists(offers, functools.partial(_is, name)), one).otherwise(none))
    if "file_size" in files.columns:
        empty = F.array(F.struct(F.lit("ignore").alias("extractor"), F.lit(200).alias("score"), F.lit(0).alias("ordinal")))
        offers = F.concat(offers, F.when(F.col("file_size") == 0, empty).otherwise(none))
    top = F.array_max(F.transform(offers, lambda x: F.struct(x["score"].alias("score"), (-x["ordinal"]).alias("rank"), x["extractor"].alias("extractor"))))
    return rows.withColumn("top_", top).select(*[F.col(c) for c in files.columns], F.col("top_.extractor").alias("extractor"), F.col("top_.score").alias("score"))


def _is(name: str, x: Column) -> Column:
    return x["extractor"] == name


def pattern_tags(texts: DataFrame) -> DataFrame:
    """(entity_id, pos, prop, value): cleaned e-mail addresses, phone numbers and IBANs of (entity_id, text), and the countries they hint at.

    ``pos`` orders the tags of an entity; if texts have a ``pos``, as the chunks of an entity do, by that first.
    """
    chunked = "pos" in texts.columns
    found = texts.select(
        "entity_id", *([F.col("pos").alias("of")] if chunked else []),
        F.explode(F.concat(*[
            F.transform(T.matches(F.col("text"), p), functools.partial(_tag, prop, k))
            for k, (prop, p) in enumerate((("emailMentioned", T.EMAIL), ("phoneMentioned", T.PHONE), ("ibanMentioned", T.IBAN)))
        ])).alias("tag"),
    ).select("entity_id", *(["of"] if chunked else []), "tag.*")
    place = lambda at: F.struct("of", at.alias("at")) if chunked else at
    value = F.when(F.col("prop") == "emailMentioned", T.clean_email(F.col("match"))).when(F.col("prop") == "phoneMentioned", T.clean_phone(F.col("match"))).otherwise(T.clean_iban(F.col("match")))
    clean = found.withColumn("value", value).where("value is not null")
    country = F.when(F.col("prop") == "phoneMentioned", T.phone_country(F.col("value"))).when(F.col("prop") == "ibanMentioned", T.iban_country(F.col("value")))
    both = F.array(F.struct(F.col("prop").alias("prop"), F.col("value").alias("value"), place(F.col("at") * 2).alias("pos")), F.struct(F.lit("detectedCountry").alias("prop"), country.alias("value"), place(F.col("at") * 2 + 1).alias("pos")))
    return clean.select("entity_id", F.explode(both).alias("t")).select("entity_id", "t.pos", "t.prop", "t.value").where("value is not null")


def _tag(prop: str, kind: int, match: Column, i: Column) -> Column:
    return F.struct(F.lit(prop).alias("prop"), match.alias("match"), (F.lit(kind).cast("long") * (1 << 40) + i).alias("at"))


def node_key(value: Column) -> Column:
    """What makes two values of a property one node."""
    return F.lower(T.collapse(value))


def group_tags(tags: DataFrame, cap: int = MAX_TAGS) -> DataFrame:
    """(entity_id, prop, key, label, n, first_pos) of tags (entity_id, pos, prop, value).

    Of an entity's keys, over all properties, the first ``cap`` + 1 by position are taken.  The label is the first value.
    """
    keyed = tags.withColumn("key", node_key(F.col("value"))).where("key is not null")
    grouped = keyed.groupBy("entity_id", "prop", "key").agg(F.min_by("value", F.struct("pos", "value")).alias("label"), F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))
    place = F.row_number().over(Window.partitionBy("entity_id").orderBy("first_pos", "prop", "key"))
    return grouped.withColumn("place", place).where(F.col("place") <= cap + 1).drop("place")


def group_confident(tags: DataFrame, least: float = MIN_CONFIDENCE) -> DataFrame:
    """(entity_id, prop, key, values) of tags (entity_id, prop, value, label, confidence).

    A group with one value that is labelled ``trash``, or less confident than ``least``, is dropped whole.
    """
    sound = (F.col("label") != "trash") & (F.col("confidence") >= least)
    keyed = tags.withColumn("key", node_key(F.col("value"))).where("key is not null")
    out = keyed.groupBy("entity_id", "prop", "key").agg(F.array_sort(F.collect_set("value")).alias("values"), F.every(F.coalesce(sound, F.lit(False))).alias("sound"))
    return out.where("sound").drop("sound")


def type_confidence(counts: DataFrame, kinds: int) -> DataFrame:
    """(key, label, confidence) of (key, label, weight): the likeliest label, and 1 less the entropy over that of ``kinds`` equal ones."""
    total = F.sum("weight").over(Window.partitionBy("key"))
    share = counts.withColumn("p", F.col("weight") / total)
    entropy = -F.sum(F.when(F.col("p") > 0, F.col("p") * F.log("p")).otherwise(F.lit(0.0)))
    best = F.max_by("label", F.struct(F.col("weight"), F.col("label")))
    return share.groupBy("key").agg(best.alias("label"), (1 - entropy / F.log(F.lit(float(kinds)))).alias("confidence"))


def countries(tags: DataFrame) -> DataFrame:
    """(entity_id, countries) with the distinct countries of each entity's tags, sorted."""
    return tags.where("prop = 'detectedCountry'").groupBy("entity_id").agg(F.array_sort(F.collect_set("value")).alias("countries"))


def mentions(groups: DataFrame, entity_schemas: DataFrame, country_sets: DataFrame, schemas: dict[str, str]) -> DataFrame:
    """(id, document, resolved, names, detectedSchema, contextCountry): a mention for each group of a mentioned property, on documents.

    ``groups`` (entity_id, prop, key, values), ``entity_schemas`` (entity_id, schema), ``country_sets`` of :func:`countries`;
    ``schemas``: the schema that each mentioned property stands for.
    """
    named = F.create_map(*[F.lit(x) for pair in schemas.items() for x in pair])
    on_docs = groups.where(F.col("prop").isin(list(schemas))).join(entity_schemas.where(is_a(F.col("schema"), "Document")), "entity_id")
    return on_docs.join(country_sets, "entity_id", "left").select(
        entity_id(F.lit("mention"), F.col("entity_id"), F.col("prop"), F.col("key")).alias("id"), F.col("entity_id").alias("document"), entity_id(F.col("key")).alias("resolved"),
        F.col("values").alias("names"), F.element_at(named, F.col("prop")).alias("detectedSchema"), F.coalesce("countries", F.array().cast("array<string>")).alias("contextCountry"),
    )


def place_countries(places: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(entity_id, country) of places (entity_id, value) that ``gazetteer`` (name, country) knows, whatever their case and white space."""
    known = gazetteer.select(node_key(F.col("name")).alias("key"), "country").where("key is not null").distinct()
    return places.withColumn("key", node_key(F.col("value"))).join(known, "key").select("entity_id", "country").distinct()


def pick_name(values: Column) -> Column:
    """The longest of an array of names, and of those the first by code point."""
    return F.array_min(F.transform(values, lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v"))))["v"]


def thread_links(messages: DataFrame) -> DataFrame:
    """(collection, entity_id, reply_to): messages (collection, entity_id, message_id, in_reply_to) joined to those that they reply to.

    A message does not reply to itself.  Repeated ids link to each of their messages once.
    """
    asked = messages.where("in_reply_to is not null").select("collection", "entity_id", F.col("in_reply_to").alias("message_id"))
    named = messages.where("message_id is not null").select("collection", F.col("entity_id").alias("reply_to"), "message_id")
    return asked.join(named, ["collection", "message_id"]).where("entity_id <> reply_to").select("collection", "entity_id", "reply_to").distinct()


def ancestors(nodes: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(id, ancestor, distance) of nodes (id, parent): each node with all above it.

    One equi-join for each level, written once; a node above itself is an error, and if given a path longer than ``max_depth``.
    """
    step = materialize(nodes.where("parent is not null").select("id", F.col("parent").alias("ancestor")).distinct(), "level")
    out, frontier = step.withColumn("distance", F.lit(1)), step
    up = step.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("above"))
    distance = 2
    while not frontier.isEmpty():
        if distance - 1 == max_depth or not frontier.where("id = ancestor").isEmpty():
            raise ValueError("deeper than max_depth, or a cycle")
        frontier = materialize(frontier.join(up, "ancestor").select("id", F.col("above").alias("ancestor")), "level")
        out = out.unionByName(frontier.withColumn("distance", F.lit(distance)))
        distance += 1
    return out


def folder_closure(paths: DataFrame, excluded: tuple[str, ...] = ()) -> DataFrame:
    """(folder, parent, name): the folders above each path, once each.

    Excluded names get no folder, but are part of the paths of those below; the parent is the nearest folder above.
    """
    names = F.split("path", "/")
    kept = lambda n: ~n.isin(list(excluded)) if excluded else F.lit(True)
    rows = paths.select(names.alias("names")).where(F.size("names") > 1)
    rows = rows.select("names", F.explode(F.sequence(F.lit(1), F.size("names") - 1)).alias("n")).where(kept(F.get(F.col("names"), F.col("n") - 1)))
    above = F.filter(F.sequence(F.lit(1), F.col("n")), lambda k: (k < F.col("n")) & kept(F.get(F.col("names"), k - 1)))
    nearest = F.array_max(above)
    return rows.select(
        F.array_join(F.slice("names", 1, F.col("n")), "/").alias("folder"),
        F.when(nearest.isNotNull(), F.array_join(F.slice("names", 1, nearest), "/")).alias("parent"), F.get(F.col("names"), F.col("n") - 1).alias("name"),
    ).distinct()


def inherit(children: DataFrame, parents: DataFrame, columns: list[str]) -> DataFrame:
    """Children (parent_id, ...) with ``columns`` of their parents (id, ...)."""
    return children.join(parents.select(F.col("id").alias("parent_id"), *columns), "parent_id", "left")


def split_by_cache(rows: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their cached results, and the rows that are still to do."""
    return rows.join(cache, key), rows.join(cache.select(key), key, "left_anti")


def metrics(runs: DataFrame, bounds: tuple[float, ...] = DURATION_BOUNDS) -> DataFrame:
    """(extractor, succeeded, failed, bytes, le_... counts) of runs (extractor, status, file_size, seconds).

    Runs that ended before an extractor was chosen count under ``none``.
    """
    ok = F.col("status") == "success"
    buckets = [F.count_if(F.col("seconds") <= b).alias("le_" + str(b).replace(".", "_")) for b in bounds]
    return runs.groupBy(F.coalesce("extractor", F.lit("none")).alias("extractor")).agg(
        F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"), F.coalesce(F.sum("file_size"), F.lit(0)).cast("long").alias("bytes"), *buckets
    )


def positional_headers(width: int) -> list[str]:
    return [f"Column {k}" for k in range(1, width + 1)]


def table_rows(df: DataFrame) -> DataFrame:
    """The rows of a table as text under positional headers; rows without any text are dropped."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    rows = df.select(*[c.alias(h) for c, h in zip(cells, positional_headers(len(cells)), strict=True)])
    return rows.where(F.length(F.concat(*[F.col(f"`{h}`") for h in rows.columns])) > 0)


def table_metadata(df: DataFrame, title: str) -> DataFrame:
    """(title, columns, rowCount, digest) of a table.  rowCount is one more than its rows.

    ``digest`` sums the first 60 bits of each row's sha1, so it needs no order and no task that sees all rows.
    """
    rows = table_rows(df)
    line = F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(F.col(f"`{c}`"), F.lit('"'), F.lit('""')), F.lit('"')) for c in rows.columns])
    bits = F.conv(F.substring(F.sha1(line.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    out = rows.agg((F.count(F.lit(1)) + 1).alias("rowCount"), F.coalesce(F.sum(bits), F.lit(0)).cast("string").alias("digest"))
    return out.select(F.lit(title).alias("title"), F.lit(json.dumps(rows.columns)).alias("columns"), "rowCount", "digest")


def row_fragments(df: DataFrame, key: list[str]) -> DataFrame:
    """(key..., texts): the texts of each row that are worth indexing; rows without any are left out."""
    cells = F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    return df.select(*key, T.filter_texts(cells).alias("texts")).where(F.size("texts") > 0)
