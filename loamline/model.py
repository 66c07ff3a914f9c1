"""The entity model: fragments, merged entities, ids and schemata.

A fragment is what one step knows of an entity; an entity is the union of its fragments.  Property values are strings,
any number of them.  Ids are sha1 over the parts that are not null, joined by a unit separator.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FRAGMENT = "entity_id string, fragment string, schema string, props map<string,array<string>>"
SEPARATOR = "\x1f"

#: A schema and those it extends.
PARENTS = {
    "Document": ("Analyzable",), "Folder": ("Document",), "Package": ("Folder",), "Workbook": ("Folder",), "PlainText": ("Document",), "HyperText": ("Document",), "Pages": ("Document",),
    "Page": ("Analyzable",), "Table": ("Document",), "Email": ("PlainText", "HyperText", "Folder"), "Image": ("Document",), "Audio": ("Document",), "Video": ("Document",),
    "Person": (), "Organization": (), "Event": ("Analyzable",), "Mention": (), "Analyzable": (),
}


def make_id(*parts: object) -> str | None:
    """Id of the parts, null if all are null."""
    known = [str(p) for p in parts if p is not None]
    return hashlib.sha1(SEPARATOR.join(known).encode("utf-8", "surrogatepass")).hexdigest() if known else None


def entity_id(*parts: Column) -> Column:
    """:func:`make_id` of columns."""
    joined = F.concat_ws(SEPARATOR, *[p.cast("string") for p in parts])
    return F.when(F.coalesce(*[p.cast("string") for p in parts]).isNotNull(), F.sha1(joined.cast("binary")))


def ancestors_of(schema: str) -> set[str]:
    out = {schema}
    for p in PARENTS.get(schema, ()):
        out |= ancestors_of(p)
    return out


def is_a(schema: Column, ancestor: str) -> Column:
    """Whether a schema is ``ancestor`` or extends it."""
    return schema.isin([s for s in PARENTS if ancestor in ancestors_of(s)])


def long_form(fragments: DataFrame) -> DataFrame:
    """(entity_id, fragment, schema, prop, value) from fragments."""
    props = fragments.select("entity_id", "fragment", "schema", F.explode("props").alias("prop", "values"))
    return props.select("entity_id", "fragment", "schema", "prop", F.explode("values").alias("value"))


def latest(fragments: DataFrame, by: str) -> DataFrame:
    """The last write of each (entity, fragment), by the column ``by``."""
    rest = [c for c in fragments.columns if c not in ("entity_id", "fragment")]
    newest = fragments.groupBy("entity_id", "fragment").agg(F.max_by(F.struct(*rest), by).alias("row"))
    return newest.select("entity_id", "fragment", "row.*")


def merge_values(long: DataFrame) -> DataFrame:
    """(entity_id, prop, values) with each property's distinct values, sorted."""
    return long.groupBy("entity_id", "prop").agg(F.array_sort(F.collect_set("value")).alias("values"))


def merge(fragments: DataFrame) -> DataFrame:
    """One row for each entity: entity_id, schema, props.

    The schema is the most specific that a fragment names; ties go by name.
    """
    depth = F.element_at(F.create_map(*[x for s in PARENTS for x in (F.lit(s), F.lit(len(ancestors_of(s))))]), F.col("schema"))
    one = fragments.groupBy("entity_id").agg(F.max(F.struct(F.coalesce(depth, F.lit(0)), "schema"))["schema"].alias("schema"), F.count(F.lit(1)).alias("n"), F.first("props").alias("props"))
    # Most entities have one fragment; only the values of the others are dealt out and collected.
    several = fragments.join(fragments.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("entity_id"), "entity_id", "left_semi")
    values = merge_values(long_form(several)).groupBy("entity_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("prop", "values")))).alias("merged"))
    own = F.map_filter(F.transform_values("props", lambda _, vs: F.array_sort(F.array_distinct(F.filter(vs, lambda v: v.isNotNull())))), lambda _, vs: F.size(vs) > 0)
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))
    props = F.coalesce(F.when(F.col("n") == 1, own).otherwise(F.col("merged")), empty)
    return one.join(values, "entity_id", "left").select("entity_id", "schema", props.alias("props"))
