"""Fragments in, tagged entities and mentions out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.functions import language
from loamline.functions import text as T
from loamline.model import is_a, long_form
from loamline.operators import relational as R
from loamline.storage import materialize

TEXT_PROPS = ("bodyText", "indexText", "description", "summary")
MENTIONED = {"companiesMentioned": "Organization", "peopleMentioned": "Person"}


@dataclass(frozen=True)
class Analyzed:
    #: (entity_id, schema, prop, value) of the entities that got any tag.
    tags: DataFrame
    #: (id, document, resolved, names, detectedSchema, contextCountry)
    mentions: DataFrame


def analyzable(fragments: DataFrame) -> DataFrame:
    """Fragments of what can be analysed: tables are not."""
    return fragments.where(is_a(F.col("schema"), "Analyzable") & (F.col("schema") != "Table"))


def text_chunks(fragments: DataFrame) -> DataFrame:
    """(entity_id, pos, chunk) of the texts of fragments, each text of an entity once.

    ``pos`` orders the chunks of an entity: by fragment (shorter names first, so that numbers are in order), property, text, and place in it.
    """
    order = F.struct(F.length("fragment").alias("n"), "fragment", "prop", F.xxhash64("value").alias("text"))
    texts = long_form(fragments).where(F.col("prop").isin(*TEXT_PROPS)).groupBy("entity_id", F.col("value").alias("text")).agg(F.min(order).alias("at"))
    pieces = texts.select("entity_id", "at", F.posexplode(T.chunks(F.col("text"))).alias("k", "chunk"))
    return pieces.select("entity_id", F.struct("at", "k").alias("pos"), "chunk")


def analyze(fragments: DataFrame, profiles: dict[str, dict[str, float]] | None = None, names: Callable[[DataFrame], DataFrame] | None = None, keep_language_only: bool = False) -> Analyzed:
    """Tags fragments (entity_id, fragment, schema, props).

    ``profiles`` detect languages; ``names`` gives (entity_id, prop, value, label, confidence) from chunks, for people and companies.
    An entity of which only the language is known gets a row just with ``keep_language_only``.
    """
    chunks = text_chunks(analyzable(fragments))
    if names is not None or profiles is not None:
        chunks = materialize(chunks, "chunks")  # read more than once
    schemas = analyzable(fragments).groupBy("entity_id").agg(F.max("schema").alias("schema"))
    tags = R.pattern_tags(chunks.select("entity_id", "pos", F.col("chunk").alias("text")))
    grouped = R.group_tags(tags)
    out = grouped.select("entity_id", "prop", F.col("label").alias("value"))
    country_sets = R.countries(tags)
    groups = fragments.sparkSession.createDataFrame([], "entity_id string, prop string, key string, values array<string>")
    if names is not None:
        groups = R.group_confident(names(chunks))
        out = out.unionByName(groups.select("entity_id", "prop", R.pick_name(F.col("values")).alias("value")))
    if profiles is not None:
        spoken = language.first_confident(language.detect_chunks(chunks, profiles)).select("entity_id", F.lit("detectedLanguage").alias("prop"), F.col("language").alias("value"))
        out = out.unionByName(spoken if keep_language_only else spoken.join(out.select("entity_id").distinct(), "entity_id", "left_semi"))
    return Analyzed(out.join(schemas, "entity_id"), R.mentions(groups, schemas, country_sets, MENTIONED))


def returned_ids(analyzed: Analyzed, workset: DataFrame) -> DataFrame:
    """The ids that the stage hands on: those it was given, and the mentions'.

    Mentions are made distinct first, as that spares the join of their countries, and with it the search for patterns.
    """
    mentioned = analyzed.mentions.select(F.col("id").alias("entity_id")).distinct()
    return workset.select("entity_id").unionByName(mentioned).distinct()
