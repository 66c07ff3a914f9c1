"""Licence scan with a positional rare-token index.

Templates are short runs of words that licences state.  The index holds, for each template, its words with their offsets;
a template's anchors are its words of highest IDF, where IDF counts all documents that are scanned.  A document's anchor places, less
their offsets, are the starts where the template may stand (postings intersected by relative position); at such a
start enough of the template's words must stand in place, and every mandatory key phrase must be there in full.  The rarest words are chosen
for each template, not for each file, so that a licence is found however rare the words of another one beside it are.

The base phrases are the index's mandatory phrases of all their words, so a base place needs no more than its own words.

Null text counts as empty.  Repeated rows are scanned each.  An empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import alnum_words, ascii_lower, materialize

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Template:
    """``words`` in place to ``share`` at least; ``keys``: (offset, phrase) that must stand there in full."""

    label: str
    words: str
    keys: tuple[tuple[int, str], ...]
    share: float = 0.8


TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ((3, "granted free of charge"),)),
    Template("apache-2", "licensed under the apache license version 2 0", ((3, "apache license version 2"),)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ((2, "cc by nc"),)),
    Template("gpl-3", "licensed under the gnu general public license version 3", ((3, "gnu general public license version 3"),)),
    Template("gpl-2", "licensed under the gnu general public license version 2", ((3, "gnu general public license version 2"),)),
    Template("lgpl", "licensed under the gnu lesser general public license", ((3, "gnu lesser general public license"),)),
    Template("agpl-3", "licensed under the gnu affero general public license", ((3, "gnu affero general public license"),)),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", ((6, "mozilla public license"),)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ((0, "redistribution and use"), (3, "source and binary forms"))),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ((2, "cc by sa"),)),
    Template("cc-by-nd", "licensed under cc by nd 4 0", ((2, "cc by nd"),)),
    Template("cc0", "this work is marked with cc0 1 0", ((5, "cc0"),), 0.7),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ((2, "free and unencumbered software"),)),
)

#: Titles, usual notices and identifiers, each of which must stand in full.  A licence names others in its own text (MPL-2 the GPL 2.0, LGPL
#: 2.1 and AGPL 3.0, GPL-3 the LGPL), so bare names without a date, a version or "under the terms of" are not among them.
NOTICES = tuple(
    Template(label, phrase, ((0, phrase),), 1.0)
    for label, phrases in {
        "mit": ("mit license", "spdx license identifier mit"),
        "apache-2": ("spdx license identifier apache 2 0",),
        "cc-by-nc": ("creative commons attribution noncommercial", "creative commons attribution non commercial"),
        "gpl-3": (
            "gnu general public license version 3", "gnu general public license v3", "under the terms of version 3 of the gnu general public license",
            "gnu general public license as published by the free software foundation either version 3 of the license",
            "gnu general public license as published by the free software foundation version 3 of the license", "spdx license identifier gpl 3 0",
        ),
        "gpl-2": (
            "gnu general public license version 2 june 1991", "gnu general public license v2", "terms of the gnu general public license version 2", "under the terms of version 2 of the gnu general public license",
            "gnu general public license as published by the free software foundation either version 2 of the license",
            "gnu general public license as published by the free software foundation version 2 of the license", "spdx license identifier gpl 2 0",
        ),
        "lgpl": (
            "gnu lesser general public license version 3 29 june 2007", "gnu lesser general public license version 2 1 february 1999", "gnu library general public license version 2 june 1991",
            "gnu lesser general public license v3", "gnu lesser general public license v2 1",
            "under the terms of the gnu lesser general public license", "under the terms of the gnu library general public license", "spdx license identifier lgpl",
        ),
        "agpl-3": ("gnu affero general public license version 3 19 november 2007", "gnu affero general public license v3", "under the terms of the gnu affero general public license", "spdx license identifier agpl 3 0"),
        "mpl-2": ("mozilla public license version 2 0", "spdx license identifier mpl 2 0"),
        "bsd": ("bsd 2 clause license", "bsd 3 clause license", "spdx license identifier bsd"),
        "cc-by-sa": ("creative commons attribution sharealike", "creative commons attribution share alike", "cc by sa"),
        "cc-by-nd": ("creative commons attribution noderivatives", "creative commons attribution noderivs", "creative commons attribution no derivatives", "cc by nd"),
        "cc0": ("cc0 1 0 universal", "waived all copyright and related or neighboring rights", "spdx license identifier cc0 1 0"),
        "unlicense": ("spdx license identifier unlicense",),
    }.items()
    for phrase in phrases
)
INDEX = (*TEMPLATES, *NOTICES)


def vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in t.words.split()})


def known_words(docs: DataFrame, words_in: list[str]) -> DataFrame:
    """doc_id, n_words and ``known``: the text's words in place, null where the index does not know them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), alnum_words(ascii_lower(F.col("text").cast("string"))).alias("words"))
    known = F.transform("words", lambda w: F.when(w.isin(words_in), w))
    return rows.select("doc_id", F.size("words").cast("long").alias("n_words"), known.alias("known"))


def anchors_of(known: DataFrame, templates: tuple[Template, ...], each: int = 2) -> list[list[tuple[int, str]]]:
    """For each template its (offset, word) of highest IDF within the mandatory phrases; ties by offset.

    One row for each word of the index's own vocabulary comes to the driver.
    """
    df = known.select(F.explode(F.array_compact(F.array_distinct("known"))).alias("w")).groupBy("w").count()
    seen = {r[0]: r[1] for r in df.collect()}
    mandatory = ([(at + j, w) for at, phrase in t.keys for j, w in enumerate(phrase.split())] for t in templates)
    return [sorted(words, key=lambda x: (seen.get(x[1], 0), x[0]))[:each] for words in mandatory]


def index_of(templates: tuple[Template, ...], anchors: list[list[tuple[int, str]]]) -> Column:
    """The index as one literal: for each template its label, words with offsets, need, anchors and key phrases."""
    placed = lambda words: F.array(*[F.struct(F.lit(at).alias("at"), F.lit(w).alias("w")) for at, w in words])
    return F.array(*[
        F.struct(
            F.lit(k).alias("k"), placed(enumerate(t.words.split())).alias("words"), F.lit(max(1, int(t.share * len(t.words.split()) + 0.999))).alias("need"), placed(own).alias("anchors"),
            placed((at + j, w) for at, phrase in t.keys for j, w in enumerate(phrase.split())).alias("keys"),
        )
        for k, (t, own) in enumerate(zip(templates, anchors, strict=True))
    ])


def in_place(known: Column, start: Column, words: Column) -> Column:
    """How many of ``words`` (at, w) stand at their offsets from ``start``: one look for each, however long the text."""
    return F.size(F.filter(words, lambda x: (start + x["at"] >= 0) & (F.get(known, start + x["at"]) == x["w"])))


def occurrences(rare: Column, known: Column, template: Column) -> Column:
    """(k, start, share) of a template: starts that all anchors agree on, whose key phrases are whole and whose words stand in place."""
    starts_of = lambda a: F.transform(F.filter(rare, lambda x: x["w"] == a["w"]), lambda x: x["p"] - a["at"])
    first, last = (F.element_at(template["anchors"], n) for n in (1, -1))
    whole = lambda s: in_place(known, s, template["keys"]) == F.size(template["keys"])
    counted = F.transform(F.filter(F.array_intersect(starts_of(first), starts_of(last)), whole), lambda s: F.struct(template["k"].alias("k"), s.alias("start"), in_place(known, s, template["words"]).alias("n")))
    enough = F.filter(counted, lambda x: x["n"] >= template["need"])
    return F.transform(enough, lambda x: F.struct(x["k"].alias("k"), x["start"].alias("start"), (x["n"] / F.size(template["words"])).alias("share")))


def scan(docs: DataFrame, templates: tuple[Template, ...] = INDEX, base: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``docs`` (doc_id, text).

    score: the largest share of a template's words in place, 1 where a base phrase stands, 0 without any label.
    """
    phrases = tuple(Template(label, phrase, ((0, phrase),), 1.0) for phrase, label in (BASE if base is None else base).items())
    index = (*phrases, *templates)
    known = materialize(known_words(docs, vocabulary(index)), "known")
    anchors = anchors_of(known, index)
    rare = sorted({w for own in anchors for _, w in own})
    hits = F.array_compact(F.transform("known", lambda w, i: F.when(w.isin(rare), F.struct(i.alias("p"), w.alias("w")))))
    looked_up = F.flatten(F.transform(index_of(index, anchors), lambda t: occurrences(F.col("rare"), F.col("known"), t)))
    none = F.array().cast("array<struct<k int, start int, share double>>")
    rows = known.withColumn("rare", hits).withColumn("found", F.when(F.size("rare") > 0, looked_up).otherwise(none))
    rows = rows.select("doc_id", "n_words", "found", F.transform(F.filter("found", lambda x: x["k"] < len(phrases)), lambda x: x["start"]).alias("every"))
    label_of = F.array(*[F.lit(t.label) for t in index])
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: F.get(label_of, x["k"])))), ",")
    return rows.select(
        "doc_id", "n_words", F.size("every").cast("long").alias("n_base"), F.array_min("every").cast("long").alias("first_word"), F.array_max("every").cast("long").alias("last_word"),
        labels(F.filter("found", lambda x: x["k"] < len(phrases))).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0)).alias("score"),
    )
