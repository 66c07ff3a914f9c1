"""Language detection by profiles of character trigrams."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A chunk decides on an entity's language if its score is above this.
THRESHOLD = 0.6
GRAM = 3
#: Trigrams, of 8 bytes each, that a task holds before it counts them.
PIECE = 1 << 20
#: Logarithm of the share of a trigram that a profile lacks.
FLOOR = math.log(1e-6)
# Languages with a model of names, by three-letter code.
NAMED_LANGUAGES = ("eng", "deu", "fra", "spa", "rus", "por", "ron", "mkd", "ell", "pol", "ita", "lit", "nld", "nob", "nor", "dan")
ALPHA3 = {"en": "eng", "de": "deu", "fr": "fra", "es": "spa", "ru": "rus", "pt": "por", "ro": "ron", "mk": "mkd", "el": "ell", "pl": "pol", "it": "ita", "lt": "lit", "nl": "nld", "nb": "nob", "no": "nor", "da": "dan"}


def codes(text: str) -> np.ndarray:
    """Each trigram of the lower-cased text, white space as one blank, as one number: 21 bits a character."""
    flat = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return (flat[:-2] << 42) | (flat[1:-1] << 21) | flat[2:] if len(flat) >= GRAM else np.zeros(0, np.int64)


def gram_of(code: int) -> str:
    return "".join(chr(code >> shift & 0x1FFFFF) for shift in (42, 21, 0))


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n) of (text, lang), counted whenever some ``PIECE`` trigrams are held, however many rows a batch has."""
    for batch in batches:
        seen, held = {}, 0
        for text, lang in zip(batch.column(0), batch.column(1), strict=True):
            own = codes(text.as_py())
            seen.setdefault(lang.as_py(), []).append(own)
            held += len(own)
            if held >= PIECE:
                yield from counted(seen)
                seen, held = {}, 0
        yield from counted(seen)


def counted(seen: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for lang, own in seen.items():
        found, n = np.unique(np.concatenate(own), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(n)], names=["lang", "code", "n"])


def profiles(labelled: DataFrame, most: int = 2000) -> dict[str, dict[str, float]]:
    """The ``most`` frequent trigrams of each language of (text, lang), with the logarithm of their share.

    Every task counts its own rows and adds up what it counted, so one row for each trigram and task is shuffled; the result is bounded by ``most``.
    """

    rows = labelled.where("text is not null and lang is not null").select("text", "lang").mapInArrow(count_grams, "lang string, code long, n long")
    rows = rows.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top = rows.withColumn("share", F.col("n") / total).withColumn("place", place).where(F.col("place") <= most)
    out: dict[str, dict[str, float]] = {}
    for r in top.select("lang", "code", "share").collect():
        out.setdefault(r.lang, {})[gram_of(r.code)] = math.log(r.share)
    return out


class Detector:
    """Profiles as a table: a row for each trigram that any knows, a column for each language."""

    def __init__(self, known: dict[str, dict[str, float]]):
        self.langs = sorted(known)
        grams = sorted({g for p in known.values() for g in p if len(g) == GRAM}, key=lambda g: [ord(c) for c in g])
        self.keys = np.array([ord(g[0]) << 42 | ord(g[1]) << 21 | ord(g[2]) for g in grams], np.int64)
        self.table = np.array([[known[lang].get(g, FLOOR) for lang in self.langs] for g in grams]).reshape(len(grams), len(self.langs))

    def detect(self, text: str) -> tuple[str | None, float]:
        """The likeliest language and its share of belief; none for a text without trigrams."""
        own = codes(text)
        if not len(own) or not self.langs:
            return None, 0.0
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            hit = self.keys[at] == own
            fit = np.bincount(at[hit], minlength=len(self.keys)) @ self.table + FLOOR * (len(own) - int(hit.sum()))
        else:
            fit = np.zeros(len(self.langs))
        best = int(fit.argmax())
        return self.langs[best], float(1 / np.exp(np.maximum(fit - fit[best], -700.0)).sum())


def detect(text: str, known: dict[str, dict[str, float]]) -> tuple[str | None, float]:
    return Detector(known).detect(text)


def detect_chunks(chunks: DataFrame, known: dict[str, dict[str, float]]) -> DataFrame:
    """(entity_id, pos, language, score) of chunks (entity_id, pos, chunk)."""
    held = chunks.sparkSession.sparkContext.broadcast(Detector(known))

    kind = chunks.schema["pos"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [held.value.detect(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["entity_id", "pos", "language", "score"])

    return chunks.select("entity_id", "pos", "chunk").mapInArrow(run, f"entity_id string, pos {kind}, language string, score double")


def first_confident(detected: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(entity_id, language): that of an entity's first chunk whose score is above the threshold."""
    return detected.where(F.col("score") > threshold).groupBy("entity_id").agg(F.min_by("language", "pos").alias("language"))


def name_model(language: Column) -> Column:
    """The three-letter key of the model of names for a language; null if there is none."""
    codes = F.create_map(*[F.lit(x) for pair in ALPHA3.items() for x in pair])
    three = F.coalesce(F.try_element_at(codes, F.lower(language)), F.lower(language))
    return F.when(three.isin(list(NAMED_LANGUAGES)), three)
