"""Language identification by prediction by partial matching.

For each language a variable-order tree of byte contexts is counted on labelled rows and frozen.  A byte's
probability comes from the longest context that has seen it; each shorter context costs an escape, whose
probability is that of method C (kinds over kinds plus occurrences), and the shorter context's probabilities are shared out among the
symbols that the longer one has not seen (exclusion).  The code length of a text under a language is the exact sum over its bytes; the
shortest code names the language.

With statistics frozen, a byte's code length depends on the ``order`` bytes before it alone.  So the nodes of a tree are sorted arrays, an order
each: the code length of each byte that a context has seen, and the cost of leaving the context.  Every distinct run of order + 1
bytes is looked up once by a worker.  All bytes of 128 and more are symbols of their own, so scripts beyond Latin keep
what tells them apart; ASCII letters are folded to lower case, and all other ASCII is one boundary symbol.

Null text, and text without a letter, is ``und`` with score 0.  The score is the posterior of the language under equal
priors.  Null langs are not learned from.  Repeated rows count as often as they occur.  No labelled rows at all: everything is
``und``.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import id_crc

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
#: Byte value to symbol: 0 boundary, 1 to 26 letters, 27 to 154 the bytes from 128 on.
SYMBOLS = bytes(c - 96 if 97 <= c <= 122 else c - 64 if 65 <= c <= 90 else c - 101 if c >= 128 else 0 for c in range(256))
ALPHABET = 155
#: Bytes that are looked up at once, and distinct runs that a worker keeps.
BLOCK, KEPT = 4 << 20, 1 << 20


def held_out(docs: DataFrame):
    return id_crc(docs["doc_id"]) % 3 == 1


def runs_of(texts: list[bytes | None], order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(codes, owners, starts): the run of ``order`` symbols before a byte and itself as one number, for blocks of all texts' bytes.

    ``owners`` are the texts of a block, ``starts`` where their codes begin.  Before a text stand boundaries; a long text is in
    several blocks.
    """
    pieces: list[bytes] = []
    owners: list[int] = []
    size = 0
    for k, text in enumerate(texts):
        symbols = (text or b"").translate(SYMBOLS)
        for at in range(0, len(symbols), BLOCK):
            piece = bytes(max(0, order - at)) + symbols[max(0, at - order) : at + BLOCK]
            if size and size + len(piece) > BLOCK:
                yield coded(pieces, owners, order)
                pieces, owners, size = [], [], 0
            pieces.append(piece)
            owners.append(k)
            size += len(piece)
    if pieces:
        yield coded(pieces, owners, order)


def coded(pieces: list[bytes], owners: list[int], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    symbols = np.frombuffer(b"".join(pieces), np.uint8)
    codes = np.zeros(len(symbols) - order, np.int64)
    for k in range(order + 1):
        codes <<= 8
        codes |= symbols[k : k + len(codes)]
    ends = np.cumsum([len(p) for p in pieces])
    starts = ends - [len(p) for p in pieces]
    kept = np.ones(len(codes), bool)  # not the runs that reach into the next piece
    for k in range(order):
        kept[ends[:-1] - order + k] = False
    return codes[kept], np.array(owners), starts - order * np.arange(len(pieces))


class Tree:
    """The frozen context tree of one language, from its runs and how often each occurs."""

    def __init__(self, runs: np.ndarray, counts: np.ndarray, order: int):
        self.order = order
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []  # by order: (context and byte, code length)
        self.left: list[tuple[np.ndarray, np.ndarray]] = []  # by order: (context, cost of leaving it)
        for k in range(order + 1):
            keys, where = np.unique(runs & (1 << 8 * (k + 1)) - 1, return_inverse=True)
            n = np.bincount(where, counts, len(keys))
            contexts, of = np.unique(keys >> 8, return_inverse=True)
            total, kinds = np.bincount(of, n, len(contexts)), np.bincount(of, minlength=len(contexts))
            below = np.full(len(keys), 1 / ALPHABET) if k == 0 else 2.0 ** -self.seen[-1][1][np.searchsorted(self.seen[-1][0], keys & (1 << 8 * k) - 1)]
            full = kinds == ALPHABET
            rest = np.where(full, 1.0, np.maximum(1 - np.bincount(of, below, len(contexts)), 1e-12))
            chance = n / (total + np.where(full, 0, kinds))[of]
            self.seen.append((keys, -np.log2(chance)))
            self.left.append((contexts, -np.log2(kinds / (total + kinds) / rest)))

    def code_lengths(self, runs: np.ndarray) -> np.ndarray:
        """Bits that the last byte of each run costs after the bytes before it."""
        bits = np.zeros(len(runs))
        open_at = np.arange(len(runs))
        for k in range(self.order, -1, -1):
            own = runs[open_at] & (1 << 8 * (k + 1)) - 1
            hit, value = found(*self.seen[k], own)
            bits[open_at[hit]] += value[hit]
            open_at, own = open_at[~hit], own[~hit]
            known, cost = found(*self.left[k], own >> 8)
            bits[open_at[known]] += cost[known]
        bits[open_at] += np.log2(ALPHABET)
        return bits


def found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each of ``wanted`` is among the sorted ``keys``, and its value there."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, values[at]


class Scorer:
    """Code lengths of texts under each tree; distinct runs are looked up once and kept, up to a bound."""

    def __init__(self, trees: list[Tree]):
        self.trees, self.order = trees, trees[0].order
        self.runs, self.bits = np.zeros(0, np.int64), np.zeros((len(trees), 0))

    def rows_of(self, runs: np.ndarray) -> np.ndarray:
        """A row for each tree, a column for each of distinct ``runs``."""
        at = np.minimum(np.searchsorted(self.runs, runs), max(0, len(self.runs) - 1))
        new = np.sort(runs[self.runs[at] != runs] if len(self.runs) else runs)
        if len(new):
            if len(self.runs) + len(new) > KEPT:
                self.runs, self.bits, new = np.zeros(0, np.int64), np.zeros((len(self.trees), 0)), np.sort(runs)
            every = np.concatenate([self.runs, new])
            order = np.argsort(every, kind="stable")
            self.runs, self.bits = every[order], np.concatenate([self.bits, np.stack([t.code_lengths(new) for t in self.trees])], axis=1)[:, order]
            at = np.searchsorted(self.runs, runs)
        return self.bits[:, at]

    def bits_of(self, texts: list[bytes | None]) -> np.ndarray:
        """A row for each text, a column for each tree."""
        out = np.zeros((len(texts), len(self.trees)))
        for runs, owners, starts in runs_of(texts, self.order):
            distinct = pa.array(runs).dictionary_encode()
            where = distinct.indices.to_numpy()
            for k, row in enumerate(self.rows_of(distinct.dictionary.to_numpy())):
                np.add.at(out[:, k], owners, np.add.reduceat(row[where], starts))
        return out


def count_runs(order: int):
    """mapInArrow: (lang, text) to how often each run occurs in a language, for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                texts = batch.column(1).cast(pa.binary()).take(pa.array(np.flatnonzero(langs == lang))).to_pylist()
                for runs, _, _ in runs_of(texts, order):
                    own, n = np.unique(runs, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(own), pa.array(n)], names=["lang", "run", "n"])

    return run


def train(docs: DataFrame, order: int, rows_per_lang: int, max_text_chars: int) -> tuple[list[str], list[Tree]]:
    """Languages and their trees, from rows that are not held out."""
    labelled = docs.where(~held_out(docs) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, rows_per_lang / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = labelled.where(draw < share).select("lang", F.substring("text", 1, max_text_chars).alias("text"))
    got = sample.mapInArrow(count_runs(order), "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(counts)
    trees = []
    for lang in langs:
        own = got.filter(pc.equal(got.column("lang"), lang))
        trees.append(Tree(own.column("run").to_numpy(), own.column("n").to_numpy().astype(float), order))
    return langs, trees


def identify(docs: DataFrame, order: int = 3, rows_per_lang: int = 1500, max_text_chars: int = 1 << 15) -> DataFrame:
    """doc_id, held_out, lang_pred, score for each row of ``docs`` (doc_id, text, lang).

    The trees are learned from about ``rows_per_lang`` rows a language, drawn by a hash of the id, of each the first
    ``max_text_chars`` characters; every row is scored over its whole text.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = source.sparkSession.sparkContext.broadcast(train(source, order, rows_per_lang, max_text_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, trees = model.value
        scorer = Scorer(trees) if langs else None
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                letters = np.array(part.column(2).to_pylist(), bool)
                preds, scores = np.full(part.num_rows, "und", object), np.zeros(part.num_rows)
                if scorer is not None and letters.any():
                    texts = part.column(3).cast(pa.binary()).filter(pa.array(letters)).to_pylist()
                    bits = scorer.bits_of(texts)
                    weight = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000))
                    best = bits.argmin(axis=1)
                    preds[letters] = np.array(langs, object)[best]
                    scores[letters] = 1 / weight.sum(axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(preds, pa.string()), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return source.select("doc_id", held_out(source).alias("held_out"), letters.alias("letters"), "text").mapInArrow(run, SCHEMA)
