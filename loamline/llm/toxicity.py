"""Toxicity by weak supervision.

Voters: a fixed lexicon; lexicons of words and of word beginnings that stand out in toxic rows of the labelled
sample, dealt over several voters; patterns (several hits, hits to so many words, shouting, strings of marks); and the annotators'
labels of the sample.  A generative label model, fitted by expectation maximisation, estimates each voter's rates under
either class and the correlation of voters within a class; correlated voters are discounted.  A linear classifier over the
single words, the beginnings and the density of hits is trained on its posterior labels.

A word counts where it stands; a beginning only where it starts at least one in ``SPARSE`` of a text's words, as in a long text any will.

Labels are learned from rows whose crc32(doc_id as text) mod 4 is not 2.  Null and empty texts have no features and get the
score of the bias.  Null labels are not learned from; of several labels of one id the largest counts.  Without toxic labels the
fixed lexicon alone decides.  Repeated rows are scored each.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import id_crc

FIXED = frozenset(
    "idiot idiots moron morons stupid scum trash garbage loser losers pathetic worthless disgusting clown imbecile dumb jerk fool filthy vermin hate"
    " shut ugly coward liar creep freak bastard bitch asshole crap retard".split()
)
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (4, 5, 6, 7)
SPARSE = 150
#: A text is as dense as the number of these that its hits exceed, in hits to 1000 words.
DENSITIES = (3, 6, 10, 20)
THRESHOLD = 0.3
VOTERS_PER_KIND = 3
#: Bounds of the labelled sample that the model is fitted on.
BOUNDS = {"max_toxic": 2500, "max_other": 5000, "max_features": 2000, "max_text_bytes": 1 << 16}
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def word_counts(text: str | None) -> Counter[str]:
    return Counter(WORD.findall(text.lower())) if text else Counter()


def features(words: Counter[str]) -> set[str]:
    """Distinct words, and the frequent beginnings marked by a dash."""
    starts: Counter[str] = Counter()
    for n in BEGINNINGS:
        for w, c in words.items():
            if len(w) >= n:
                starts[w[:n] + "-"] += c
    least = words.total() / SPARSE
    return set(words) | {b for b, c in starts.items() if c >= least}


def tail(k: int, n: int, rate: float) -> float:
    """Chance of k or more of n at ``rate``, at least roughly: the first term times a geometric bound."""
    if k <= n * rate:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate)
    ratio = (n - k) / (k + 1) * rate / (1 - rate)
    return min(1.0, math.exp(log) / max(1e-9, 1 - min(ratio, 0.999)))


def patterns(text: str | None, hits: int, words: int) -> list[bool]:
    shout = len(re.findall(r"\b[A-ZÀ-Þ]{3,}\b", text or ""))
    return [hits >= 2, hits >= 3, *(1000 * hits > d * max(1, words) for d in DENSITIES), 2 * shout > words, "!!" in (text or "")]


class Lexicon:
    """Finds its words and beginnings in a text."""

    def __init__(self, entries: list[str]):
        self.number = {f: k for k, f in enumerate(entries)}
        self.starts = frozenset(f[: BEGINNINGS[0]] for f in entries if f.endswith("-"))
        self.lengths = sorted({len(f) - 1 for f in entries if f.endswith("-")})

    def find(self, words: Counter[str]) -> tuple[list[int], int]:
        """Numbers of the entries that count in the text, and how many of its words any entry hits."""
        number, starts, found, begun, hits = self.number, self.starts, [], {}, 0
        for w, c in words.items():
            hit = w in number
            if hit:
                found.append(number[w])
            if w[: BEGINNINGS[0]] in starts:
                for n in self.lengths:
                    k = number.get(w[:n] + "-") if len(w) >= n else None
                    if k is not None:
                        begun[k] = begun.get(k, 0) + c
                        hit = True
            if hit:
                hits += c
        if begun:
            least = words.total() / SPARSE
            found += [k for k, c in begun.items() if c >= least]
        return sorted(found), hits


class Model:
    """Lexicon and classifier: small, whatever the corpus."""

    def __init__(self, lexicon: list[str], weights: np.ndarray, bias: float):
        """``weights``: of the entries, then of the densities."""
        self.lexicon, self.weights, self.bias = Lexicon(lexicon), weights.tolist(), bias
        self.dense = len(lexicon)

    def score(self, text: str | None) -> float:
        words = word_counts(text)
        found, hits = self.lexicon.find(words)
        at = self.bias + sum(self.weights[k] for k in found)
        if hits:
            n = words.total()
            at += sum(self.weights[self.dense + i] for i, d in enumerate(DENSITIES) if 1000 * hits > d * n)
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, at))))


def fixed_model() -> Model:
    lexicon = sorted(FIXED)
    return Model(lexicon, np.concatenate([np.full(len(lexicon), 5.0), np.zeros(len(DENSITIES))]), -3.0)


def label_model(votes: np.ndarray, weight: np.ndarray, prior: float, rounds: int = 50) -> np.ndarray:
    """Posterior of the toxic class of each row of 0/1 ``votes``."""
    active = votes.std(axis=0) > 0
    v = votes[:, active].astype(float)
    if not v.shape[1]:
        return np.full(len(votes), prior)
    post = np.where(v.sum(axis=1) > 0, 0.9, 0.05)
    discount = np.ones(v.shape[1])
    for r in range(rounds):
        rates = []
        for p in (post, 1 - post):
            w = (p * weight)[:, None]
            rates.append(np.clip(((w * v).sum(axis=0) + 0.5 * v.mean(axis=0)) / (w.sum() + 0.5), 1e-4, 1 - 1e-4))
        if r % 10 == 9:  # correlations within a class, given the labels so far
            joint = np.zeros((v.shape[1],) * 2)
            for p, rate in zip((post, 1 - post), rates, strict=True):
                d = (v - rate) / np.sqrt(rate * (1 - rate))
                w = (p * weight)[:, None]
                joint += (d * w).T @ d / max(weight.sum(), 1e-9)
            np.fill_diagonal(joint, 0)
            discount = 1 / (1 + np.clip(np.abs(joint), 0, 1).sum(axis=1))
        gain = discount * (v * np.log(rates[0] / rates[1]) + (1 - v) * np.log((1 - rates[0]) / (1 - rates[1])))
        logit = math.log(prior / (1 - prior)) + gain.sum(axis=1)
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return post


def fit_linear(rows: list[list[int]], n: int, target: np.ndarray, weight: np.ndarray, rounds: int = 300, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by adaptive gradient steps."""
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.array([f for r in rows for f in r], np.int64)
    w, b = np.zeros(n), 0.0
    seen_w, seen_b = np.full(n, 1e-8), 1e-8
    total = weight.sum()
    for _ in range(rounds):
        z = b + np.bincount(of, w[at], len(rows))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * weight / total
        gw, gb = np.bincount(at, g[of], n) + decay * w, g.sum()
        seen_w += gw * gw
        seen_b += gb * gb
        w -= 0.5 * gw / np.sqrt(seen_w)
        b -= 0.5 * gb / math.sqrt(seen_b)
    return w, b


def learned(docs: DataFrame, labels: DataFrame, max_toxic: int, max_other: int, max_features: int, max_text_bytes: int) -> Model:
    """Fits the voters, the label model and the classifier on a bounded sample of labelled rows."""
    marked = labels.where(F.col("toxic").isNotNull() & (id_crc(F.col("doc_id").cast("long")) % 4 != 2)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = {r[0]: r[1] for r in marked.groupBy("toxic").count().collect()}
    n_toxic, n_other = counts.get(1, 0), counts.get(0, 0)
    if not n_toxic or not n_other:
        return fixed_model()
    shares = {1: min(1.0, max_toxic / n_toxic), 0: min(1.0, max_other / n_other)}
    draw = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    # The sample's size is bounded by the parameters, and so may be sent to all.
    sample = F.broadcast(marked.where(draw < F.when(F.col("toxic") == 1, shares[1]).otherwise(shares[0])))
    rows = docs.join(sample, "doc_id").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_text_bytes).select("toxic", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        sizes = [0, 0]
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[toxic].update(features(word_counts(text)))
                sizes[toxic] += 1
        for kind in (0, 1):
            seen[kind][""] = sizes[kind]
        # A feature that no toxic row here holds is kept too: other tasks may have seen it there.
        keys = list(seen[0].keys() | seen[1].keys())
        for at in range(0, len(keys), 50_000):
            some = keys[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([seen[1][k] for k in some], pa.int64()), pa.array([seen[0][k] for k in some], pa.int64())], names=["feature", "toxic", "other"])

    counted = rows.mapInArrow(count, "feature string, toxic long, other long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    counted = counted.where("feature = '' or (toxic >= 3 and toxic > other)").orderBy(F.desc(F.col("feature") == ""), F.desc(F.col("toxic") / (F.col("other") + 1.0)), "feature").limit(20 * max_features).collect()
    totals = next(((r[1], r[2]) for r in counted if r[0] == ""), (0, 0))
    if not totals[0] or not totals[1]:
        return fixed_model()
    rate = totals[0] / sum(totals)
    scored = sorted((tail(r[1], r[1] + r[2], rate), r[0]) for r in counted if r[0])
    lexicon = [f for p, f in scored if p < 1e-4][:max_features]
    names = lexicon + sorted(FIXED - set(lexicon))

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = Lexicon(names)
        for batch in batches:
            toxic, found, marks = [], [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = word_counts(text)
                own, hits = entries.find(words)
                toxic.append(label), found.append(own), marks.append(patterns(text, hits, words.total()))
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(found, pa.list_(pa.int32())), pa.array(marks, pa.list_(pa.bool_()))], names=["toxic", "found", "marks"])

    got = sorted(map(tuple, rows.mapInArrow(select, "toxic int, found array<int>, marks array<boolean>").collect()))
    voters_of = [[0] * (f in FIXED) + [1 + (2 * k + f.endswith("-")) % (2 * VOTERS_PER_KIND)] * (k < len(lexicon)) for k, f in enumerate(names)]
    first_mark = 1 + 2 * VOTERS_PER_KIND
    votes = np.zeros((len(got), first_mark + len(got[0][2]) + 1), bool)
    for i, (toxic, found, marks) in enumerate(got):
        votes[i, [v for f in found for v in voters_of[f]]] = True
        votes[i, first_mark:-1] = marks
        votes[i, -1] = toxic
    weight = np.array([1 / shares[t] for t, _, _ in got])
    prior = n_toxic / (n_toxic + n_other)
    posterior = label_model(votes, weight / weight.mean(), min(max(prior, 0.01), 0.99))
    used = [[*f, *(len(names) + d for d in range(len(DENSITIES)) if m[2 + d])] for _, f, m in got]
    w, b = fit_linear(used, len(names) + len(DENSITIES), posterior, weight)
    return Model(names, w, b)


def score(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, toxic).  Of ``BOUNDS``, which ``bounds`` may change, max_toxic and max_other bound the labelled sample,
    drawn by a hash of the id, of texts of at most max_text_bytes; every row is scored over its whole text.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = source.sparkSession.sparkContext.broadcast(learned(source, labels, **(BOUNDS | bounds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = model.value.score
        for batch in batches:
            scores = [rate(text.as_py()) for text in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    return source.select("doc_id", (id_crc(F.col("doc_id")) % 4 == 2).alias("held_out"), "text").mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below ``threshold``."""
    at = docs.columns.index("text")
    model = docs.sparkSession.sparkContext.broadcast(learned(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), labels, **BOUNDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = model.value.score
        for batch in batches:
            yield batch.filter(pa.array([rate(text.as_py()) < threshold for text in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
