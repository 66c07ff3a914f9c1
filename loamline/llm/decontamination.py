"""Benchmark decontamination: an FM-index per training shard.

Every task cuts its documents into shards of bounded size.  A shard's words become symbols of its own
vocabulary, documents are parted by separators of their own, and the suffixes are sorted by prefix doubling.
The Burrows-Wheeler text goes into a wavelet matrix, whose ranks serve two walks: backward search of all
benchmark windows at once, and the way from each match back to a sampled suffix position.  Matches mark word
spans of the document; spans that overlap or touch are merged.

The benchmark is sent in blocks of bounded size, each to all documents, so it may be of any size.  A block's windows are runs of numbers of
its own vocabulary, sorted by a hash of the run.  Runs of a shard with the same hash choose the windows that its index is searched
for, and a shard without any is not indexed; the search itself compares words, so a chance hit of hashes finds nothing.  A worker builds
a block once and keeps up to ``KEPT`` of them.  A document longer than a shard is cut into pieces that overlap by a window less one
word.

Null text has no words: n_words 0, nothing hit.  Items without words are no windows.  Equal windows of several
items count for each of them, repeated item_ids once.  Repeated documents are each reported.  An empty benchmark
hits nothing; empty documents give an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 8
TRANSLATE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
SPANS = "array<struct<start:long,end:long>>"
SCHEMA = f"doc_id long, n_words long, n_hit long, items array<string>, spans {SPANS}"


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cases A-Z and takes runs of ASCII letters, digits and non-ASCII bytes."""
    return (text or b"").translate(TRANSLATE).split()


def words_in(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, and how many each text has."""
    lists = pc.ascii_split_whitespace(pa.array([(t or b"").translate(TRANSLATE).strip() for t in texts], pa.large_binary()).cast(pa.large_string()))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) if len(lists) else np.zeros(0, np.int64)
    flat = lists.flatten()
    filled = pc.not_equal(flat, "")
    empty = ~filled.to_numpy(zero_copy_only=False)
    if empty.any():  # a text without words splits into one empty string
        counts[np.repeat(np.arange(len(counts)), counts)[empty]] = 0
        flat = flat.filter(filled)
    return flat, counts


def multipliers(window: int) -> np.ndarray:
    return np.random.default_rng(20240607).integers(1, 1 << 63, window, np.uint64) * np.uint64(2) + np.uint64(1)


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words.cast(pa.large_binary()).to_pylist()], np.uint64)


def run_hashes(hashes: np.ndarray, length: int, factors: np.ndarray) -> np.ndarray:
    """A hash of each run of ``length`` words."""
    m = len(hashes) - length + 1
    out = np.zeros(max(m, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(length if m > 0 else 0):
            out += hashes[k : k + m] * factors[k]
    return out


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order; ``ranks`` ends with its one smallest value."""
    n = len(ranks)
    if n < 2:
        return np.zeros(n, np.int64)
    bits = int(ranks.max()).bit_length()
    width = min(8, max(1, 62 // max(bits, 1)))
    padded = np.concatenate([ranks.astype(np.int64), np.zeros(width, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(width):
        key = (key << bits) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(key[order[1:]], key[order[:-1]], out=new[1:])
    starts = np.flatnonzero(new)
    group = np.repeat(starts, np.diff(np.append(starts, n)))  # rank of a suffix: where its group starts
    rank = np.empty(n + 1, np.int64)
    rank[order] = group
    rank[n] = -1
    held = width
    open_at = np.flatnonzero(np.repeat(np.diff(np.append(starts, n)) > 1, np.diff(np.append(starts, n))))
    while len(open_at):
        at = order[open_at]
        key = (rank[at] << 32) | (rank[np.minimum(at + held, n)] + 1)
        inner = np.argsort(key, kind="stable")
        key, at = key[inner], at[inner]
        order[open_at] = at
        new = np.empty(len(at), bool)
        new[0] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(at)))
        rank[at] = np.repeat(open_at[first], sizes)
        open_at = open_at[np.repeat(sizes > 1, sizes)]
        held *= 2
    return order


class FMIndex:
    """Over symbols 1..m of one shard; 0 parts documents.  Counts and locates patterns without 0."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        gap = symbols == 0
        n_gaps = int(gap.sum())
        # Separators differ: the last is smallest, so that no suffix is compared beyond its document.
        ranks = symbols.astype(np.int64) + n_gaps
        ranks[gap] = np.arange(n_gaps, 0, -1)
        order = suffix_array(ranks)
        bwt = symbols[order - 1]
        self.m = int(symbols.max(initial=0))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=self.m + 1))])
        self.bits = max(1, self.m.bit_length())
        self.levels: list[tuple[np.ndarray, int]] = []
        at = bwt.astype(np.int32)
        for level in range(self.bits - 1, -1, -1):
            bit = ((at >> level) & 1).astype(bool)
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((ones, n - int(ones[-1])))
            at = np.concatenate([at[~bit], at[bit]])
        after_gap = np.empty(n, bool)
        after_gap[0] = True
        after_gap[1:] = gap[:-1]
        kept = after_gap | (np.arange(n) % SAMPLE == 0)
        self.sampled = kept[order]
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the first ``upto`` places of the transformed text."""
        low, at = np.zeros_like(upto), upto
        for k, (ones, zeros) in enumerate(self.levels):
            bit = (symbol >> (self.bits - 1 - k)) & 1 == 1
            low = np.where(bit, zeros + ones[low], low - ones[low])
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return at - low

    def step_back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one symbol earlier."""
        symbol, low, at = np.zeros_like(row), np.zeros_like(row), row
        for ones, zeros in self.levels:
            bit = ones[at + 1] > ones[at]
            symbol = symbol * 2 + bit
            low = np.where(bit, zeros + ones[low], low - ones[low])
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return self.before[symbol] + at - low

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """patterns: a row each.  Numbers of those that occur, with the bounds of their suffixes."""
        who = np.arange(len(patterns))
        last = patterns[:, -1]
        low, high = self.before[last], self.before[last + 1]
        for k in range(patterns.shape[1] - 2, -1, -1):
            alive = low < high
            who, low, high = who[alive], low[alive], high[alive]
            if not len(who):
                break
            symbol = patterns[who, k]
            low, high = self.before[symbol] + self.rank(symbol, low), self.before[symbol] + self.rank(symbol, high)
        alive = low < high
        return who[alive], low[alive], high[alive]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by way of the sampled ones."""
        out, open_at, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        rows = rows.copy()
        while len(open_at):
            known = self.sampled[rows]
            out[open_at[known]] = self.samples[self.sample_rank[rows[known]]] + steps
            open_at, rows = open_at[~known], self.step_back(rows[~known])
            steps += 1
        return out


class Shard:
    """Pieces (first word, number of words) of a text of word numbers, a gap after each, with an index that is built when first needed."""

    def __init__(self, ids: np.ndarray, pieces: list[tuple[int, int]]):
        self.ids, self.pieces = ids, pieces
        self.starts = np.concatenate([[0], np.cumsum([n + 1 for _, n in pieces])])
        self.index: FMIndex | None = None

    def built(self) -> FMIndex:
        if self.index is None:
            symbols = np.zeros(self.starts[-1], np.int64)
            inside = np.ones(len(symbols), bool)
            inside[self.starts[1:] - 1] = False
            words = np.concatenate([self.ids[at : at + n] for at, n in self.pieces])
            self.words, own = np.unique(words, return_inverse=True)
            symbols[inside] = own + 1
            self.index = FMIndex(symbols)
        return self.index

    def matches(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, piece, place in the piece) of all that occurs of ``patterns``, rows of word numbers."""
        index = self.built()
        at = np.minimum(np.searchsorted(self.words, patterns), len(self.words) - 1)
        known = np.flatnonzero((self.words[at] == patterns).all(axis=1))
        who, low, high = index.search(at[known] + 1) if len(known) else (known, known, known)
        sizes = high - low
        rows = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()) if len(who) else np.zeros(0, np.int64)
        where = index.locate(rows.astype(np.int64))
        piece = np.searchsorted(self.starts, where, "right") - 1
        return known[np.repeat(who, sizes)], piece, where - self.starts[piece]


class Block:
    """A block of the benchmark: its distinct windows by length, each with the items that hold it."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.names = [name for name, _ in items]
        flat, counts = words_in([text for _, text in items])
        coded = flat.dictionary_encode()
        self.vocabulary, self.ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        hashes = np.append(np.uint64(0), word_hashes(self.vocabulary))[self.ids]
        first = np.cumsum(counts) - counts
        #: length: (hash of each window, ascending; where its words stand; where its items start; item numbers)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in np.unique(np.minimum(counts[counts > 0], window)).tolist():
            held = np.flatnonzero(counts == length if length < window else counts >= window)
            per = counts[held] - length + 1
            owner = np.repeat(held, per)
            at = np.repeat(first[held] - (np.cumsum(per) - per), per) + np.arange(per.sum())
            key = run_hashes(hashes, length, multipliers(window))[at]
            order = np.argsort(key, kind="stable")
            owner, at, key = owner[order], at[order], key[order]
            new = np.ones(len(at), bool)
            new[1:] = key[1:] != key[:-1]
            alike = np.flatnonzero(~new)
            new[alike] = (self.ids[at[alike][:, None] + np.arange(length)] != self.ids[at[alike - 1][:, None] + np.arange(length)]).any(axis=1)
            starts = np.flatnonzero(new)
            self.by_length[length] = (key[starts], at[starts], np.append(starts, len(at)), owner)

    def places_in(self, vocabulary: pa.Array) -> np.ndarray:
        """For each number of the block its word's place in ``vocabulary``, -1 if it is not there; number 0 is none."""
        return np.append(-1, pc.index_in(self.vocabulary, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64))


class Runs:
    """The runs of words within texts, sorted by hash for each length that is asked for."""

    def __init__(self, hashes: np.ndarray, doc: np.ndarray, factors: np.ndarray):
        self.hashes, self.doc, self.factors = hashes, doc, factors
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, ascending; where each run starts)"""
        if length not in self.sorted:
            at = np.flatnonzero(self.doc[length - 1 :] == self.doc[: len(self.doc) - length + 1]) if len(self.doc) >= length else np.zeros(0, np.int64)
            own = run_hashes(self.hashes, length, self.factors)[at]
            order = np.argsort(own)
            self.sorted[length] = own[order], at[order]
        return self.sorted[length]

    def equal(self, length: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of a key, where a run has its hash)"""
        own, at = self.of(length)
        low, high = np.searchsorted(own, keys, "left"), np.searchsorted(own, keys, "right")
        hit = np.flatnonzero(low < high)
        sizes = (high - low)[hit]
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return np.repeat(hit, sizes), at[np.repeat(low[hit], sizes) + inner]


#: Blocks that a worker keeps, by the benchmark they are of and their number.
BUILT: dict[tuple[str, int], Block] = {}
KEPT = 16


def blocks_of(sent: list, key: str, window: int) -> Iterator[Block]:
    """The broadcast blocks one after another, built; if there are several, what was sent is not kept beside them."""
    for k, b in enumerate(sent):
        block = BUILT.get((key, k))
        if block is None:
            block = Block(b.load_from_path(b._path) if len(sent) > 1 and getattr(b, "_path", None) else b.value, window)
            for old in [o for o in BUILT if o[0] != key]:
                del BUILT[old]
            if len(BUILT) < KEPT:
                BUILT[key, k] = block
        yield block


def scan_texts(texts: list[bytes | None], blocks: Iterator[Block], window: int, shard_words: int) -> list[tuple[int, int, list[str], list[tuple[int, int]]]]:
    """For each text: its words, words hit, item ids, merged spans."""
    flat, counts = words_in(texts)
    coded = flat.dictionary_encode()
    ids, first = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(counts) - counts
    pieces = [(d, at, min(n - at, shard_words + window - 1)) for d, n in enumerate(counts.tolist()) if n for at in range(0, max(1, n - window + 1), shard_words)]
    begins = np.array([first[d] + at for d, at, _ in pieces], np.int64)
    groups = list(grouped([n for _, _, n in pieces], shard_words))
    shards = [Shard(ids, [(int(begins[k]), pieces[k][2]) for k in g]) for g in groups]
    shard_of = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    owner, offset = (np.array([p[i] for p in pieces], np.int64) for i in (0, 1))
    doc = np.repeat(np.arange(len(counts)), counts)
    covers: dict[int, np.ndarray] = {}
    names: dict[int, set[str]] = {}
    runs = Runs(word_hashes(coded.dictionary)[ids], doc, multipliers(window))
    for block in blocks if len(ids) else ():
        places = None
        for length, (keys, stands, item_starts, items) in block.by_length.items():
            number, at = runs.equal(length, keys)
            if not len(at):
                continue
            places = block.places_in(coded.dictionary) if places is None else places
            wanted = np.unique(np.stack([shard_of[np.searchsorted(begins, at, "right") - 1], number]), axis=1)
            for s in np.unique(wanted[0]).tolist():
                windows = wanted[1][wanted[0] == s]
                who, piece, place = shards[s].matches(places[block.ids[stands[windows][:, None] + np.arange(length)]])
                piece = piece + groups[s].start
                hit_doc, place = owner[piece], place + offset[piece]
                by = np.argsort(hit_doc, kind="stable")
                for part in np.split(by, np.flatnonzero(np.diff(hit_doc[by])) + 1) if len(by) else ():
                    d = int(hit_doc[part[0]])
                    cover = covers.setdefault(d, np.zeros(counts[d] + 1, np.int64))
                    np.add.at(cover, place[part], 1)
                    np.add.at(cover, place[part] + length, -1)
                    for w in windows[np.unique(who[part])].tolist():
                        names.setdefault(d, set()).update(block.names[i] for i in items[item_starts[w] : item_starts[w + 1]])
    out: list[tuple[int, int, list[str], list[tuple[int, int]]]] = []
    for d, n in enumerate(counts.tolist()):
        if d not in covers:
            out.append((n, 0, [], []))
            continue
        edge = np.diff(np.concatenate([[0], np.cumsum(covers[d]) > 0]).astype(np.int8))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out.append((n, int((end - begin).sum()), sorted(names[d]), list(zip(begin.tolist(), end.tolist(), strict=True))))
    return out


def scan(sent: list, window: int, shard_words: int, held_bytes: int, at: int, finish):
    """A mapInArrow function over rows whose column number ``at`` is the text; ``sent``: broadcast blocks of the benchmark.

    Rows of ``held_bytes`` of text, or one longer, are held for one pass over the blocks.  ``finish`` makes their output from the rows, their
    texts and a function that searches texts.
    """
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def search(texts: list[bytes | None]) -> list[tuple[int, int, list[str], list[tuple[int, int]]]]:
            return scan_texts(texts, blocks_of(sent, key, window), window, shard_words)

        def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            yield from finish(rows, [t for c in rows.column(at).chunks for t in c.cast(pa.binary()).to_pylist()], search).to_batches()

        held, size = [], 0
        for batch in batches:
            first = 0
            for k, n in enumerate(pc.binary_length(batch.column(at)).fill_null(0).to_pylist()):
                if size and size + n > held_bytes:
                    held.append(batch.slice(first, k - first))
                    yield from done(held)
                    held, size, first = [], 0, k
                size += n
            held.append(batch.slice(first))
        if held:
            yield from done(held)

    return run


def grouped(lengths: list[int], shard_words: int) -> Iterator[range]:
    """Runs of pieces that make a shard of at most twice ``shard_words``."""
    start, size = 0, 0
    for k, n in enumerate(lengths):
        if size and size + n > 2 * shard_words:
            yield range(start, k)
            start, size = k, 0
        size += n
    if lengths:
        yield range(start, len(lengths))


def sent_blocks(benchmark: DataFrame, block_bytes: int) -> list:
    """Broadcast blocks of ``benchmark`` (item_id, text), of about ``block_bytes`` each."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    sent = []
    for k in range(blocks):
        some = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        sent.append(benchmark.sparkSession.sparkContext.broadcast([(r[0], r[1].encode() if r[1] is not None else None) for r in some]))
    return sent


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = 200_000, block_bytes: int = 2 << 20, held_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted strings), spans of words, for each row of ``docs`` (doc_id, text).

    Each shard is indexed at most once and searched for one block of the benchmark after another.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def finish(rows: pa.Table, texts: list[bytes | None], search) -> pa.Table:
        found = search(texts)
        columns = [
            rows.column(0), pa.array([r[0] for r in found], pa.int64()), pa.array([r[1] for r in found], pa.int64()),
            pa.array([r[2] for r in found], pa.list_(pa.string())), pa.array([[{"start": a, "end": b} for a, b in r[3]] for r in found], span),
        ]
        return pa.table(columns, names=["doc_id", "n_words", "n_hit", "items", "spans"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(scan(sent_blocks(benchmark, block_bytes), window, shard_words, held_bytes, 1, finish), SCHEMA)


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_words: int = 200_000, block_bytes: int = 2 << 20, held_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs``, with all their columns, less the merged spans of words that windows of ``benchmark`` hit.

    A text whose remains meet in a new window is searched again, until none is left.  n_chars, if there, follows.  A row
    of whose words none is left goes; rows without hits stay as they are.
    """
    at, names = docs.columns.index("text"), docs.columns

    def finish(rows: pa.Table, raw: list[bytes | None], search) -> pa.Table:
        open_at = [(k, r[3]) for k, r in enumerate(search(raw)) if r[1]]
        if not open_at:
            return rows
        texts, kept = rows.column(at).to_pylist(), [True] * len(raw)
        changed: set[int] = set()
        while open_at:
            for k, spans in open_at:
                texts[k] = without_spans(texts[k], spans)
                changed.add(k)
            again = [k for k, _ in open_at]
            found = search([texts[k].encode() for k in again])
            open_at = [(k, r[3]) for k, r in zip(again, found, strict=True) if r[1]]
        for k in changed:
            kept[k] = bool(words_of(texts[k].encode()))
        out = rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.schema.field(at).type))
        if "n_chars" in names:
            c = names.index("n_chars")
            chars = [len(texts[k]) if k in changed else n for k, n in enumerate(rows.column(c).to_pylist())]
            out = out.set_column(c, rows.schema.field(c), pa.array(chars, rows.schema.field(c).type))
        return out.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(scan(sent_blocks(benchmark, block_bytes), window, shard_words, held_bytes, at, finish), docs.schema)


def report(found: DataFrame) -> DataFrame:
    """The digest: n_items, items_sha256 of the comma-joined ids, contaminated."""
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` less the words of ``spans`` and what stands between them."""
    if not text or not spans:
        return text
    raw = text.encode()
    at = word_bounds(raw)
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done : at[a][0]])
        done = at[b - 1][1]
    out.append(raw[done:])
    return b"".join(out).decode("utf-8", "replace")


def word_bounds(raw: bytes) -> list[tuple[int, int]]:
    inside = np.frombuffer(raw.translate(TRANSLATE), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
