"""Token counts by a two-tier lookup on the map side.

Text is cut at ASCII white space.  The tokenizers this serves drop white space and never let a pre-token
span it, so a text's token count is the sum over its pieces.  Tier one is a compact broadcast table of the lengths of
frequent pieces: the words of the tokenizer's own vocabulary, which its makers chose by frequency.  So the table needs no pass over the
texts, and its size is that of the vocabulary whatever the input.  Tier two is a bounded cache of the worker, which tasks on it share: a
piece that the table lacks is encoded by the tokenizer once and kept.  Nothing is shuffled and nothing is gathered; rows are read once.

Pieces of more than ``LONGEST`` bytes (texts without blanks) are encoded, but not kept.

Null text counts as empty (0 bytes, 0 tokens); repeated rows are counted each; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Longest piece in bytes that a worker keeps.
LONGEST = 64
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def load(blob: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(blob)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def lengths(tokenizer, pieces: list[bytes]) -> list[int]:
    texts = [p.decode("utf-8", "replace") for p in pieces]
    return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def frequent_pieces(tokenizer) -> list[bytes]:
    """Words of letters of the tokenizer's vocabulary, without the signs that mark a word's start or end, in order of their ids."""
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    bare = (t.removesuffix("</w>").lstrip("Ġ▁") for t in sorted(vocabulary, key=vocabulary.get))
    return [w.encode() for w in dict.fromkeys(bare) if w.isascii() and w.isalpha()]


class Worker:
    """What tasks on one worker share for a tokenizer: itself, the table, and the cache of pieces that the table lacks."""

    held: dict[bytes, Worker] = {}

    def __init__(self, blob: str, table: dict[bytes, int], cache_entries: int):
        self.tokenizer, self.table, self.cache, self.cache_entries = load(blob), table, {}, cache_entries

    @classmethod
    def of(cls, key: bytes, blob: str, table: dict[bytes, int], cache_entries: int) -> Worker:
        if key not in cls.held:
            cls.held.clear()
            cls.held[key] = cls(blob, table, cache_entries)
        return cls.held[key]

    def lengths_of(self, pieces: list[bytes]) -> np.ndarray:
        """The number of tokens of each of distinct ``pieces``."""
        table, cache = self.table, self.cache
        missing = [p for p in pieces if p not in table and p not in cache]
        long = {p: lengths(self.tokenizer, [p])[0] for p in missing if len(p) > LONGEST}
        short = [p for p in missing if len(p) <= LONGEST]
        if len(cache) + len(short) > self.cache_entries:
            cache.clear()
            short = [p for p in pieces if p not in table and len(p) <= LONGEST]
        for at in range(0, len(short), 5000):
            some = short[at : at + 5000]
            cache.update(zip(some, lengths(self.tokenizer, some), strict=True))
        own = [table[p] if p in table else cache[p] if p in cache else long[p] for p in pieces]
        if len(cache) > self.cache_entries:  # one part alone held more
            cache.clear()
        return np.array(own, np.int64)


def parts_of(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``most`` bytes of text; a longer text is a run of its own."""
    upto, start = np.concatenate([[0], np.cumsum(sizes)]), 0
    while start < len(sizes):
        end = max(start + 1, int(np.searchsorted(upto, upto[start] + most, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048, cache_entries: int = 1_000_000, part_bytes: int = 4 << 20) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of each row of ``docs`` (doc_id, text).

    ``cache_entries`` bounds each worker's cache, which starts anew when full; ``part_bytes`` is how much text is looked up at once.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    with open(tokenizer_path, encoding="utf-8") as f:
        blob = f.read()
    tokenizer = load(blob)
    pieces = frequent_pieces(tokenizer)
    table = dict(zip(pieces, lengths(tokenizer, pieces), strict=True))
    key = hashlib.sha256(f"{cache_entries}:{blob}".encode()).digest()
    shared = docs.sparkSession.sparkContext.broadcast((key, blob, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Worker.of(*shared.value, cache_entries)
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            for part in parts_of(batch, sizes, part_bytes):
                words = pc.ascii_split_whitespace(part.column(1).cast(pa.large_string()))
                coded = words.flatten().cast(pa.large_binary()).dictionary_encode()
                known = worker.lengths_of(coded.dictionary.to_pylist())
                upto = np.concatenate([[0], np.cumsum(known[coded.indices.to_numpy()])])
                ends = np.cumsum(pc.list_value_length(words).to_numpy())
                counts = np.diff(upto[np.concatenate([[0], ends])])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pc.binary_length(part.column(1)).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(counts > limit, pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return rows.mapInArrow(run, SCHEMA)
