"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are all windows of `window` consecutive words of the benchmark items (a
shorter item is one pattern). Words are numbered. Per pattern length there is one searcher:
a shift table over blocks of two words says how far on an occurrence can end at the earliest;
it is looked up for all blocks of a text at once, and only places with shift 0 are visited.
There the block and the one that would begin the pattern select a bucket, and a direct
comparison of all words confirms.

The benchmark goes to the executors in blocks of at most `block_bytes` of text, each
broadcast on its own; documents flow through one pass per block, without a shuffle. A worker
builds a block's tables once and holds those of one block: arrays of some 300 bytes a word.

Defined cases: a null text has no words; items with no words match nothing; items of a
null item_id mark words as hit but are not listed; repeated documents are judged row by
row, repeated item ids count once; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import repeat
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import give_back, id_and_bytes, rows, stable

WINDOW = 13
BLOCK_BYTES = 8 << 20
#: ASCII letters lower-cased; all that isn't a letter, a digit or beyond ASCII becomes a space.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


class WuManber:
    """Searches sequences of word numbers for patterns of one length; all tables are arrays.

    patterns: one row of word numbers each, all distinct; vocabulary: how many numbers there are.
    """

    def __init__(self, patterns: np.ndarray, vocabulary: int) -> None:
        self.m, self.vocabulary = patterns.shape[1], vocabulary
        self.block = min(2, self.m)
        self.far = self.m - self.block + 1
        pairs = self._keys(patterns)  # the block that ends at each place of each pattern
        shift = np.broadcast_to(np.arange(self.far - 1, -1, -1, dtype=np.int32), pairs.shape)
        by = np.lexsort((shift.ravel(), pairs.ravel()))
        keys = pairs.ravel()[by]
        first = np.append(True, keys[1:] != keys[:-1])
        self.keys, self.shift = keys[first], shift.ravel()[by][first]
        # a bucket has the patterns that end in one block and begin with one
        both = np.searchsorted(self.keys, pairs[:, -1]) * len(self.keys) + np.searchsorted(self.keys, pairs[:, 0])
        self.order = np.argsort(both, kind="stable")
        self.patterns, self.buckets = patterns[self.order], both[self.order]

    def _keys(self, numbers: np.ndarray) -> np.ndarray:
        """Each block of consecutive words as one number."""
        wide = numbers.astype(np.int64)
        return wide if self.block == 1 else wide[..., :-1] * self.vocabulary + wide[..., 1:]

    def search(self, doc: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, pattern number) of each occurrence, ascending; words that no pattern has are -1."""
        m, n = self.m, len(doc)
        if n < m:
            return
        real = doc >= 0
        known = np.flatnonzero(real if self.block == 1 else real[1:] & real[:-1])
        if not len(known):
            return
        key = self._keys(doc)[known]
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        met = self.keys[slot] == key
        at = np.full(n + 1, -1, np.int64)
        at[known[met] + self.block] = slot[met]
        # places whose block has a shift are skipped, the others meet the bucket of both blocks
        end = m + np.flatnonzero((at[m:] >= 0) & (self.shift[at[m:]] == 0) & (at[self.block : n + 1 - m + self.block] >= 0))
        both = at[end] * len(self.keys) + at[end - m + self.block]
        low = np.searchsorted(self.buckets, both)
        some = np.flatnonzero(self.buckets[np.minimum(low, len(self.buckets) - 1)] == both)
        high = np.searchsorted(self.buckets, both[some], side="right")
        for e, a, b in zip(end[some].tolist(), low[some].tolist(), high.tolist()):
            for i in np.flatnonzero((self.patterns[a:b] == doc[e - m : e]).all(1)).tolist():
                yield e - m, int(self.order[a + i])


class Searchers:
    """The searchers of a block of items, one per pattern length, and the items of each pattern."""

    def __init__(self, items: list[tuple], window: int = WINDOW) -> None:
        """items: (label, text bytes)."""
        self.number: dict[bytes, int] = {}
        rows: dict[int, list] = {}
        for label, text in items:
            w = np.fromiter((self.number.setdefault(x, len(self.number)) for x in words(text)), np.int32)
            if len(w):
                size = min(window, len(w))
                rows.setdefault(size, []).append((label, np.lib.stride_tricks.sliding_window_view(w, size)))
        self.each: list[tuple[WuManber, list[tuple]]] = []
        for size, own in rows.items():
            every = np.ascontiguousarray(np.concatenate([v for _, v in own]))
            distinct, which = np.unique(every.view(np.dtype((np.void, 4 * size))).ravel(), return_inverse=True)
            label_of = np.repeat(np.arange(len(own)), [len(v) for _, v in own])
            pairs = np.unique(np.stack([which, label_of], 1), axis=0)
            cuts = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
            of = ([own[i][0] for i in pairs[:, 1].tolist()], cuts)
            patterns = distinct.view(np.int32).reshape(-1, size)
            self.each.append((WuManber(patterns, len(self.number)), of))

    def find(self, text: bytes | None) -> Iterator[tuple[int, int, list]]:
        """(start, end, labels) of each occurrence in a text."""
        doc = np.array([*map(self.number.get, words(text), repeat(-1))], np.int32)
        for searcher, (labels, cuts) in self.each:
            for start, p in searcher.search(doc):
                yield start, start + searcher.m, labels[cuts[p] : cuts[p + 1]]


_built: dict[tuple, Searchers] = {}


def _searchers(shared, name: str, window: int) -> Searchers:
    """The searchers of the block of that name, built once per worker; only the last block's are held."""
    if (name, window) not in _built:
        _built.clear()
        _built[name, window] = Searchers(shared.value, window)
    return _built[name, window]


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """Items in blocks of at most block_bytes (or one item), streamed to the driver."""
    block, size = [], 0
    for label, text in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).toLocalIterator():
        text = bytes(text or b"")
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((label, text))
        size += len(text)
    yield block


def _passes(df: DataFrame, benchmark: DataFrame, block_bytes: int, one: Callable[[DataFrame, object, str], DataFrame]) -> DataFrame:
    """A pass over df for each block; a checkpoint between two, so that one block's tables are held at a time."""
    for i, block in enumerate(_blocks(benchmark, block_bytes)):
        df = one(stable(df) if i else df, df.sparkSession.sparkContext.broadcast(block), uuid4().hex)
    return df


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, spans (merged word ranges, flat), items (sorted ids)."""
    df = id_and_bytes(docs).withColumns({"spans": F.array().cast("array<int>"), "items": F.array().cast("array<string>"), "n_words": F.lit(0).cast("long")})

    def one(df: DataFrame, shared, name: str) -> DataFrame:
        def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _searchers(shared, name, window)
            for batch in batches:
                spans, labels, n_words = [], [], []
                for doc_id, text, own, names, _ in rows(batch):
                    names, flat = set(names), []
                    own = list(zip(own[::2], own[1::2]))
                    for a, b, items in found.find(text):
                        own.append((a, b))
                        names.update(items)
                    for a, b in sorted(own):
                        if flat and a <= flat[-1]:
                            flat[-1] = max(flat[-1], b)
                        else:
                            flat += (a, b)
                    spans.append(flat)
                    labels.append(sorted(names, key=lambda x: (x is None, x)))
                    n_words.append(len(words(text)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.list_(pa.int32())), pa.array(labels, pa.list_(pa.string())), pa.array(n_words, pa.int64())], names=["doc_id", "text", "spans", "items", "n_words"])
                give_back()

        return df.mapInArrow(extend, "doc_id long, text binary, spans array<int>, items array<string>, n_words long")

    found = _passes(df, benchmark, block_bytes, one)
    hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), "spans", F.filter("items", lambda x: x.isNotNull()).alias("items"))


def is_contaminated(n_hit: F.Column, n_words: F.Column) -> F.Column:
    """At least one word in twenty lies in a benchmark window."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest per document that the query returns."""
    found = find_contamination(docs, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no benchmark window occurs, all their columns unchanged, row by row.

    One window is enough: the share of a text that it takes up only matters to the report.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("binary").alias("text"))

    def one(df: DataFrame, shared, name: str) -> DataFrame:
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = _searchers(shared, name, window)
            for batch in batches:
                clean = [next(found.find(text.as_py()), None) is None for text in batch.column(1)]
                yield batch.filter(pa.array(clean, pa.bool_()))
                give_back()

        return df.mapInArrow(keep, df.schema)

    return _passes(packed, benchmark, block_bytes, one).select(*[F.col(f"row.`{c}`").alias(c) for c in names])


def sha256_of(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
