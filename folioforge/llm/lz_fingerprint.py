"""Lempel-Ziv phrase fingerprints of documents.

Each text is parsed from left to right into dictionary phrases, each the longest known
phrase plus one byte (UTF-8); the set of phrases is hashed, and the `size` least hashes are the
fingerprint. Texts that would compress each other well share phrases, so the share of
common values among the least ones of both sets (bottom-k, an unbiased estimate of the
Jaccard likeness) is a compression-like similarity. Sets smaller than `size` are compared
exactly.

A text's phrases depend on what comes before them only, so a changed ending keeps the
phrases before it. Fingerprints are strings of hexadecimal digits, 8 for each hash.

Defined cases: a null text is an empty one; empty texts have the empty fingerprint, alike
to each other (1) and unlike all others (0); repeated rows follow each other in the order
of texts; null ids come last; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import mix64

SIZE = 128
#: Hexadecimal digits per hash in the fingerprint's string.
DIGITS = 8
_MASK = (1 << 61) - 1


class Parser:
    """Parses bytes into phrases; its state can be kept at any point and taken up again.

    The dictionary is a trie: node << 8 plus a byte leads to the next node << 8. A phrase's
    hash grows out of its prefix's, so it depends on its bytes alone.
    """

    __slots__ = ("trie", "hashes", "at")

    def __init__(self, trie: dict | None = None, hashes: list | None = None, at: int = 0) -> None:
        self.trie, self.hashes, self.at = trie or {}, hashes or [1], at

    def feed(self, data: bytes) -> Parser:
        trie, hashes, at = self.trie, self.hashes, self.at
        get, add = trie.get, hashes.append
        for c in data:
            n = get(at + c)
            if n is None:
                trie[at + c] = len(hashes) << 8
                add((hashes[at >> 8] * 0x9E3779B1 + c + 1) & _MASK)
                at = 0
            else:
                at = n
        self.at = at
        return self

    def copy(self) -> Parser:
        return Parser(dict(self.trie), list(self.hashes), self.at)

    def phrases(self) -> np.ndarray:
        """Hashes of the phrases; an unfinished phrase at the end is a known one."""
        return np.array(self.hashes[1:], np.uint64)

    def sketch(self, size: int = SIZE) -> np.ndarray:
        """The least hashes of the phrases, ascending."""
        h = mix64(self.phrases()) >> np.uint64(64 - 4 * DIGITS)
        h = np.unique(h) if len(h) <= 4 * size else np.unique(np.partition(h, 2 * size)[: 2 * size])
        return h[:size]


def to_string(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    """Share of common values among the `size` least ones of both sketches together."""
    if not len(a) and not len(b):
        return 1.0
    both = np.union1d(a, b)[:size]
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(both))


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, fingerprint): one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [to_string(Parser().feed((t.as_py() or "").encode()).sketch(size)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def _with_edit(text: str, following: str, size: int) -> tuple[np.ndarray, np.ndarray, str]:
    """Fingerprints of a text and of the text whose last quarter gives way to the following one's start."""
    cut = len(text) - len(text) // 4
    edited = text[:cut] + following[: len(text) // 4]
    head = Parser().feed(text[:cut].encode())
    other = head.copy().feed(edited[cut:].encode())
    return head.feed(text[cut:].encode()).sketch(size), other.sketch(size), edited


def edit_report(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The digest per document that the query returns: each text against its edited one and the next.

    The texts are shuffled once, by ranges of ids. The first row of each range is also given
    to the range before, as the one that follows its last; so no row waits for another task.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n = narrow.count()
    parts = max(1, min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n))
    accuracy = 20 * parts
    cuts = narrow.filter("doc_id is not null").agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], accuracy)).first()[0] or []
    cuts = sorted(set(cuts))
    # ranges: [.., cuts[0]), [cuts[0], cuts[1]), ...; null ids after the last
    ranges = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.expr(_range_sql(cuts)))
    keyed = narrow.withColumn("part", ranges.cast("int"))
    heads = sorted(keyed.groupBy("part").agg(F.min("doc_id")).collect())  # a row per range
    follows = {b[0]: a[0] for a, b in zip([heads[-1], *heads[:-1]], heads)} if heads else {}
    whole = keyed.withColumn("halo", F.lit(0))
    before = F.create_map(*[F.lit(x) for kv in follows.items() for x in kv]) if follows else F.create_map(F.lit(0), F.lit(0))
    is_head = F.col("doc_id").isin([h[1] for h in heads if h[1] is not None]) | F.col("doc_id").isNull()
    firsts = keyed.filter(is_head).groupBy("part").agg(F.min_by(F.struct("doc_id", "text"), F.struct("doc_id", F.xxhash64("text"))).alias("row"))
    halo = firsts.select("row.doc_id", "row.text", F.element_at(before, F.col("part")).alias("part"), F.lit(1).alias("halo"))
    both = whole.select("doc_id", "text", "part", "halo").unionAll(halo)
    # a partition for each range, by its number: a hash would put several into one task and leave others empty
    both = both.repartitionById(len(cuts) + 2, F.col("part")).sortWithinPartitions("part", "halo", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, with its part
        out: list[tuple] = []

        def close(row: tuple, text: str) -> tuple:
            doc_id, own = row
            mine, other, edited = _with_edit(own, text, size)
            return doc_id, own, mine, other, sha256(edited.encode()).hexdigest()

        waiting = None  # a row whose fingerprint is known, that of the next isn't yet
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, text, part, halo = (batch.column(c)[i].as_py() for c in range(4))
                if held and held[2] == part:
                    done = close(held[:2], text)
                    if waiting:
                        out.append(_row(waiting, done[2], size))
                    waiting = done
                if halo:
                    if waiting:
                        out.append(_row(waiting, Parser().feed(text.encode()).sketch(size), size))
                    waiting = held = None
                else:
                    held = (doc_id, text, part)
                if len(out) >= 256:
                    yield _batch(out)
                    out = []
        yield _batch(out)

    return both.select("doc_id", "text", "part", "halo").mapInArrow(run, _SCHEMA)


_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(done: tuple, following: np.ndarray, size: int) -> tuple:
    doc_id, text, mine, other, sha = done
    return doc_id, len(text), sha, to_string(mine), to_string(other), likeness(mine, other, size), likeness(mine, following, size)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _range_sql(cuts: list[int]) -> str:
    """Number of cuts that are at most doc_id, by a binary search written as nested conditions."""
    def part(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"if(doc_id < {cuts[mid]}, {part(lo, mid)}, {part(mid + 1, hi)})"

    return part(0, len(cuts))
