"""SimHash near-duplicates, searched through a Gray-order hierarchical index.

Fingerprints: majority bits over the XXH64 values of all word shingles. Equal
fingerprints collapse first, so a hot group of copies is one node afterwards.

Links (at most `radius` differing bits): with the 64 bits cut into b blocks, two such
fingerprints agree on at least b - radius blocks, so rows meet in the bucket of some
choice of b - radius blocks. b grows with the number of fingerprints to keep buckets
small. A bucket that stays hot is cut again by its other bits, by the same rule, so no
bucket is capped and no pair is lost. Within a bucket the fingerprints are sorted by Gray
rank; consecutive runs share masked bit patterns, which are factored into upper nodes;
a search adds up the differences on its way down and leaves a node, with all below it,
when they exceed the radius. A bucket returns spanning edges, never all of its pairs.

Components: large-star and small-star contraction until nothing changes.

Defined cases: null and empty texts have fingerprint zero and link like any other; a
component of null ids only has a null component_id; repeated rows are repeated; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import U64, id_and_bytes, stable

SEED, SHINGLE, RADIUS = 42, 4, 4
#: Fingerprints that a bucket holds before its other bits divide it again, and on average.
HOT, MEAN = 1 << 16, 2048
FANOUT = 8


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of a whole text (UTF-8)."""
    from xxhash import xxh64_intdigest

    w = (text or b"").lower().split()  # bytes: A-Z only, and splits at 0x20 and 0x09-0x0D
    if not w:
        return 0
    norm = b" ".join(w)
    if len(w) <= shingle:
        return xxh64_intdigest(norm, SEED)
    lengths = np.fromiter(map(len, w), np.int64, len(w))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(w) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    n, ones = len(starts), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        h = np.array([xxh64_intdigest(norm[a:b], SEED) for a, b in zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return id_and_bytes(docs).mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- the index


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    r = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> U64(s)
    return r


class GrayIndex:
    """Codes in Gray order under a hierarchy of shared bit patterns.

    A node's mask has the bits on which all codes below it agree and that no node above
    it has; the differences of a query from the patterns add up along a path.
    """

    def __init__(self, codes: np.ndarray, fanout: int = FANOUT) -> None:
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.fanout = fanout
        both = either = codes[self.order]
        levels = [(both, either)]
        while len(both) > fanout:
            cuts = np.arange(0, len(both), fanout)
            both, either = np.bitwise_and.reduceat(both, cuts), np.bitwise_or.reduceat(either, cuts)
            levels.append((both, either))
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # from the root down: (mask, pattern)
        above = None
        for both, either in reversed(levels):
            agreed = ~(both ^ either)
            mask = agreed if above is None else agreed & ~np.repeat(above, fanout)[: len(agreed)]
            self.levels.append((mask, both & mask))
            above = agreed

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, code number) of all pairs at most radius bits apart."""
        mask, pattern = self.levels[0]
        q = np.repeat(np.arange(len(queries)), len(mask))
        node = np.tile(np.arange(len(mask)), len(queries))
        spent = np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
        for mask, pattern in self.levels[1:]:
            near = spent <= radius
            q, node, spent = q[near], node[near], spent[near]
            q, spent = np.repeat(q, self.fanout), np.repeat(spent, self.fanout)
            node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
            real = node < len(mask)
            q, node, spent = q[real], node[real], spent[real]
            spent = spent + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
        near = spent <= radius
        return q[near], self.order[node[near]]


def spanning_labels(codes: np.ndarray, radius: int, block: int = 256) -> np.ndarray:
    """For each code the number of one code in its component, over links within radius."""
    label = np.arange(len(codes))

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = i = label[label[i]]
        return i

    index = GrayIndex(codes)
    for at in range(0, len(codes), block):
        i, j = index.search(codes[at : at + block], radius)
        i += at
        apart = label[i] != label[j]
        for a, b in zip(i[apart].tolist(), j[apart].tolist()):
            a, b = root(a), root(b)
            if a != b:
                label[max(a, b)] = min(a, b)
        while (up := label[label]).tobytes() != label.tobytes():
            label = up
    return label


def _scheme(n: int, radius: int) -> tuple[list[list[int]], list[int]]:
    """Choices of blocks, as lists of block numbers, and the limits of the blocks."""
    for blocks in range(radius + 1, radius + 5):
        agree = blocks - radius
        if n / 2 ** (64 * agree // blocks) <= MEAN:
            break
    limits = [64 * i // blocks for i in range(blocks + 1)]
    return [list(c) for c in combinations(range(blocks), agree)], limits


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _buckets(fps: DataFrame, radius: int) -> DataFrame:
    """(b1, k1, b2, k2, fp): rows of one bucket share the first four; b2 is -1 unless it was hot."""
    n = fps.count()
    choices, limits = _scheme(n, radius)
    masks = [sum(((1 << (limits[b + 1] - limits[b])) - 1) << limits[b] for b in c) for c in choices]
    once = fps.select(
        F.explode(F.array(*[F.struct(F.lit(i).alias("b1"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k1")) for i, m in enumerate(masks)])).alias("x"), "fp"
    ).select("x.b1", "x.k1", "fp")
    sizes = once.groupBy("b1", "k1").count().filter(F.col("count") > HOT).select("b1", "k1", F.lit(True).alias("hot"))
    if n <= HOT or sizes.isEmpty():
        return once.select("b1", "k1", F.lit(-1).alias("b2"), F.lit(0).cast("long").alias("k2"), "fp")
    # the bits outside of the shared blocks differ in at most radius places: cut them again
    again = []
    for m in masks:
        rest = [b for b in range(64) if not m >> b & 1]
        parts = [rest[i * len(rest) // (radius + 1) : (i + 1) * len(rest) // (radius + 1)] for i in range(radius + 1)]
        again.append([sum(1 << b for b in p) for p in parts])
    nested = F.array(*[F.array(*[F.lit(_signed(x)) for x in p]) for p in again])
    own = F.element_at(nested, F.col("b1") + 1)
    cut = F.transform(own, lambda m, i: F.struct(i.alias("b2"), F.col("fp").bitwiseAND(m).alias("k2")))
    whole = F.array(F.struct(F.lit(-1).alias("b2"), F.lit(0).cast("long").alias("k2")))
    return (
        once.join(sizes, ["b1", "k1"], "left")
        .select("b1", "k1", F.explode(F.when(F.col("hot"), cut).otherwise(whole)).alias("x"), "fp")
        .select("b1", "k1", "x.b2", "x.k2", "fp")
    )


def _runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[np.ndarray]:
    """The last column of each run of equal keys in sorted input, however batches cut it."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys + 1)]
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for c in cols[:n_keys]:
            new[1:] |= c[1:] != c[:-1]
        cuts = np.flatnonzero(new).tolist() + [batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in cols[:n_keys])
            if key != held_key and held:
                yield np.concatenate(held)
                held = []
            held_key = key
            held.append(cols[-1][a:b])
    if held:
        yield np.concatenate(held)


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b), a > b: edges that join all distinct fingerprints within radius; fps: (fp), distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes in _runs(batches, 4):
            if len(codes) < 2:
                continue
            label = spanning_labels(codes.view(np.uint64), radius)
            other = codes[label]
            apart = other != codes
            if apart.any():
                a, b = codes[apart], other[apart]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    keys = ["b1", "k1", "b2", "k2"]
    buckets = _buckets(fps, radius).repartition(*keys).sortWithinPartitions(*keys)
    return buckets.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(a, root) for each node of the edges (a > b), root its component's least node."""
    star = stable(edges)
    state = None
    for _ in range(max_rounds):
        both = star.select("a", "b").union(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: a node's greater neighbours move to the least of its neighbourhood
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its lesser neighbours move to the least of these
        low = large.filter("a > b")
        least = low.groupBy("a").agg(F.min("b").alias("m"))
        small = low.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        star = stable(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        now = star.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components didn't settle within {max_rounds} rounds")
    return star.select("a", F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): one row per document with the least doc_id of its component."""
    by_doc = stable(fingerprints(docs, shingle))
    nodes = by_doc.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("fp"), radius))
    member = nodes.join(roots, nodes.fp == roots.a, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = member.join(least, "root").select("fp", "component_id")
    return by_doc.join(classes, "fp").select("doc_id", "fp", "component_id")


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    """The digest per document that the query returns."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component stays, that of its least doc_id (of repeated ids, the first by text).

    Documents without an id can't be told apart: they stay unless an id represents them,
    one for each distinct text.
    """
    names = docs.columns
    found = near_duplicates(docs, shingle, radius)
    kept = found.filter("doc_id = component_id").select("doc_id").distinct()
    others = [c for c in names if c not in ("doc_id", "text")]
    first = F.min(F.struct(F.col("text"), *[F.col(f"`{c}`") for c in others])).alias("row")
    # the join has the rows by doc_id already: the aggregation needs no further shuffle
    stay = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(first).select("doc_id", "row.*")
    # rows without an id whose component has one go with it
    lone = docs.filter("doc_id is null").dropDuplicates(["text"])
    if lone.isEmpty():
        return stay.select(*names)
    own = fingerprints(lone, shingle).filter("fp is not null").select("fp").distinct()
    alone = found.filter("component_id is null").select("fp").distinct().join(own, "fp", "left_semi")
    keyed = lone.select(F.struct(*names).alias("row"), F.col("text")).withColumn("doc_id", F.xxhash64("text"))
    with_fp = fingerprints(keyed, shingle).withColumnRenamed("doc_id", "key").join(alone, "fp", "left_semi")
    back = keyed.join(with_fp.select("key").distinct(), F.col("doc_id") == F.col("key"), "left_semi")
    return stay.select(*names).unionByName(back.select("row.*").select(*names))
