"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets. Sources, ordered by code point with null last, weigh 5, 2, 1, 5, 2, 1, ... and
share all words of the corpus; no target passes `cap` times its source's words, and what
is above is shared again by weight among the others (water filling).

Blocks. A hash spreads each source's documents over blocks of some 64 documents, whose
numbers are a random permutation of the source. A source with target r times its words has
a quota of block draws: all of its blocks floor(r) times, and once more its first blocks, as
many as fit; the last of these is filled by those of its documents whose sizes add up
nearest to what is left.

Shards. A tree partitions the quotas among the output shards: a node deals its quotas per
source to its two halves by a multivariate hypergeometric draw, so that every shard gets a
composition as if all blocks had been shuffled, and whole numbers add up exactly. The leaf of
a shard draws its quota as a run of the source's permuted (pass, block) pairs, disjoint from
those of all others. What a document gives to the mix is what the shards drew of its block.
`mix` sends the rows to their shards and shuffles each shard locally.

Scale. Documents carry only (source, block, size) through the shuffles of the plan. The
driver holds one row per source and its quotas by shard; blocks and draws stay in Spark,
where the blocks of one source, at most `blocks`, are one group. Sources and draws are
broadcast within SMALL_PLAN rows and joined by shuffle beyond. A shard takes about
SHARD_WORDS words, so their number grows with the mix.

Defined cases: a null text has size 0; null sources are one source; a source without words
has target 0 and takes nothing; an empty table gives an empty mix; repeated rows are mixed
row by row; reruns agree, however rows are partitioned; other columns are not read by
`plan` and are carried by `mix`, but for those with the names of its own (MIX_COLUMNS),
which it replaces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.llm.common import stable

WEIGHTS = (5, 2, 1)
CAP, SEED, BLOCKS, BLOCK_DOCS = 3, 17, 1 << 14, 64
#: Least number of output shards, and words of a shard beyond it.
SHARDS, SHARD_WORDS = 16, 1 << 23
#: Rows of a plan that is broadcast (some 50 bytes each).
SMALL_PLAN = 500_000
MIX_COLUMNS = ("mix_copy", "mix_shard", "mix_rank")


def word_count(text: Column) -> Column:
    r"""Number of runs of characters other than 0x20 and 0x09-0x0D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> list[float]:
    """Water filling over sources in their order."""
    share = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s], float(sum(sizes))
    while open_:
        level = left / sum(share[i] for i in open_)
        over = [i for i in open_ if share[i] * level > cap * sizes[i]]
        if not over:
            for i in open_:
                out[i] = share[i] * level
            break
        for i in over:
            out[i] = float(cap * sizes[i])
        left = float(sum(sizes)) - sum(out)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources): exact block quotas of each shard, dealt down a binary tree."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    total = int(quotas.sum())
    want = total * left // shards
    half = np.zeros_like(quotas)
    rest, need = total, want
    for i, q in enumerate(quotas.tolist()):  # a multivariate draw, one source after the other
        got = int(rng.hypergeometric(q, rest - q, need)) if need and q else 0
        half[i] = got
        rest, need = rest - q, need - got
    return np.vstack([split_quotas(half, left, rng), split_quotas(quotas - half, shards - left, rng)])


def _keyed(docs: DataFrame, seed: int) -> DataFrame:
    source = F.col("source").cast("string")
    return docs.withColumns({
        "_size": word_count(F.col("text")),
        "_none": source.isNull(),
        "_source": F.coalesce(source, F.lit("")),
        "_hash": F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), "text"),
    })


def _draw(seed: int):
    """A leaf's draws: each shard takes the next run of its source's permuted (pass, block) pairs."""

    def run(blocks: pd.DataFrame, leaves: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("block")
        passes = int(blocks["passes"].iloc[0]) if len(blocks) else 0
        turns = [blocks.assign(copy=p, partly=False) for p in range(passes)] + [blocks[blocks["again"]].assign(copy=passes)]
        pairs = pd.concat(turns)[["none", "source", "block", "copy", "partly", "left"]]
        own = [seed, zlib.crc32(str(blocks["source"].iloc[0]).encode()), int(blocks["none"].iloc[0])] if len(blocks) else seed
        pairs = pairs.iloc[np.random.default_rng(own).permutation(len(pairs))]
        leaves = leaves.sort_values("shard")
        return pairs.assign(shard=np.repeat(leaves["shard"].to_numpy(), leaves["quota"].to_numpy()))

    return run


class Plan(NamedTuple):
    """documents: doc_id, size, hash, none, source, block, source_size, target and draws (copy, shard
    of each draw that has the document); sources: none, source, blocks, source_size, target, passes,
    rest; draws: none, source, block, copy, partly, left, shard; fits: the documents that partly drawn
    blocks give; n_draws."""

    documents: DataFrame
    sources: DataFrame
    draws: DataFrame
    fits: DataFrame
    n_draws: int
    small: Callable[[DataFrame, int], DataFrame]


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, blocks: int = BLOCKS, block_docs: int = BLOCK_DOCS, shards: int | None = None, seed: int = SEED) -> Plan:
    """A block has about block_docs documents, unless a source would get more than `blocks`."""
    spark = docs.sparkSession

    def small(df: DataFrame, n: int) -> DataFrame:
        return F.broadcast(df) if n <= SMALL_PLAN else df

    keyed = _keyed(docs.select("doc_id", "text", "source"), seed)
    own = stable(keyed.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_size").alias("size"), F.col("_hash").alias("hash"), F.col("_none").alias("none"), F.col("_source").alias("source")))
    found = own.groupBy("none", "source").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()  # a row per source
    found.sort(key=lambda r: (r["none"], r["source"]))  # by code point; null last
    sizes = [r["size"] for r in found]
    goal = targets(sizes, weights, cap)
    passes = [int(t // s) if s else 0 for s, t in zip(sizes, goal)]
    rows = [(r["none"], r["source"], max(1, min(blocks, r["n"] // block_docs)), s, t, p, round(t) - p * s) for r, s, t, p in zip(found, sizes, goal, passes)]
    sources = spark.createDataFrame(rows, "none boolean, source string, blocks int, source_size long, target double, passes int, rest long")
    key = ["none", "source"]
    own = own.join(small(sources, len(rows)), key).withColumn("block", F.pmod("hash", F.col("blocks")).cast("int"))
    sums = own.groupBy(*key, "block", "passes", "rest").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(W.partitionBy(*key).orderBy("block")) - F.col("words")
    again = (F.col("before") < F.col("rest")).alias("again")
    partly = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
    sums = stable(sums.withColumn("before", before).select(*key, "block", "passes", again, partly.alias("partly"), F.when(partly, F.col("rest") - F.col("before")).alias("left")))
    counted = sums.groupBy(*key).agg(F.sum(F.col("passes") + F.col("again").cast("int")).alias("q")).collect()  # a row per source
    quota = {(r["none"], r["source"]): r["q"] for r in counted}
    quotas = np.array([quota[r["none"], r["source"]] for r in found], np.int64)
    shards = shards or max(SHARDS, int(sum(goal)) // SHARD_WORDS)
    dealt = split_quotas(quotas, shards, np.random.default_rng(seed)) if len(quotas) else np.zeros((shards, 0), np.int64)
    leaves = [(found[i]["none"], found[i]["source"], s, int(dealt[s, i])) for i, s in zip(*(x.tolist() for x in np.nonzero(dealt.T)))]
    leaves = spark.createDataFrame(leaves, "none boolean, source string, shard int, quota long")
    wanted = sums.filter("passes > 0 or again")
    draws = stable(wanted.groupBy(*key).cogroup(leaves.groupBy(*key)).applyInPandas(_draw(seed), "none boolean, source string, block int, copy int, partly boolean, left long, shard int"))
    n_draws = int(quotas.sum())

    each = draws.groupBy(*key, "block").agg(F.array_sort(F.collect_list(F.when(~F.col("partly"), F.struct("copy", "shard")))).alias("draws"), F.max(F.when(F.col("partly"), F.struct("left", "copy", "shard"))).alias("edge"))
    of_block = own.join(small(each, n_draws), [*key, "block"], "left")
    kept = ["doc_id", "size", "hash", *key, "block", "source_size", "target"]
    none = F.array().cast("array<struct<copy:int,shard:int>>")
    whole = of_block.filter("edge is null").select(*kept, F.coalesce("draws", none).alias("draws"))
    fits = stable(_fill(of_block.filter("edge is not null").select(*kept, "draws", F.col("edge.left").alias("left"), F.struct("edge.copy", "edge.shard").alias("last"))))
    filled = fits.select(*kept, F.when(F.col("fits"), F.concat("draws", F.array("last"))).otherwise(F.col("draws")).alias("draws"))
    return Plan(whole.unionByName(filled), sources, draws, fits.filter("fits"), n_draws, small)


def nearest_subset(sizes: list[int], goal: int, tail: int = BLOCK_DOCS) -> list[bool]:
    """Which sizes to take: in order while they fit, and of the last `tail` those whose sum comes
    nearest to what is left (sums as bits of a number, a step per size)."""
    fits, left = [], goal
    for size in sizes[:-tail]:
        fits.append(size <= left)
        left -= size * fits[-1]
    last = sizes[-tail:]
    within = (1 << min(2 * left, sum(last)) + 1) - 1
    reach = [1]
    for size in last:
        reach.append(reach[-1] | (reach[-1] << size & within))
    low = (reach[-1] & (1 << left + 1) - 1).bit_length() - 1
    above = reach[-1] >> left
    high = left + (above & -above).bit_length() - 1 if above else 2 * left + 1
    at = high if high - left < left - low else low
    take = []
    for size, before in zip(last[::-1], reach[-2::-1]):
        own = not before >> at & 1
        take.append(own)
        at -= size * own
    return fits + take[::-1]


def _fill(edge: DataFrame) -> DataFrame:
    """Adds fits: which documents of a source's last block fill what is left; one block per source."""

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["hash", "doc_id", "size"], kind="stable")
        return group.assign(fits=nearest_subset(group["size"].tolist(), int(group["left"].iloc[0])))

    narrow = edge.select("doc_id", "size", "hash", "none", "source", "block", "left").groupBy("none", "source")
    fits = narrow.applyInPandas(fill, "doc_id long, size long, hash long, none boolean, source string, block int, left long, fits boolean")
    block = edge.groupBy("none", "source").agg(*[F.first(c).alias(c) for c in ("source_size", "target", "draws", "last")])
    return fits.join(block, ["none", "source"])


def mix_report(docs: DataFrame) -> DataFrame:
    """The digest per document that the query returns: taken is its size times the shards' draws of
    it, and shards lists the shard of each draw."""
    own = plan(docs).documents
    return own.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"), F.array_sort("draws.shard").alias("shards"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, blocks: int = BLOCKS, block_docs: int = BLOCK_DOCS, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mixed corpus: the columns of docs, and mix_copy, mix_shard, mix_rank (order within the shard).

    A document comes once for each draw that has it. The rows of a shard lie together, in the
    order of its own shuffle.
    """
    names = [c for c in docs.columns if c.lower() not in MIX_COLUMNS]
    p = plan(docs, weights, cap, blocks, block_docs, shards, seed)
    of = p.sources.select(F.col("none").alias("_none"), F.col("source").alias("_source"), F.col("blocks").alias("_blocks"))
    keyed = _keyed(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id", "text", "source"), seed).drop("_size")
    keyed = keyed.join(p.small(of, p.n_draws), ["_none", "_source"]).withColumn("_block", F.pmod("_hash", F.col("_blocks")).cast("int"))
    keyed = keyed.select("row", F.col("doc_id").cast("long").alias("_id"), "_none", "_source", "_hash", "_block")
    draws = p.draws.select(F.col("none").alias("_none"), F.col("source").alias("_source"), F.col("block").alias("_block"), F.col("copy").alias("mix_copy"), F.col("shard").alias("mix_shard"), "partly")
    each = keyed.join(p.small(draws, p.n_draws), ["_none", "_source", "_block"])
    # of a source's last block only the documents that fit are taken; equal rows by their number
    fits = p.fits.select(F.col("none").alias("_none"), F.col("source").alias("_source"), F.col("hash").alias("_hash"), F.coalesce("doc_id", F.lit(0)).alias("_key"), F.col("doc_id").isNull().alias("_null"))
    keys = ["_none", "_source", "_hash", "_key", "_null"]
    edge = each.filter("partly").withColumns({"_key": F.coalesce("_id", F.lit(0)), "_null": F.col("_id").isNull()})
    edge = edge.withColumn("_twin", F.row_number().over(W.partitionBy(*keys).orderBy("_hash")))
    edge = edge.join(fits.groupBy(*keys).agg(F.count("*").alias("_n")), keys).filter("_twin <= _n")
    kept = [F.col(f"row.`{c}`").alias(c) for c in names]
    rest = ["mix_copy", "mix_shard", F.xxhash64(F.lit(seed + 1), "_hash", "mix_copy").alias("mix_rank")]
    rows = each.filter("not partly").select(*kept, *rest).unionAll(edge.select(*kept, *rest))
    return rows.repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_rank", "mix_copy")
