"""Quality by importance resampling with hashed n-gram models.

Words and pairs of words are hashed to `buckets` numbers. Two bag-of-n-grams models are
counted: one of good texts (labelled quality 1) and one of all raw texts. A document's log
importance weight is the sum over its n-grams of log p_good - log p_raw; the sample without
replacement, with chances in proportion to the weights, is that of the greatest sums of log
weight and Gumbel noise (Gumbel top-k).

Sums grow with length, and a long text's weight would drown the noise and all short ones, so
they are divided by the root of the number of n-grams (length_power 0.5; 0 is the plain sum).
The number to draw is `share` of the rows; by default the share of good ones among the
labelled texts, i.e. what a filter that knew all labels would keep.

Scale. Raw counts are over all texts: each task adds up a vector of `buckets` numbers, and the
vectors are summed by bucket in a shuffle; what reaches the driver is one vector per model,
a bounded size. Good texts are at most `sample` labelled ones, by hash of id. The k-th
greatest sum is found by counting: 4 passes of 65,536 counts at most over a narrow table,
instead of a sort.

Defined cases: null and empty texts have weight 0; labels other than 0 and 1 are ignored;
without good labels all weights are 0 and the sample is uniform; repeated rows get equal sums
and enter together, in the order of ids, as far as k goes; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.llm.common import id_and_bytes, mix64, stable

BUCKETS = 1 << 17
#: Labelled good texts that the target model is fitted to at most.
SAMPLE = 20_000
SEED = 11
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\s0-9a-z\x80-\xff]")


def ngrams(text: bytes | None, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket numbers of a text's words and pairs of words; punctuation marks are words."""
    tokens = _TOKEN.findall((text or b"").lower())
    h = np.fromiter(map(crc32, tokens), np.uint64, len(tokens))
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    return (mix64(np.concatenate([h, pairs])) % np.uint64(buckets)).astype(np.int64)


def _counts(docs: DataFrame, good: list[int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """n-gram counts of all texts and of those with good ids."""
    shared = docs.sparkSession.sparkContext.broadcast(frozenset(good))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                g = ngrams(text.as_py(), buckets)
                for into in (raw, target) if doc_id in shared.value else (raw,):
                    np.add.at(into, g, 1)
        some = np.flatnonzero(raw)
        for at in range(0, len(some), 10_000):
            s = some[at : at + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(raw[s]), pa.array(target[s])], names=["bucket", "raw", "target"])

    sums = id_and_bytes(docs).mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in sums.collect():  # one row per bucket at most
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return raw, target


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """(log ratio of each bucket, share of good texts among the labelled)."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    share = usable.agg(F.avg("quality")).first()[0]
    good = usable.filter("quality = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    raw, target = _counts(docs, [r[0] for r in good.collect()], buckets)
    if not target.sum():
        return np.zeros(buckets), 1.0 if share is None else float(share)
    # a bucket that the target's sample hardly saw is drawn towards the raw model
    prior = raw / raw.sum() * 50
    ratio = np.log((target + prior * target.sum() / raw.sum() + 1e-9) / (target.sum() + (prior * target.sum() / raw.sum()).sum())) - np.log((raw + 1e-9) / raw.sum())
    return np.where(raw > 0, ratio, 0.0), float(share)


def weights(docs: DataFrame, ratio: np.ndarray, length_power: float = 0.5, seed: int = SEED) -> DataFrame:
    """(doc_id, n_ngrams, log_weight, draw): draw is the weight with Gumbel noise, the same in each run."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch in batches:
            n, w = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(1)):
                g = ngrams(text.as_py(), len(ratio))
                n[i] = len(g)
                w[i] = float(ratio[g].sum(dtype=np.float64)) / max(1, len(g)) ** length_power
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n), pa.array(w)], names=["doc_id", "key", "n_ngrams", "log_weight"])

    keyed = id_and_bytes(docs).withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "text"))
    out = keyed.mapInArrow(run, "doc_id long, key long, n_ngrams long, log_weight double")
    uniform = (F.shiftrightunsigned(F.col("key"), 11).cast("double") + 0.5) / float(1 << 53)
    return out.withColumn("draw", F.col("log_weight") - F.log(-F.log(uniform))).drop("key")


def top_k(rows: DataFrame, k: int, by: str, tie: str) -> DataFrame:
    """The k rows with the greatest `by`, ties by the least `tie`: exact, without a global sort.

    `by` is taken in millionths, 16 bits a pass from the top: the counts tell where the k-th
    lies, so 4 passes leave only the rows at the limit to be ranked.
    """
    micro = F.round(F.col(by) * 1_000_000).cast("long") + F.lit(1 << 62)
    keyed = rows.withColumn("_key", micro)
    above, left = F.lit(False), k
    here = F.lit(True)
    for shift in (48, 32, 16, 0):
        digit = F.shiftright(F.col("_key"), shift).bitwiseAND(0xFFFF)
        counts = sorted(((r[0], r[1]) for r in keyed.filter(here).groupBy(digit.alias("d")).count().collect()), reverse=True)
        for d, n in counts:
            if n >= left:
                above = above | (here & (digit > d))
                here = here & (digit == d)
                break
            left -= n
        else:
            return rows  # fewer than k
    edge = keyed.filter(here).withColumn("_rank", F.row_number().over(W.orderBy(F.col(by).desc(), F.col(tie).asc_nulls_last())))
    return keyed.filter(above).select(*rows.columns).unionAll(edge.filter(F.col("_rank") <= left).select(*rows.columns))


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, buckets: int = BUCKETS, sample: int = SAMPLE, length_power: float = 0.5, seed: int = SEED) -> DataFrame:
    """The drawn documents: doc_id, n_ngrams, log_weight, draw."""
    ratio, good = fit(docs, labels, buckets, sample)
    scored = stable(weights(docs, ratio, length_power, seed))
    k = round(scored.count() * (good if share is None else share))
    return top_k(scored, k, "draw", "doc_id") if k else scored.limit(0)

