"""Token counts from an exact length histogram.

Each document is encoded once; only (encoded length, number of documents) leaves the
task, so the shuffle holds a few thousand pairs per partition whatever the texts weigh.
Suffix sums over that histogram then answer, for every context limit at once, the totals,
the quantiles and the totals after truncation.

Defined cases: a null or empty text has length 0; repeated rows count as often as they
occur; an empty table gives an empty histogram; other columns are never read.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.llm.common import stable

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published splitting pattern that belongs to the 50k byte-level vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Lengths a bucket of the two-level suffix sum spans.
SPAN = 4096


def _encoder(blob: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(token_length, n_docs): how many documents encode to exactly so many tokens.

    The vocabulary file is read once on the driver and broadcast (about 1 MB, fixed).
    """
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared.value, pattern).encode_ordinary
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen[len(encode(text.as_py() or ""))] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["token_length", "n_docs"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "token_length long, n_docs long")
    return counted.groupBy("token_length").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """For each length L that occurs, what a context limit of L means.

    docs_ge, tokens_ge: documents of at least L tokens and their tokens; docs_le: of at
    most L; kept_tokens: tokens left when each document is cut to L; lost_tokens: the
    others; quantile: share of documents of at most L. Between two lengths that occur,
    kept_tokens grows by docs_ge of the upper one for each step of the limit.
    The sums run in two levels, buckets of lengths and lengths within one, so no task
    gets more than SPAN rows plus one row per bucket.
    """
    h = stable(histogram).withColumn("bucket", F.floor(F.col("token_length") / SPAN))  # read twice below
    h = h.withColumn("tokens", F.col("n_docs") * F.col("token_length"))
    every = W.orderBy(F.col("bucket").desc())
    buckets = h.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    above = buckets.select(
        "bucket",
        (F.sum("d").over(every) - F.col("d")).alias("docs_above"),
        (F.sum("t").over(every) - F.col("t")).alias("tokens_above"),
        F.sum("d").over(W.partitionBy()).alias("all_docs"),
        F.sum("t").over(W.partitionBy()).alias("all_tokens"),
    )
    within = W.partitionBy("bucket").orderBy(F.col("token_length").desc())
    s = (
        h.join(above, "bucket")
        .withColumn("docs_ge", F.sum("n_docs").over(within) + F.col("docs_above"))
        .withColumn("tokens_ge", F.sum("tokens").over(within) + F.col("tokens_above"))
    )
    kept = F.col("all_tokens") - F.col("tokens_ge") + F.col("docs_ge") * F.col("token_length")
    docs_le = F.col("all_docs") - F.col("docs_ge") + F.col("n_docs")
    return s.select(
        "token_length",
        "n_docs",
        docs_le.alias("docs_le"),
        "docs_ge",
        "tokens_ge",
        kept.alias("kept_tokens"),
        (F.col("all_tokens") - kept).alias("lost_tokens"),
        (docs_le / F.col("all_docs")).alias("quantile"),
        F.col("all_docs").alias("total_docs"),
        F.col("all_tokens").alias("total_tokens"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, kept_tokens, lost_tokens, docs_cut) for any limits, exactly."""
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in limits], "context_limit long")
    # the shortest length above the limit tells how many documents the limit cuts
    joined = asked.join(sums, F.col("token_length") > F.col("context_limit"), "left")
    first = joined.groupBy("context_limit").agg(F.min_by(F.struct("docs_ge", "tokens_ge", "total_tokens"), "token_length").alias("s"))
    lost = F.coalesce(F.col("s.tokens_ge") - F.col("s.docs_ge") * F.col("context_limit"), F.lit(0))
    total = sums.agg(F.max("total_tokens").alias("total"))
    return first.crossJoin(F.broadcast(total)).select(  # one row, from a global aggregate
        "context_limit",
        (F.coalesce("total", F.lit(0)) - lost).alias("kept_tokens"),
        lost.alias("lost_tokens"),
        F.coalesce(F.col("s.docs_ge"), F.lit(0)).alias("docs_cut"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, token_length): the least length that at least that share of documents doesn't exceed."""
    asked = sums.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    return asked.join(sums, F.col("quantile") >= F.col("share")).groupBy("share").agg(F.min("token_length").alias("token_length"))
