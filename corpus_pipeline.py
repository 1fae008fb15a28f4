"""The training-corpus pipeline: five stages over whole tables, each on all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import decontam, mixing, simhash, suffix_dedup, toxicity
from folioforge.llm.common import stable, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels outside of the held-out fold."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    return simhash.drop_near_duplicates(docs)


def strip_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has go from the text; all documents stay."""
    return suffix_dedup.strip_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go, however long they are."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, each with its shard and rank."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", strip_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("mix_sources", mix_sources),
]

#: Not expressible: a trained model, XXH64 with a seed, hash-drawn blocks. See tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stable(docs)  # the next stage reads its input more than once
    return docs
