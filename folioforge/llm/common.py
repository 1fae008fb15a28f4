"""Helpers that several operators share: stable storage, hashing, byte access."""

from __future__ import annotations

import atexit
import ctypes
import re
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stable(df: DataFrame, partitioned: bool = False) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder that all executors share.

    partitioned: later groupings by the keys of df's last repartition() shuffle nothing; only
    a plan that isn't adaptive tells its partitioning, so that is off for this one job.

    The folder is the session's spark.checkpoint.dir. Without one a session in one process, as
    in tests, gets a folder of its own, which goes with the process; a cluster is refused, as its
    executors share no local folder.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            own = tempfile.mkdtemp(prefix="folioforge-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            shared = f"file://{own}"
        context.setCheckpointDir(shared)
    if not partitioned:
        return df.checkpoint()
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    adaptive = conf.get(key)
    conf.set(key, "false")
    try:
        return df.select("*").checkpoint()
    finally:
        conf.set(key, adaptive)


def id_and_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id long, text binary): null texts become empty, other columns are left behind."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )


def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch, one Python value at a time, so that only one text is copied at once."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def rows_of_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


U64 = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64), element by element."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def give_back() -> None:
    """Returns freed memory to the system, so that a worker that waits for its next task holds little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not with this C library
        pass
