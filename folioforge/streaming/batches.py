"""Staged files in numbered batches: each batch's nodes to an output of its own, its files to the archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import basename, decode_bytes
from folioforge.sources.html import html_nodes, html_rejects, parsed_pages

_FILE = "path string, modificationTime timestamp, length long, content binary"


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a file of any Hadoop file system; False if the source is gone, as when a batch runs again."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(source)):
        return False
    fs.mkdirs(path(target).getParent())
    if not fs.rename(path(source), path(target)):
        raise OSError(f"{source} can't be moved to {target}")
    return True


def exists(spark: SparkSession, at: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(at).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(at))


def parse_staged(spark: SparkSession, staging: str, output: str, checkpoint: str, pattern: str, stamp: str, mapping: DataFrame | None = None, archive: str | None = None, size: int = 500) -> list[str]:
    """Parses staged files that this checkpoint has not seen, `size` to a batch; returns what it wrote.

    A batch writes parsed_<pattern>_<stamp>_batch<number>.jsonl, unless it has no nodes, and its
    rejects beside it; then its files move to the archive. A batch that runs again after a
    failure overwrites its own output and moves what is left. mapping (filename, cis) is joined
    before contents are decoded.
    """
    written: list[str] = []

    def handle(batch: DataFrame, number: int) -> None:
        files = batch.withColumn("filename", basename(F.col("path"))).filter(F.col("filename").startswith(pattern) & F.col("filename").rlike(r"\.html?$"))
        known = files.join(mapping.select("filename", "cis"), "filename") if mapping is not None else files.withColumn("cis", F.regexp_extract("filename", r"(\d+)", 1))
        parsed = parsed_pages(known.select(F.concat_ws("|", "cis", "filename").alias("doc"), decode_bytes(F.col("content")).alias("html")), "doc").persist()
        at = f"{output}/parsed_{pattern}_{stamp}_batch{number + 1:03d}.jsonl"
        if not html_rejects(parsed).isEmpty():
            html_rejects(parsed).write.mode("overwrite").json(f"{at}.rejects")
        if not parsed.filter("size(elements) > 0").isEmpty():
            html_nodes(parsed, "doc").write.mode("overwrite").json(at)
            written.append(at)
        parsed.unpersist()
        if archive:
            for r in files.select("path", "filename").toLocalIterator():  # `size` names at most
                move(batch.sparkSession, r["path"], f"{archive}/{r['filename']}")

    stream = spark.readStream.format("binaryFile").schema(_FILE).option("maxFilesPerTrigger", size).load(staging)
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return written
