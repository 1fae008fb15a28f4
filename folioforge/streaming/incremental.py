"""Incremental loads: new files once each, upserted by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioforge.operators.load import upsert


def run_available(spark: SparkSession, source: str, schema: str, checkpoint: str, handle: Callable[[DataFrame, int], None], fmt: str = "parquet", **options) -> None:
    """Runs all files not seen by this checkpoint through handle(batch, number), then stops."""
    stream = spark.readStream.format(fmt).schema(schema).options(**options).load(source)
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest of the folders that upsert_into() keeps."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    return spark.read.parquet(f"{path}/v={max(int(f.getPath().getName().partition('=')[2]) for f in listed)}")


def upsert_into(path: str, keys: list[str], order: list[str]) -> Callable[[DataFrame, int], None]:
    """A handler that keeps one folder per batch number, so that a batch that runs again replaces its own work.

    The folder before the last one goes once a batch is done, as no batch can need it again.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number:
            before = spark.read.parquet(f"{path}/v={number - 1}")
            after = upsert(before, batch.select(*before.columns), keys, order)
        else:
            after = upsert(batch.limit(0), batch, keys, order)
        after.write.mode("overwrite").parquet(f"{path}/v={number}")
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v={number - 2}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)

    return handle
