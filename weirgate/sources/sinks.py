"""Append-only tables and versioned tables on plain files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirgate.sources.generations import KeyIndex


def append_rows(rows: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Append to a Parquet table. The caller passes a projection with the table's contract columns."""
    writer = rows.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """Outbound message rows (A11): sending happens elsewhere."""
    append_rows(messages.select("channel", "request_id", "text"), path)


def write_version(rows: DataFrame, path: str, version: int) -> str:
    """Write one full version of a mutable table; readers switch by version, so a lost job leaves no half state."""
    target = f"{path}/version={version}"
    rows.write.mode("overwrite").parquet(target)
    return target


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    """Read one version of a mutable table."""
    return spark.read.parquet(f"{path}/version={version}")


def append_once(batch: DataFrame, path: str, key: str, batch_id: int) -> None:
    """Append the rows of a micro-batch whose key is not stored yet.

    The batch writes its own ``batch=<id>`` folder in overwrite mode and looks only at earlier batches, so a repeated
    batch replaces itself. Keys repeated inside the batch keep one row (first by key, combined before the shuffle).
    """
    spark = batch.sparkSession
    fresh = batch.dropDuplicates([key])
    if batch_id > 0 and _exists(spark, path):
        stored = spark.read.option("basePath", path).parquet(path).where(F.col("batch") < batch_id).select(key)
        fresh = fresh.join(stored, key, "left_anti")
    fresh.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


class AppendOnceSink:
    """``foreachBatch`` handler that appends rows whose key is not stored yet (I6), by an index of the stored keys.

    Rows go to ``path/batch=<n>``, the index to ``path/_keys``. A batch opens the buckets of the index that its keys fall
    into and nothing of the stored rows, so what it reads does not grow with the table. A repeated batch gives the same files. Of the rows of a
    key inside a batch one is kept; rows without a key are kept once a batch.
    """

    def __init__(self, path: str, key: str, buckets: int = 16, fanout: int = 4) -> None:
        self.path, self.key = path, key
        self.index = KeyIndex(f"{path}/_keys", key, buckets, fanout)

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, target = batch.sparkSession, f"{self.path}/batch={number}"
        self.index.forget(spark, number)
        self.index.fresh(batch.dropDuplicates([self.key]), number).write.mode("overwrite").parquet(target)
        written = spark.read.schema(batch.schema).parquet(target)
        self.index.add(written.where(F.col(self.key).isNotNull()).select(self.key), number)


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)
