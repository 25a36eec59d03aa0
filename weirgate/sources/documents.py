"""Files for intake (A1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_documents(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """Files under ``path`` as ``file_name, file_size_bytes, received_at, content``.

    ``content`` is only read by queries that use it, so a gate on name and size never touches the bytes.
    """
    reader = spark.readStream if stream else spark.read
    files = reader.format("binaryFile").options(**options).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("received_at"),
        "content",
    )
