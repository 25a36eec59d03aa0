"""Continuous intake, deduplication and age limits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from weirgate.functions.times import HOUR_MICROS
from weirgate.session import SETTINGS
from weirgate.sources.sinks import AppendOnceSink

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on disk and in the checkpoint folder rather than on the heap."""
    spark.conf.set(_PROVIDER, SETTINGS[_PROVIDER])


def stream_intake(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str | None = None,
                  **options: str) -> DataFrame:
    """A landing folder as a stream (I1): JSON, Parquet, text or binary files."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None and fmt not in ("binaryFile", "text"):
        reader = reader.schema(schema)
    return reader.load(path)


def stream_dedup(rows: DataFrame, key: str, at: str | None = None, horizon: str | None = None) -> DataFrame:
    """First row per key across all batches.

    Without a horizon every key ever seen stays in the state. With ``at`` and ``horizon`` the state is bounded, and a
    key that returns after the horizon counts as new: a different meaning, chosen by the caller.
    """
    use_rocksdb(rows.sparkSession)
    if horizon is None:
        return rows.dropDuplicates([key])
    return rows.withWatermark(at, horizon).dropDuplicatesWithinWatermark([key])


def stream_age_filter(rows: DataFrame, at: str, seen_at: Column, max_age_hours: int = 72) -> DataFrame:
    """Drop items older than the age limit when they arrive (I3), and let the watermark forget the same span."""
    age = F.unix_micros(seen_at) - F.unix_micros(at)
    return rows.withWatermark(at, f"{max_age_hours} hours").where(age <= F.lit(max_age_hours * HOUR_MICROS))


def run_batches(rows: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                every: str | None = None) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``handle``; without ``every`` it stops when all input is read."""
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def stream_append_once(rows: DataFrame, path: str, key: str, checkpoint: str,
                       every: str | None = None) -> StreamingQuery:
    """Append rows whose key is not stored yet (I6); repeated batches replace themselves."""
    return run_batches(rows, AppendOnceSink(path, key), checkpoint, every)
