"""Running values over long ordered histories without one huge window partition.

A key may own a third of all rows. Its history is cut into buckets: a window runs inside each (key, bucket), one
summary row per bucket carries the state from bucket to bucket, and the carried state is joined back. Both joins and
windows then work on pieces of bounded size, and the result equals one long window per key.

Every bucket of the rows has its summary, so the join back is an inner one: both sides then share the shuffle of the
rows. Key and time are never null in a history; rows without them have no place in it.

Buckets are spans of ``bucket_seconds``. Where a burst may put very many rows of a key into one span, or times are as
coarse as days, pass ``bucket_seconds=None``: rows are then cut by a range partitioning over key, time and tie, which
splits any run of rows into even pieces, and kept by a reliable checkpoint so that all parts of the plan see the same cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirgate.session import cut_lineage

BUCKET_SECONDS = 3600


def with_bucket(rows: DataFrame, key: str, at: str, tie: str, bucket_seconds: int | None) -> DataFrame:
    """Add the bucket of each row; buckets of a key follow its order."""
    if bucket_seconds is None:
        ranged = rows.repartitionByRange(key, at, tie)
        return cut_lineage(ranged.withColumn("_bucket", F.spark_partition_id().cast("bigint")))
    return rows.withColumn("_bucket", F.floor(F.unix_seconds(at) / F.lit(bucket_seconds)))


def previous_value(rows: DataFrame, key: str, at: str, tie: str, value: str, name: str,
                   bucket_seconds: int | None = BUCKET_SECONDS) -> DataFrame:
    """Value of the row before, per key in order of ``at, tie``; null for the first row."""
    cut = with_bucket(rows, key, at, tie, bucket_seconds)
    inside = Window.partitionBy(key, "_bucket").orderBy(at, tie)
    local = cut.withColumn("_position", F.row_number().over(inside)).withColumn(name, F.lag(value).over(inside))
    last = cut.groupBy(key, "_bucket").agg(F.max(F.struct(at, tie, value)).getField(value).alias("_last"))
    carried = last.select(key, "_bucket",
                          F.lag("_last").over(Window.partitionBy(key).orderBy("_bucket")).alias("_carried"))
    joined = local.join(carried, [key, "_bucket"])
    return joined.withColumn(
        name, F.when(F.col("_position") == 1, F.col("_carried")).otherwise(F.col(name))
    ).drop("_bucket", "_position", "_carried")


def streak_since_reset(rows: DataFrame, key: str, at: str, tie: str, is_reset: Column, name: str,
                       bucket_seconds: int | None = BUCKET_SECONDS, start: DataFrame | None = None) -> DataFrame:
    """Rows since the last reset row, per key in order of ``at, tie``; a reset row itself has 0.

    ``start`` (``key, start``) gives the streak each key begins with.
    """
    cut = with_bucket(rows, key, at, tie, bucket_seconds).withColumn("_counts", F.when(is_reset, 0).otherwise(1))
    inside = Window.partitionBy(key, "_bucket").orderBy(at, tie).rowsBetween(Window.unboundedPreceding, 0)
    running = cut.withColumn("_total", F.sum("_counts").over(inside)).withColumn(
        "_at_reset", F.max(F.when(F.col("_counts") == 0, F.col("_total"))).over(inside))
    # Per bucket: rows counted, and how many of them came after its last reset (null without a reset).
    bucket = running.groupBy(key, "_bucket").agg(
        F.sum("_counts").alias("_counted"), F.max("_at_reset").alias("_reset_total"))
    begin = F.lit(0)
    if start is not None:
        bucket = bucket.join(start.select(key, F.col("start").alias("_start")), key, "left")
        begin = F.coalesce("_start", F.lit(0))
    over_buckets = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    carry = bucket.withColumn("_sum", F.sum("_counted").over(over_buckets)).withColumn(
        "_sum_at_reset",
        F.max(F.when(F.col("_reset_total").isNotNull(), F.col("_sum") - F.col("_counted") + F.col("_reset_total")))
        .over(over_buckets))
    carry = carry.select(key, "_bucket", F.coalesce(
        F.lag(F.col("_sum") - F.coalesce(F.col("_sum_at_reset"), -begin)).over(
            Window.partitionBy(key).orderBy("_bucket")), begin).alias("_carried"))
    joined = running.join(carry, [key, "_bucket"])
    streak = F.when(F.col("_at_reset").isNotNull(), F.col("_total") - F.col("_at_reset")).otherwise(
        F.col("_total") + F.col("_carried"))
    return joined.withColumn(name, streak.cast("bigint")).drop(
        "_bucket", "_counts", "_total", "_at_reset", "_carried")
