"""Delivery progress and retries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from weirgate import constants as C
from weirgate.operators.intake import difference

PART_KEY = ["digest_id", "part_number"]


def part_progress(attempts: DataFrame) -> DataFrame:
    """Per digest part: attempts so far, last attempt number, next attempt number (E5), sent or not."""
    return attempts.groupBy(*PART_KEY).agg(
        F.count(F.lit(1)).alias("attempts"), F.max("attempt_number").alias("last_attempt"),
        F.coalesce(F.bool_or(F.col("status") == "sent"), F.lit(False)).alias("sent"),
    ).withColumn("next_attempt", F.col("last_attempt") + 1)


def delivery_progress(parts: DataFrame, attempts: DataFrame) -> DataFrame:
    """Per digest: parts in total, parts sent, most attempts on one part, delivered or not."""
    progress = part_progress(attempts).select(*PART_KEY, "sent", "last_attempt")
    joined = parts.select(*PART_KEY).join(progress, PART_KEY, "left")
    return joined.groupBy("digest_id").agg(
        F.count(F.lit(1)).alias("parts_total"), F.count_if("sent").alias("parts_sent"),
        F.coalesce(F.max("last_attempt"), F.lit(0)).alias("max_attempt"),
    ).withColumn("delivered", F.col("parts_sent") == F.col("parts_total"))


def unsent_parts(parts: DataFrame, attempts: DataFrame) -> DataFrame:
    """Parts without a successful attempt."""
    return difference(parts, attempts.where(F.col("status") == "sent"), PART_KEY)


def with_trials(attempts: DataFrame, max_trials: int = 3) -> DataFrame:
    """``trial`` of each attempt from the log (I5): attempts of a part in order, from 0 within one delivery run.

    A run ends with a sent part, with an error that is not retried, and with the last of ``max_trials`` attempts.
    """
    before = Window.partitionBy(*PART_KEY).orderBy("attempt_number").rowsBetween(Window.unboundedPreceding, -1)
    retryable = F.coalesce(F.col("error_code").isin(*C.RETRYABLE_DELIVERY_ERRORS), F.lit(False))
    ends = (F.col("status") == "sent") | ((F.col("status") == "failed") & ~retryable)
    runs = attempts.withColumn("_run", F.coalesce(F.sum(ends.cast("int")).over(before), F.lit(0)))
    inside = Window.partitionBy(*PART_KEY, "_run").orderBy("attempt_number")
    return runs.withColumn("trial", (F.row_number().over(inside) - 1) % max_trials).drop("_run")


def delivery_outcome(parts: DataFrame, attempts: DataFrame, max_trials: int = 3) -> DataFrame:
    """Status that the attempts give each digest, with error code and summary where it failed.

    ``sent`` when every part is sent; ``failed`` when the last attempt of an unsent part is not retried (the first such
    part tells the error: its own code, or a time-out once the trials are used up); ``sending`` when there are
    attempts; else ``generated``. Attempts need a ``trial``, see ``with_trials``.
    """
    schedule = retry_schedule(attempts, max_trials)
    last = schedule.groupBy(*PART_KEY).agg(
        F.bool_or(F.col("status") == "sent").alias("_sent"),
        F.max_by(F.struct("decision", "error_code"), "attempt_number").alias("_last"))
    joined = parts.select(*PART_KEY).join(last, PART_KEY, "left")
    stopped = ~F.col("_sent") & (F.col("_last.decision") == "fail_digest")
    used_up = F.col("_last.error_code").isin(*C.RETRYABLE_DELIVERY_ERRORS)
    code = F.when(used_up, "TELEGRAM_TIMEOUT").otherwise(F.col("_last.error_code"))
    summary = F.when(used_up, C.DELIVERY_EXHAUSTED).otherwise(C.DELIVERY_REJECTED)
    grouped = joined.groupBy("digest_id").agg(
        F.count(F.lit(1)).alias("parts_total"), F.count_if("_sent").alias("parts_sent"),
        F.count("_last").alias("_tried"),
        F.min(F.when(stopped, F.struct("part_number", code.alias("code"), summary.alias("summary")))).alias("_error"))
    status = (F.when(F.col("parts_sent") == F.col("parts_total"), "sent").when(F.col("_error").isNotNull(), "failed")
              .when(F.col("_tried") > 0, "sending").otherwise("generated"))
    return grouped.select("digest_id", status.alias("status"), "parts_total", "parts_sent",
                          F.when(status == "failed", F.col("_error.code")).alias("error_code"),
                          F.when(status == "failed", F.col("_error.summary")).alias("error_summary"))


def retry_schedule(attempts: DataFrame, max_trials: int = 3) -> DataFrame:
    """What follows each attempt (I5): adds ``decision`` and ``delay_seconds``.

    ``trial`` counts from 0 within one delivery run. Time-outs and rate limits are retried while trials are left, after
    the wait the server asked for or else 1, 2, 4, at most 8 seconds; anything else fails the digest.
    """
    retryable = F.coalesce(F.col("error_code").isin(*C.RETRYABLE_DELIVERY_ERRORS), F.lit(False))
    again = (F.col("status") == "failed") & retryable & (F.col("trial") + 1 < max_trials)
    asked = F.coalesce("retry_after_seconds", F.lit(0))
    wait = F.when(asked > 0, asked.cast("double")).otherwise(F.least(F.pow(F.lit(2.0), F.col("trial")), F.lit(8.0)))
    decision = F.when(F.col("status") == "sent", "done").when(F.col("status") == "pending", "wait").when(
        again, "retry").otherwise("fail_digest")
    return attempts.withColumn("decision", decision).withColumn("delay_seconds", F.when(again, wait))


def attempt_history(attempts: DataFrame) -> DataFrame:
    """Attempts by part, then number."""
    return attempts.orderBy("digest_id", "part_number", "attempt_number")


def fetch_history(fetches: DataFrame) -> DataFrame:
    """Fetches by start, then id."""
    return fetches.orderBy("started_at", "fetch_id")
