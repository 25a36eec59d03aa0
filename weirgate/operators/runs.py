"""Run counters, source health and status views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirgate import constants as C
from weirgate.operators.keys import one_per_key
from weirgate.operators.scan import BUCKET_SECONDS, streak_since_reset
from weirgate.session import cut_lineage


def ingest_summary(rows: DataFrame, fetches: DataFrame) -> DataFrame:
    """Counts per run and source.

    ``rows`` has one row per entry with ``outcome`` inserted, duplicate, over_budget or skipped; ``fetches`` has one
    row per run and source with ``fetch_status``. A failed fetch brings no entries.
    """
    outcome = F.col("outcome")
    counted = rows.groupBy("run_id", "source_key").agg(
        F.count_if(outcome != "skipped").alias("_fetched"), F.count_if(outcome == "inserted").alias("_inserted"),
        F.count_if(outcome == "duplicate").alias("_duplicate"), F.count_if(outcome == "skipped").alias("_skipped"))
    joined = fetches.join(counted, ["run_id", "source_key"], "left")
    usable = F.col("fetch_status") == "success"
    return joined.select(
        "run_id", "source_key", "fetch_status",
        *[F.when(usable, F.coalesce(f"_{name}", F.lit(0))).otherwise(0).cast("bigint").alias(f"items_{name}")
          for name in ("fetched", "inserted", "duplicate", "skipped")])


def run_counters(summary: DataFrame) -> DataFrame:
    """Counters per run (D2). ``items_fetched`` is inserted plus duplicate, not the entries seen."""
    return summary.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("feeds_total"),
        F.count_if(F.col("fetch_status") != "failed").alias("feeds_succeeded"),
        F.sum("items_inserted").alias("items_inserted"), F.sum("items_duplicate").alias("items_duplicate"),
    ).withColumn("items_fetched", F.col("items_inserted") + F.col("items_duplicate"))


def run_status(feeds_total: Column, feeds_failed: Column, candidates: Column, min_items: int,
               error_code: Column, locked: Column) -> Column:
    """Final status of a run (D3)."""
    return (
        F.when(locked, "skipped_locked")
        .when((feeds_total == 0) | (candidates < min_items), "no_content")
        .when(error_code.isNotNull(), "failed")
        .when(feeds_failed > 0, "partial_success").otherwise("success")
    )


def noisy_feeds(sources: DataFrame, threshold: int = 3) -> DataFrame:
    """One warning row with the keys of failing sources, sorted (D4); null when there are none.

    The list is the message itself; it holds one key per failing source, a table of configured feeds.
    """
    keys = F.array_join(F.array_sort(F.collect_list("source_key")), ", ")
    noisy = sources.where(F.col("consecutive_failures") >= threshold)
    return noisy.agg(F.count(F.lit(1)).alias("noisy"), keys.alias("_keys")).select(
        "noisy", F.when(F.col("noisy") > 0, F.concat(
            F.lit(C.NOISY_FEEDS), F.col("_keys"))).alias("warning"))


#: Keys in one warning line.
LINE_KEYS = 50


def noisy_feed_lines(sources: DataFrame, threshold: int = 3, per_line: int = LINE_KEYS) -> DataFrame:
    """The failing sources as numbered warning lines of at most ``per_line`` keys, sorted (D4): ``line`` (from 1), ``keys``
    in it, ``noisy`` in all and ``warning``. No rows where no source fails.

    Keys are cut into ranges, each range is numbered by itself, and the counts of the ranges before it are added, so no task sees
    all keys. The ranges are kept by a checkpoint: both parts of the plan must see the same cut.
    """
    noisy = sources.where(F.col("consecutive_failures") >= threshold).select("source_key")
    ranged = cut_lineage(noisy.repartitionByRange("source_key").withColumn("_range", F.spark_partition_id()))
    inside = ranged.withColumn("_place", F.row_number().over(Window.partitionBy("_range").orderBy("source_key")))
    ranges = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))  # one row for each range
    before = ranges.withColumn("_to", F.sum("_rows").over(Window.orderBy("_range")))
    total = before.agg(F.max("_to")).scalar()
    numbered = inside.join(before.select("_range", (F.col("_to") - F.col("_rows")).alias("_before")), "_range")
    line = F.floor((F.col("_before") + F.col("_place") - 1) / F.lit(per_line)) + 1
    lines = numbered.groupBy(line.alias("line")).agg(
        F.count(F.lit(1)).alias("keys"), F.array_join(F.array_sort(F.collect_list("source_key")), ", ").alias("_keys"))
    return lines.select("line", "keys", total.alias("noisy"), F.concat(F.lit(C.NOISY_FEEDS), F.col("_keys")).alias("warning"))


def failure_streak(fetches: DataFrame, key: str = "source_key", at: str = "finished_at", tie: str = "fetch_id",
                   bucket_seconds: int | None = BUCKET_SECONDS) -> DataFrame:
    """Failures since the last fetch that did not fail, after each fetch."""
    return streak_since_reset(fetches, key, at, tie, F.col("fetch_status") != "failed", "failure_streak",
                              bucket_seconds)


def apply_fetch_results(sources: DataFrame, fetches: DataFrame) -> DataFrame:
    """Source health after any number of fetches.

    A fetch that did not fail stamps the source, keeps the old validator where it brings none and ends the streak; a
    failed one only counts. Only aggregates per source are needed: the last good fetch, and the failures after it.
    """
    fetches = fetches.select("source_key", "fetch_status", "etag", "finished_at",
                             F.struct("finished_at", "fetch_id").alias("_at"))
    good = F.col("fetch_status") != "failed"
    seen = one_per_key(
        fetches, ["source_key"], F.max("finished_at").alias("_checked"), F.max(F.when(good, F.col("_at"))).alias("_good"),
        F.max(F.when(good & F.col("etag").isNotNull(), F.struct("_at", "etag"))).getField("etag").alias("_etag"))
    compared = fetches.where(~good).join(seen.select("source_key", "_good"), "source_key")
    later = one_per_key(compared, ["source_key"], F.count_if(
        F.col("_good").isNull() | (F.col("_at") > F.col("_good"))).alias("_failures"))
    joined = sources.join(seen, "source_key", "left").join(later, "source_key", "left")
    failures = F.coalesce("_failures", F.lit(0))
    stamped = [F.coalesce("_checked", "updated_at").alias("updated_at")] if "updated_at" in sources.columns else []
    return joined.select(
        *[name for name in sources.columns
          if name not in ("etag", "consecutive_failures", "last_checked_at", "last_success_at", "updated_at")],
        *stamped,
        F.coalesce("_etag", "etag").alias("etag"),
        F.when(F.col("_good").isNotNull(), failures).otherwise(F.col("consecutive_failures") + failures)
        .cast("bigint").alias("consecutive_failures"),
        F.coalesce("_checked", "last_checked_at").alias("last_checked_at"),
        F.coalesce(F.col("_good.finished_at"), "last_success_at").alias("last_success_at"),
    )


def latest_run(runs: DataFrame) -> DataFrame:
    """Newest run by start, then id."""
    return runs.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(1)


def latest_digest(digests: DataFrame) -> DataFrame:
    """Newest digest by date, creation and id."""
    return digests.orderBy(F.col("digest_date").desc(), F.col("created_at").desc(),
                           F.col("digest_id").desc()).limit(1)


def latest_sent_digest(digests: DataFrame) -> DataFrame:
    """Newest sent digest; rows without a send time come last."""
    return digests.where(F.col("status") == "sent").orderBy(
        F.col("sent_at").desc_nulls_last(), F.col("digest_date").desc(), F.col("digest_id").desc()).limit(1)


def digest_by_run(digests: DataFrame, run_id) -> DataFrame:
    """The digest of a run."""
    return digests.where(F.col("run_id") == run_id)


def status_view(runs: DataFrame, digests: DataFrame) -> DataFrame:
    """One row about the last run and the last sent digest (F8). An empty history gives nulls."""
    newest = runs.agg(F.max(F.struct(
        "started_at", "run_id", "status", "finished_at", "duration_ms", "feeds_total", "items_inserted",
        "selected_count")).alias("_run"))
    sent = latest_sent_digest(digests).agg(F.max("sent_at").alias("last_sent_digest_at"))
    fields = {"status": "last_run_status", "finished_at": "last_run_finished_at",
              "duration_ms": "last_run_duration_ms", "feeds_total": "feeds_total_last_run",
              "items_inserted": "items_inserted_last_run", "selected_count": "selected_count_last_run"}
    return newest.select(*[F.col(f"_run.{old}").alias(new) for old, new in fields.items()],
                         sent.scalar().alias("last_sent_digest_at"))


def retention_counts(fetches: DataFrame, attempts: DataFrame, cutoff: Column) -> DataFrame:
    """Rows a clean-up would delete, per table (D6); unfinished rows never count."""
    old = F.count_if(F.col("finished_at") < cutoff)
    return fetches.agg(old.alias("old_rows")).select(F.lit("feed_fetches").alias("table_name"), "old_rows").unionByName(
        attempts.agg(old.alias("old_rows")).select(F.lit("delivery_attempts").alias("table_name"), "old_rows"))


def purge(rows: DataFrame, cutoff: Column, older_than_days: int = 1) -> DataFrame:
    """Rows that survive a clean-up (J7). Write them as a new version; ``retention_counts`` is the dry run."""
    if older_than_days < 1:
        raise ValueError("older_than_days must be >= 1")
    return rows.where(~F.coalesce(F.col("finished_at") < cutoff, F.lit(False)))


def operational_metrics(audit: DataFrame, now: Column) -> DataFrame:
    """What operations watch (D7): errors, failed upserts, reviews, repeats, oldest open failure, model tokens."""
    status = F.col("status")
    failed = status == "failed"
    return audit.agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(F.col("error_code").isNotNull()).alias("errors"),
        F.count_if(F.col("error_code") == "CRM_UPSERT_FAILED").alias("crm_failures"),
        F.count_if(status == "needs_review").alias("needs_review"),
        F.count_if(status == "duplicate").alias("duplicates"),
        (F.count_if(status == "duplicate").cast("double") / F.count(F.lit(1)).cast("double")).alias("duplicate_ratio"),
        F.floor((F.unix_micros(now) - F.unix_micros(F.min(F.when(failed, F.col("received_at"))))) / F.lit(1_000_000))
        .alias("oldest_open_failure_seconds"),
        (F.sum("model_tokens").cast("double") / F.count(F.lit(1)).cast("double")).alias("tokens_per_request"),
    )


def daily_counts(rows: DataFrame, at: str, status: str = "status") -> DataFrame:
    """Rows per day and status."""
    return rows.groupBy(F.date_format(at, "yyyy-MM-dd").alias("day"), status).agg(F.count(F.lit(1)).alias("rows"))


def status_breakdown(audit: DataFrame, status: str = "status", reasons: str = "review_reasons") -> DataFrame:
    """Rows per status and reason (D9); rows without a reason count under ``none``."""
    rows = audit.select(status, F.explode_outer(reasons).alias("reason"))
    return rows.groupBy(F.col(status).alias("status"), F.coalesce("reason", F.lit("none")).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"))
