"""Run, delivery, state and quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirgate import constants as C
from weirgate.functions import events, times
from weirgate.operators import delivery, quality, runs, state
from weirgate.operators.keys import one_per_key
from weirgate.plans import sql, tables as t
from weirgate.plans.registry import Query

QUERIES: dict[str, Query] = {}

CUTOFF = "2024-01-15T00:00:00+00:00"
CUTOFF_MICROS = 1_705_276_800_000_000


# --- runs -----------------------------------------------------------------------------------------

def _ingest(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """One entry per document in a run per day number; copies of a text inside a run are duplicates."""
    key = F.col("doc_id")
    rows = t.table(spark, folder, "documents").select(
        "doc_id", (key % 30).alias("run_id"), F.col("source").alias("source_key"), "n_chars",
        F.sha2("text", 256).alias("hash"))
    firsts = one_per_key(rows, ["run_id", "hash"], F.min("doc_id").alias("first"))
    outcome = F.when(F.col("n_chars") < 40, "skipped").when(F.col("doc_id") == F.col("first"), "inserted").otherwise(
        "duplicate")
    entries = rows.join(firsts, ["run_id", "hash"]).select("run_id", "source_key", outcome.alias("outcome"))
    number = F.regexp_extract("source_key", r"(\d+)$", 1).cast("int")
    fetches = rows.select("run_id", "source_key").distinct().withColumn(
        "fetch_status", F.when((F.col("run_id") + number) % 9 == 0, "failed")
        .when((F.col("run_id") + number) % 9 == 1, "not_modified").otherwise("success"))
    return entries, fetches


_INGEST = """
WITH entry AS (
  SELECT doc_id % 30 AS run_id, source AS source_key,
         CASE WHEN n_chars < 40 THEN 'skipped'
              WHEN doc_id = min(doc_id) OVER (PARTITION BY doc_id % 30, sha256(text)) THEN 'inserted'
              ELSE 'duplicate' END AS outcome FROM documents),
fetched AS (SELECT DISTINCT run_id, source_key,
    CASE (run_id + CAST(regexp_extract(source_key, '([0-9]+)$', 1) AS INTEGER)) % 9 WHEN 0 THEN 'failed'
         WHEN 1 THEN 'not_modified' ELSE 'success' END AS fetch_status FROM entry),
summary AS (SELECT run_id, source_key, fetch_status,
    count(*) FILTER (WHERE fetch_status = 'success' AND outcome <> 'skipped') AS items_fetched,
    count(*) FILTER (WHERE fetch_status = 'success' AND outcome = 'inserted') AS items_inserted,
    count(*) FILTER (WHERE fetch_status = 'success' AND outcome = 'duplicate') AS items_duplicate,
    count(*) FILTER (WHERE fetch_status = 'success' AND outcome = 'skipped') AS items_skipped
  FROM fetched JOIN entry USING (run_id, source_key) GROUP BY 1, 2, 3)
"""


def ingest_summary(spark: SparkSession, folder: str) -> DataFrame:
    return runs.ingest_summary(*_ingest(spark, folder))


QUERIES["ingest_summary"] = Query(ingest_summary, _INGEST + "SELECT * FROM summary")


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Counters and final status per run."""
    counters = runs.run_counters(runs.ingest_summary(*_ingest(spark, folder)))
    key = F.col("run_id")
    status = runs.run_status(
        F.col("feeds_total"), F.col("feeds_total") - F.col("feeds_succeeded"), F.col("items_inserted"), 3,
        F.when(key % 7 == 0, "OPENAI_TIMEOUT"), key % 11 == 0)
    return counters.withColumn("status", status)


QUERIES["run_summary"] = Query(run_summary, _INGEST + """
SELECT *, CASE WHEN run_id % 11 = 0 THEN 'skipped_locked' WHEN feeds_total = 0 OR items_inserted < 3 THEN 'no_content'
    WHEN run_id % 7 = 0 THEN 'failed' WHEN feeds_total > feeds_succeeded THEN 'partial_success' ELSE 'success' END AS status
FROM (SELECT run_id, count(*) AS feeds_total, count(*) FILTER (WHERE fetch_status <> 'failed') AS feeds_succeeded,
             CAST(sum(items_inserted) AS BIGINT) AS items_inserted, CAST(sum(items_duplicate) AS BIGINT) AS items_duplicate,
             CAST(sum(items_inserted) + sum(items_duplicate) AS BIGINT) AS items_fetched
      FROM summary GROUP BY 1)""")


def _sources_from_fetches(spark: SparkSession, folder: str) -> DataFrame:
    number = F.regexp_extract("source_key", r"(\d+)$", 1).cast("bigint")
    return t.fetch_log(spark, folder).select("source_key").distinct().select(
        "source_key", F.lit("old").alias("etag"), (number % 4).alias("consecutive_failures"),
        F.lit(None).cast("timestamp").alias("last_checked_at"), F.lit(None).cast("timestamp").alias("last_success_at"))


def source_after_fetch(spark: SparkSession, folder: str) -> DataFrame:
    after = runs.apply_fetch_results(_sources_from_fetches(spark, folder), t.fetch_log(spark, folder))
    return after.select("source_key", "etag", "consecutive_failures",
                        F.unix_micros("last_checked_at").alias("last_checked_us"),
                        F.unix_micros("last_success_at").alias("last_success_us"))


_AFTER_FETCH = """
SELECT source_key, coalesce(arg_max(etag, (finished_at, fetch_id)) FILTER (WHERE etag IS NOT NULL), 'old') AS etag,
       CASE WHEN good IS NULL THEN CAST(regexp_extract(source_key, '([0-9]+)$', 1) AS BIGINT) % 4 + count(*)
            ELSE count(*) FILTER (WHERE (finished_at, fetch_id) > good) END AS consecutive_failures,
       epoch_us(max(finished_at)) AS last_checked_us,
       epoch_us(max(finished_at) FILTER (WHERE fetch_status <> 'failed')) AS last_success_us
FROM fetch_log JOIN (SELECT source_key, max((finished_at, fetch_id)) FILTER (WHERE fetch_status <> 'failed') AS good
                     FROM fetch_log GROUP BY 1) USING (source_key)
GROUP BY source_key, good"""
QUERIES["source_after_fetch"] = Query(source_after_fetch, sql.query(_AFTER_FETCH, "fetch_log"))


def failure_streaks(spark: SparkSession, folder: str) -> DataFrame:
    """Streak after every fetch."""
    return runs.failure_streak(t.fetch_log(spark, folder)).select("fetch_id", "source_key", "failure_streak")


QUERIES["failure_streaks"] = Query(failure_streaks, sql.query("""
SELECT fetch_id, source_key, count(*) FILTER (WHERE fetch_status = 'failed') OVER (
         PARTITION BY source_key, island ORDER BY finished_at, fetch_id) AS failure_streak
FROM (SELECT *, count(*) FILTER (WHERE fetch_status <> 'failed') OVER (
        PARTITION BY source_key ORDER BY finished_at, fetch_id) AS island FROM fetch_log)""", "fetch_log"))


def sources_after_fetch(spark: SparkSession, folder: str) -> DataFrame:
    return runs.apply_fetch_results(_sources_from_fetches(spark, folder), t.fetch_log(spark, folder))


def noisy_feeds(spark: SparkSession, folder: str) -> DataFrame:
    return runs.noisy_feeds(sources_after_fetch(spark, folder), 1)


QUERIES["noisy_feeds"] = Query(noisy_feeds, sql.query(f"""
SELECT count(*) AS noisy, CASE WHEN count(*) > 0 THEN
         'One or more feeds exceeded the consecutive failure threshold: ' || string_agg(source_key, ', ' ORDER BY source_key)
       END AS warning
FROM ({_AFTER_FETCH}) WHERE consecutive_failures >= 1""", "fetch_log"))


def status_view(spark: SparkSession, folder: str) -> DataFrame:
    view = runs.status_view(t.pipeline_runs(spark, folder), t.digests(spark, folder))
    return view.withColumns({name: F.unix_micros(name) for name in ("last_run_finished_at", "last_sent_digest_at")})


QUERIES["status_view"] = Query(status_view, sql.query("""
SELECT status AS last_run_status, finished_us AS last_run_finished_at, duration_ms AS last_run_duration_ms,
       feeds_total AS feeds_total_last_run, items_inserted AS items_inserted_last_run,
       selected_count AS selected_count_last_run, (SELECT max(sent_us) FROM digest WHERE status = 'sent')
         AS last_sent_digest_at
FROM run ORDER BY started_us DESC, run_id DESC LIMIT 1""", "run", "digest"))


def latest_records(spark: SparkSession, folder: str) -> DataFrame:
    """Newest run, newest digest and newest sent digest."""
    digests = t.digests(spark, folder)
    return runs.latest_run(t.pipeline_runs(spark, folder)).select(F.lit("run").alias("kind"), F.col("run_id").alias("id")
        ).unionByName(runs.latest_digest(digests).select(F.lit("digest").alias("kind"), F.col("digest_id").alias("id"))
        ).unionByName(runs.latest_sent_digest(digests).select(
            F.lit("sent digest").alias("kind"), F.col("digest_id").alias("id")))


QUERIES["latest_records"] = Query(latest_records, sql.query("""
SELECT * FROM (SELECT 'run' AS kind, run_id AS id FROM run ORDER BY started_us DESC, run_id DESC LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'digest', digest_id FROM digest
                         ORDER BY digest_date DESC, created_us DESC, digest_id DESC LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'sent digest', digest_id FROM digest WHERE status = 'sent'
                         ORDER BY sent_us DESC NULLS LAST, digest_date DESC, digest_id DESC LIMIT 1)""", "run", "digest"))


def next_fire_times(spark: SparkSession, folder: str) -> DataFrame:
    """Next daily run after every event, in two zones."""
    rows = t.table(spark, folder, "events")
    return rows.select("event_id", *[
        F.unix_micros(times.next_fire_time(F.col("ts"), 3, 30, zone)).alias(name)
        for zone, name in (("UTC", "utc_us"), ("Asia/Kolkata", "kolkata_us"))])


QUERIES["next_fire_times"] = Query(next_fire_times, """
SELECT event_id, CASE WHEN day + 12600000000 >= us THEN day + 12600000000 ELSE day + 99000000000 END AS utc_us,
       CASE WHEN shifted + 12600000000 - 19800000000 >= us THEN shifted - 7200000000
            ELSE shifted + 79200000000 END AS kolkata_us
FROM (SELECT event_id, epoch_us(ts) AS us, epoch_us(date_trunc('day', ts)) AS day,
             epoch_us(date_trunc('day', ts + INTERVAL 330 MINUTE)) AS shifted FROM events)""")


def daily_fetches(spark: SparkSession, folder: str) -> DataFrame:
    """Fetches per day and status."""
    return runs.daily_counts(t.fetch_log(spark, folder), "finished_at", "fetch_status")


QUERIES["daily_fetches"] = Query(daily_fetches, sql.query("""
SELECT strftime(finished_at, '%Y-%m-%d') AS day, fetch_status, count(*) AS rows FROM fetch_log GROUP BY 1, 2""",
    "fetch_log"))


# --- delivery -------------------------------------------------------------------------------------

def _parts(spark: SparkSession, folder: str) -> DataFrame:
    """Four parts per digest; attempts know three."""
    return t.table(spark, folder, "events").select(F.col("user_id").alias("digest_id")).distinct().select(
        "digest_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(4).cast("bigint"))).alias("part_number"))


_PARTS = "(SELECT DISTINCT user_id AS digest_id, unnest([1, 2, 3, 4]) AS part_number FROM events)"


def delivery_progress(spark: SparkSession, folder: str) -> DataFrame:
    return delivery.delivery_progress(_parts(spark, folder), t.delivery_attempts(spark, folder))


QUERIES["delivery_progress"] = Query(delivery_progress, sql.query(f"""
SELECT *, parts_sent = parts_total AS delivered
FROM (SELECT digest_id, count(*) AS parts_total, count(*) FILTER (WHERE sent) AS parts_sent,
             coalesce(max(last), 0) AS max_attempt
      FROM {_PARTS} LEFT JOIN (SELECT digest_id, part_number, bool_or(status = 'sent') AS sent,
                                      max(attempt_number) AS last FROM attempt GROUP BY 1, 2) USING (digest_id, part_number)
      GROUP BY 1)""", "attempt"))


def delivery_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts and next attempt number of each part."""
    return delivery.part_progress(t.delivery_attempts(spark, folder))


QUERIES["delivery_parts"] = Query(delivery_parts, sql.query("""
SELECT digest_id, part_number, count(*) AS attempts, max(attempt_number) AS last_attempt,
       bool_or(status = 'sent') AS sent, max(attempt_number) + 1 AS next_attempt FROM attempt GROUP BY 1, 2""", "attempt"))


def delivery_unsent(spark: SparkSession, folder: str) -> DataFrame:
    return delivery.unsent_parts(_parts(spark, folder), t.delivery_attempts(spark, folder))


QUERIES["delivery_unsent"] = Query(delivery_unsent, sql.query(f"""
SELECT * FROM {_PARTS} EXCEPT SELECT digest_id, part_number FROM attempt WHERE status = 'sent'""", "attempt"))


def retry_schedule(spark: SparkSession, folder: str) -> DataFrame:
    """Every attempt with its trial, taken from the log, and what follows it."""
    rows = delivery.retry_schedule(delivery.with_trials(t.delivery_attempts(spark, folder).drop("trial")))
    return rows.select("attempt_number", "trial", "decision", "delay_seconds")


_ENDS = "(status = 'sent' OR (status = 'failed' AND error_code NOT IN ('TELEGRAM_TIMEOUT', 'TELEGRAM_RATE_LIMITED')))"
_TRIALS = f"""(SELECT * EXCLUDE (trial, run), (row_number() OVER (PARTITION BY digest_id, part_number, run
                                                                ORDER BY attempt_number) - 1) % 3 AS trial
  FROM (SELECT *, coalesce(sum(CASE WHEN {_ENDS} THEN 1 ELSE 0 END) OVER (
                    PARTITION BY digest_id, part_number ORDER BY attempt_number
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM attempt))"""


QUERIES["retry_schedule"] = Query(retry_schedule, sql.query(f"""
SELECT attempt_number, trial, CASE WHEN status = 'sent' THEN 'done' WHEN status = 'pending' THEN 'wait' WHEN again THEN 'retry'
         ELSE 'fail_digest' END AS decision,
       CASE WHEN again THEN CAST(CASE WHEN retry_after_seconds > 0 THEN retry_after_seconds
                                      ELSE least(power(2, trial), 8) END AS DOUBLE) END AS delay_seconds
FROM (SELECT *, status = 'failed' AND error_code IN ('TELEGRAM_TIMEOUT', 'TELEGRAM_RATE_LIMITED') AND trial + 1 < 3
        AS again FROM {_TRIALS})""", "attempt"))


def digest_delivery_state(spark: SparkSession, folder: str) -> DataFrame:
    """Status of every digest after its attempts; each has the parts that were tried and one digest in five one more."""
    attempts = delivery.with_trials(t.delivery_attempts(spark, folder).drop("trial"))
    tried = attempts.select("digest_id", "part_number").distinct()
    more = attempts.where(F.col("digest_id") % 5 == 0).select("digest_id", F.lit(4).cast("bigint").alias("part_number")).distinct()
    alone = tried.select((-F.col("digest_id") - 1).alias("digest_id"), "part_number")
    return delivery.delivery_outcome(tried.unionByName(more).unionByName(alone), attempts)


QUERIES["digest_delivery_state"] = Query(digest_delivery_state, sql.query(f"""
SELECT digest_id, CASE WHEN parts_sent = parts_total THEN 'sent' WHEN stop IS NOT NULL THEN 'failed'
                       WHEN tried > 0 THEN 'sending' ELSE 'generated' END AS status, parts_total, parts_sent,
       CASE WHEN parts_sent < parts_total AND stop IS NOT NULL THEN
         CASE WHEN stop_code = 'TELEGRAM_PERMANENT_FAILURE' THEN stop_code ELSE 'TELEGRAM_TIMEOUT' END END AS error_code,
       CASE WHEN parts_sent < parts_total AND stop IS NOT NULL THEN
         CASE WHEN stop_code = 'TELEGRAM_PERMANENT_FAILURE' THEN 'Delivery was rejected.'
              ELSE 'Telegram delivery retries exhausted.' END END AS error_summary
FROM (SELECT digest_id, count(*) AS parts_total, count(*) FILTER (WHERE sent) AS parts_sent, count(sent) AS tried,
             min(part_number) FILTER (WHERE stopped) AS stop,
             arg_min(code, part_number) FILTER (WHERE stopped) AS stop_code
      FROM (SELECT DISTINCT digest_id, part_number FROM attempt
            UNION ALL SELECT DISTINCT digest_id, 4 FROM attempt WHERE digest_id % 5 = 0
            UNION ALL SELECT DISTINCT -digest_id - 1, part_number FROM attempt)
      LEFT JOIN (SELECT digest_id, part_number, sent, code, NOT sent AND last_status = 'failed' AND NOT (
                          code IN ('TELEGRAM_TIMEOUT', 'TELEGRAM_RATE_LIMITED') AND last_trial + 1 < 3) AS stopped
                 FROM (SELECT digest_id, part_number, bool_or(status = 'sent') AS sent,
                              arg_max(status, attempt_number) AS last_status, arg_max(trial, attempt_number) AS last_trial,
                              arg_max(coalesce(error_code, ''), attempt_number) AS code FROM {_TRIALS} GROUP BY 1, 2))
        USING (digest_id, part_number)
      GROUP BY 1)""", "attempt"))


def delivery_history(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts in delivery order."""
    return delivery.attempt_history(t.delivery_attempts(spark, folder)).select(
        "digest_id", "part_number", "attempt_number", "status")


QUERIES["delivery_history"] = Query(delivery_history, sql.query(
    "SELECT digest_id, part_number, attempt_number, status FROM attempt", "attempt"))


def fetch_history(spark: SparkSession, folder: str) -> DataFrame:
    """Fetches in time order."""
    rows = t.fetch_log(spark, folder).withColumn("started_at", F.col("finished_at"))
    return delivery.fetch_history(rows).select("fetch_id", "source_key", "fetch_status")


QUERIES["fetch_history"] = Query(fetch_history, sql.query(
    "SELECT fetch_id, source_key, fetch_status FROM fetch_log", "fetch_log"))


def retention_counts(spark: SparkSession, folder: str) -> DataFrame:
    return runs.retention_counts(t.fetch_log(spark, folder), t.delivery_attempts(spark, folder), times.instant(CUTOFF))


QUERIES["retention_counts"] = Query(retention_counts, sql.query(f"""
SELECT 'feed_fetches' AS table_name, count(*) FILTER (WHERE epoch_us(finished_at) < {CUTOFF_MICROS}) AS old_rows
FROM fetch_log
UNION ALL SELECT 'delivery_attempts', count(*) FILTER (WHERE finished_us < {CUTOFF_MICROS}) FROM attempt""",
    "fetch_log", "attempt"))


def retention_keep(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts that survive the clean-up."""
    return runs.purge(t.delivery_attempts(spark, folder), times.instant(CUTOFF)).select(
        "attempt_number", "digest_id", "status")


QUERIES["retention_keep"] = Query(retention_keep, sql.query(f"""
SELECT attempt_number, digest_id, status FROM attempt WHERE finished_us IS NULL OR finished_us >= {CUTOFF_MICROS}""",
    "attempt"))


# --- state ----------------------------------------------------------------------------------------

def transition_check(spark: SparkSession, folder: str) -> DataFrame:
    """Changes and first forbidden change per digest."""
    return state.check_transitions(t.status_events(spark, folder), "digest")


_CHANGES = """
SELECT *, CASE WHEN previous_status IS NOT NULL AND NOT (
    (previous_status = 'generated' AND status = 'sending') OR (previous_status = 'sending' AND status IN ('sent', 'failed'))
    OR (previous_status = 'failed' AND status = 'sending'))
  THEN 'Invalid digest state transition: ''' || previous_status || ''' -> ''' || status || '''' END AS error
FROM (SELECT *, lag(status) OVER (PARTITION BY entity_id ORDER BY changed_at, event_id) AS previous_status
      FROM status_event)"""
QUERIES["transition_check"] = Query(transition_check, sql.query(f"""
SELECT entity_id, count(previous_status) AS changes, count(error) AS invalid_changes,
       arg_min(error, (changed_at, event_id)) FILTER (WHERE error IS NOT NULL) AS first_error
FROM ({_CHANGES}) GROUP BY 1""", "status_event"))


def saved_runs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored runs and a later save that changes some of them."""
    before = t.pipeline_runs(spark, folder).select("run_id", "trigger_type", "started_at", "status", "items_inserted")
    key = F.col("run_id")
    after = before.withColumn("items_inserted", F.when(key % 10 == 0, F.col("items_inserted") + 1)
                              .otherwise(F.col("items_inserted"))).withColumn(
        "trigger_type", F.when(key % 45 == 0, "moved").otherwise(F.col("trigger_type")))
    return before, after


def terminal_immutability(spark: SparkSession, folder: str) -> DataFrame:
    """Stored runs against a later save that changes some of them."""
    before, after = saved_runs(spark, folder)
    return state.terminal_immutability(before, after, "run_id", ["trigger_type", "started_at"], "running",
                                       ["items_inserted"])


QUERIES["terminal_immutability"] = Query(terminal_immutability, sql.query("""
SELECT run_id, status AS stored_status, status, CASE WHEN run_id % 45 = 0 THEN 'identity' ELSE 'terminal' END AS violation
FROM run WHERE run_id % 45 = 0 OR (run_id % 10 = 0 AND status <> 'running')""", "run"))


# --- quality --------------------------------------------------------------------------------------

def rule_check(spark: SparkSession, folder: str) -> DataFrame:
    """Broken rules of every run."""
    checked = quality.check_rules(t.pipeline_runs(spark, folder), "pipeline_runs")
    return checked.select("run_id", F.array_join("failed_rules", "; ").alias("failed_rules"))


_CODES = ", ".join(f"'{code}'" for code in C.ERROR_CODES)
QUERIES["rule_check"] = Query(rule_check, sql.query(f"""
SELECT run_id, array_to_string(list_filter([
  CASE WHEN trigger_type NOT IN ('scheduled', 'manual', 'dry_run') THEN 'trigger_type_known' END,
  CASE WHEN error_code NOT IN ({_CODES}) THEN 'error_code_known' END,
  CASE WHEN NOT ((status = 'failed' AND error_code IS NOT NULL)
       OR (status <> 'failed' AND error_code IS NULL AND error_summary IS NULL)) THEN 'error_matches_status' END,
  CASE WHEN NOT ((status = 'running' AND finished_us IS NULL AND duration_ms IS NULL)
       OR (status <> 'running' AND finished_us IS NOT NULL AND duration_ms IS NOT NULL))
       THEN 'completion_matches_status' END,
  CASE WHEN duration_ms < 0 THEN 'duration_non_negative' END,
  CASE WHEN feeds_succeeded > feeds_total THEN 'feed_counters_consistent' END,
  CASE WHEN finished_us < started_us THEN 'completion_time_valid' END,
  CASE WHEN items_inserted + items_duplicate > items_fetched THEN 'item_counters_consistent' END,
  CASE WHEN selected_count > candidates_count THEN 'selection_counters_consistent' END],
  lambda r: r IS NOT NULL), '; ') AS failed_rules FROM run""", "run"))


def rule_check_attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per broken rule of the delivery attempts."""
    return quality.rule_summary(quality.check_rules(t.delivery_attempts(spark, folder), "delivery_attempts"))


QUERIES["rule_check_attempts"] = Query(rule_check_attempts, sql.query("""
SELECT 'completion_time_valid' AS rule, count(*) AS rows FROM attempt WHERE finished_us < started_us
HAVING count(*) > 0""", "attempt"))


def rule_check_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per broken rule of the digests."""
    key = F.col("digest_id")
    rows = t.digests(spark, folder).withColumn("title", F.col("digest_title")).withColumns({
        "model": F.when(key % 50 == 3, "other").otherwise(C.DIGEST_MODEL), "input_tokens": key % 100 - 1,
        "output_tokens": F.lit(None).cast("bigint"),
        "error_code": F.when((F.col("status") == "failed") & (key % 4 != 0), "TELEGRAM_TIMEOUT"),
        "error_summary": F.lit(None).cast("string")})
    return quality.rule_summary(quality.check_rules(rows, "digests"))


QUERIES["rule_check_digests"] = Query(rule_check_digests, sql.query("""
SELECT rule, count(*) AS rows FROM (
  SELECT unnest(list_filter([
    CASE WHEN status = 'failed' AND digest_id % 4 = 0 THEN 'error_matches_status' END,
    CASE WHEN (status = 'sent') <> (sent_us IS NOT NULL) THEN 'sent_time_matches_status' END,
    CASE WHEN digest_id % 50 = 3 THEN 'model_valid' END,
    CASE WHEN digest_id % 100 = 0 THEN 'input_tokens_non_negative' END], lambda r: r IS NOT NULL)) AS rule FROM digest)
GROUP BY 1""", "digest"))


def rule_check_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Broken rules of the sources, some of which have a bad key or priority."""
    number = F.col("number")
    rows = t.feed_sources(spark, folder).withColumns({
        "source_key": F.when(number % 4 == 0, F.concat(F.lit("Bad_"), F.col("source_key"))).otherwise(F.col("source_key")),
        "priority": F.when(number % 5 == 0, F.lit(11)).otherwise(F.col("priority")),
        "language": F.when(number % 6 == 0, "eng").otherwise(F.col("language")),
        "consecutive_failures": number - 1})
    checked = quality.check_rules(rows, "feed_sources")
    return checked.select("source_key", F.array_join("failed_rules", "; ").alias("failed_rules"))


QUERIES["rule_check_sources"] = Query(rule_check_sources, sql.query("""
SELECT CASE WHEN number % 4 = 0 THEN 'Bad_' ELSE '' END || source_key AS source_key, array_to_string(list_filter([
  CASE WHEN number < 1 THEN 'consecutive_failures_non_negative' END,
  CASE WHEN number % 5 = 0 THEN 'priority_range' END, CASE WHEN number % 4 = 0 THEN 'key_format' END,
  CASE WHEN number % 6 = 0 THEN 'language_code' END], lambda r: r IS NOT NULL), '; ') AS failed_rules
FROM feed_source""", "feed_source"))


def rule_check_fetches(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per broken rule of the fetches."""
    key, failed = F.col("fetch_id"), F.col("fetch_status") == "failed"
    rows = t.fetch_log(spark, folder).withColumns({
        "status": F.col("fetch_status"),
        "http_status": F.when(F.col("fetch_status") == "not_modified", 304).when(
            ~failed, F.when(key % 8 == 0, 301).otherwise(200)),
        "entries_count": F.when(key % 3 == 0, 0).otherwise(key % 20), "duration_ms": key % 90 - 1,
        "error_code": F.when(failed & (key % 4 != 0), "FEED_TIMEOUT"), "error_summary": F.lit(None).cast("string"),
        "started_at": F.timestamp_micros(F.unix_micros("finished_at") + (key % 10 - 8) * 1000)})
    return quality.rule_summary(quality.check_rules(rows, "feed_fetches"))


QUERIES["rule_check_fetches"] = Query(rule_check_fetches, sql.query("""
SELECT rule, count(*) AS rows FROM (SELECT unnest(list_filter([
    CASE WHEN fetch_status = 'failed' AND fetch_id % 4 = 0 THEN 'error_matches_status' END,
    CASE WHEN fetch_status = 'not_modified' AND fetch_id % 3 <> 0 AND fetch_id % 20 <> 0
         THEN 'not_modified_result_valid' END,
    CASE WHEN fetch_status = 'success' AND fetch_id % 8 = 0 THEN 'success_http_valid' END,
    CASE WHEN fetch_id % 90 = 0 THEN 'duration_non_negative' END,
    CASE WHEN fetch_id % 10 = 9 THEN 'completion_time_valid' END], lambda r: r IS NOT NULL)) AS rule FROM fetch_log)
GROUP BY 1""", "fetch_log"))


def rule_check_news(spark: SparkSession, folder: str) -> DataFrame:
    """Broken rules of the news items."""
    key = F.col("doc_id")
    rows = t.news_items(spark, folder).withColumns({
        "content_hash": F.sha2("sanitized_summary", 256),
        "url_hash": F.when(key % 7 == 0, F.upper(F.sha2("news_item_id", 256))).otherwise(F.sha2("news_item_id", 256)),
        "ignore_reason": F.when(key % 6 != 0, F.col("ignore_reason"))})
    checked = quality.check_rules(rows, "news_items")
    return checked.select("doc_id", F.array_join("failed_rules", "; ").alias("failed_rules"))


QUERIES["rule_check_news"] = Query(rule_check_news, sql.query(f"""
SELECT doc_id, array_to_string(list_filter([
  CASE WHEN status = 'ignored' AND doc_id % 6 = 0 THEN 'ignore_reason_matches_status' END,
  CASE WHEN doc_id % 7 = 0 THEN 'url_hash_valid' END,
  CASE WHEN length({sql.strip('title')}) NOT BETWEEN 1 AND 500 THEN 'title_length' END],
  lambda r: r IS NOT NULL), '; ') AS failed_rules FROM news_item""", "news_item"))


def rule_check_digest_items(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per broken rule of the order lines as digest items."""
    rows = t.table(spark, folder, "lineitem").select(
        (F.col("l_linenumber") + F.when(F.col("l_quantity") > 45, 3).otherwise(0)).alias("position"),
        (F.col("l_discount") * 12).alias("relevance_score"),
        F.when(F.col("l_returnflag") == "R", "OTHER").when(F.col("l_returnflag") == "A", "NEWS").alias("tag"))
    return quality.rule_summary(quality.check_rules(rows, "digest_items"))


QUERIES["rule_check_digest_items"] = Query(rule_check_digest_items, """
SELECT rule, count(*) AS rows FROM (SELECT unnest(list_filter([
    CASE WHEN l_linenumber + CASE WHEN l_quantity > 45 THEN 3 ELSE 0 END > 7 THEN 'position_valid' END,
    CASE WHEN l_discount * 12 > 1 THEN 'relevance_score_valid' END,
    CASE WHEN l_returnflag = 'A' THEN 'tag_known' END], lambda r: r IS NOT NULL)) AS rule FROM lineitem)
GROUP BY 1""")


def unique_check(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines whose (order, line number) occurs more than once."""
    return quality.check_unique(t.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


QUERIES["unique_check"] = Query(unique_check, """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")


def unique_check_partial(spark: SparkSession, folder: str) -> DataFrame:
    """(Source, external id) of news items, where there is an external id."""
    return quality.check_unique(t.keyed_news(spark, folder), ["source_key", "external_id"],
                                F.col("external_id").isNotNull())


QUERIES["unique_check_partial"] = Query(unique_check_partial, sql.query("""
SELECT source_key, external_id, count(*) AS rows FROM keyed_news WHERE external_id IS NOT NULL GROUP BY 1, 2
HAVING count(*) > 1""", "keyed_news"))


def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of customers in another segment than BUILDING count as orphans of that segment's customers."""
    parents = t.table(spark, folder, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return quality.orphans(t.table(spark, folder, "orders").select("o_orderkey", "o_custkey"), parents, "o_custkey",
                           "c_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("rows"))


QUERIES["fk_orphans"] = Query(fk_orphans, """
SELECT o_custkey, count(*) AS rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""")


def cascade_effect(spark: SparkSession, folder: str) -> DataFrame:
    """Deleting all failed digests: items go with them, shipped ones keep theirs."""
    deleted = t.digests(spark, folder).where(F.col("status") == "failed").select("digest_id")
    lines = t.table(spark, folder, "lineitem")
    return quality.cascade_effect(deleted, "digest_id", [
        ("digest_items", lines, "l_orderkey", "cascade"),
        ("returned_lines", lines.where(F.col("l_returnflag") == "R"), "l_orderkey", "restrict")])


QUERIES["cascade_effect"] = Query(cascade_effect, sql.query("""
, hit AS (SELECT l_orderkey, l_returnflag FROM lineitem
          WHERE l_orderkey IN (SELECT digest_id FROM digest WHERE status = 'failed'))
SELECT 'digest_items' AS child_table, 'cascade' AS action, count(*) AS child_rows, count(DISTINCT l_orderkey) AS parents,
       CAST(0 AS BIGINT) AS blocked_parents FROM hit
UNION ALL SELECT 'returned_lines', 'restrict', count(*), count(DISTINCT l_orderkey), count(DISTINCT l_orderkey)
FROM hit WHERE l_returnflag = 'R'""", "digest"))

SCAN_PATTERNS = {
    **C.SECRET_PATTERNS,
    "Assigned token": r"token = \"[0-9a-f]{40}\"",
    "Mail address": r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[A-Za-z.]+",
}
SCAN_NEEDLES = {**C.SECRET_NEEDLES, "Assigned token": "token", "Mail address": "@"}


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Key shapes in whole documents and conversation turns."""
    texts = t.table(spark, folder, "documents").select(
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("place"), "text").unionByName(
        t.table(spark, folder, "conversations").select(
            F.concat_ws(" ", F.lit("turn"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
            .alias("place"), "text"))
    return quality.scan_secrets(texts, "place", "text", SCAN_PATTERNS, SCAN_NEEDLES)


_SCANS = " UNION ALL ".join(
    f"SELECT place, {sql.quote(label)} AS label, len(regexp_extract_all(text, {sql.quote(pattern)})) AS matches FROM texts"
    for label, pattern in SCAN_PATTERNS.items())
QUERIES["secret_scan"] = Query(secret_scan, f"""
WITH texts AS (SELECT 'doc ' || doc_id AS place, text FROM documents
               UNION ALL SELECT 'turn ' || conv_id || ' ' || turn, text FROM conversations)
SELECT * FROM ({_SCANS}) WHERE matches > 0""")


def log_event_redact(spark: SparkSession, folder: str) -> DataFrame:
    """Log events with secret keys, content keys and whole texts with line ends."""
    rows = t.table(spark, folder, "documents").select("doc_id", F.create_map(
        F.lit("event"), F.concat(F.lit("item\r\nstored "), F.col("source")), F.lit("X-Api-Key"), F.lit("abc"),
        F.lit("Title"), F.substring_index("text", "\n", 1), F.lit("note"), F.col("text"),
        F.lit("chat-id"), F.col("doc_id").cast("string")).alias("event"))
    clean = rows.select("doc_id", events.redact_event(F.col("event")).alias("event"))
    return clean.select("doc_id", F.col("event")["event"].alias("event"), F.col("event")["X-Api-Key"].alias("api_key"),
                        F.col("event")["Title"].alias("title"), F.sha2(F.col("event")["note"], 256).alias("note_hash"),
                        F.col("event")["chat-id"].alias("chat_id"))


_NOTE = r"regexp_replace(text, '[\x00-\x1f\x7f]+', ' ', 'g')"
QUERIES["log_event_redact"] = Query(log_event_redact, f"""
SELECT doc_id, 'item stored ' || source AS event, '***' AS api_key, '***' AS title,
       sha256({sql.strip(_NOTE)}) AS note_hash, '***' AS chat_id FROM documents""")
