"""Queries on the life of stored rows: cascades, versions, purges, lookups against a large stored side, warnings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirgate.functions import times
from weirgate.operators import cascade, differ, intake, news, prefilter, runs, state
from weirgate.operators.cascade import Reference
from weirgate.plans import invoices, news as news_plans, operations, sql, tables as t
from weirgate.plans.registry import Query
from weirgate.session import shared_folder
from weirgate.sources.versions import VersionedTable

QUERIES: dict[str, Query] = {}

#: How the tables of the store refer to each other.
REFERENCES = [
    Reference("digests", "run_id", "pipeline_runs", "restrict"),
    Reference("feed_fetches", "run_id", "pipeline_runs", "cascade"),
    Reference("delivery_attempts", "digest_id", "digests", "cascade"),
    Reference("digest_items", "digest_id", "digests", "cascade"),
    Reference("digest_items", "news_item_id", "news_items", "restrict"),
]


def cascade_closure(spark: SparkSession, folder: str) -> DataFrame:
    """Runs (customers) deleted with most of their digests (orders), and some news items (parts): what goes with them through
    items (lines), attempts and fetches (events), and what must stay."""
    orders, lines, log = (t.table(spark, folder, name) for name in ("orders", "lineitem", "events"))
    tables = {
        "pipeline_runs": (t.table(spark, folder, "customer").select(F.col("c_custkey").alias("run_id")), "run_id"),
        "digests": (orders.select(F.col("o_orderkey").alias("digest_id"), F.col("o_custkey").alias("run_id")), "digest_id"),
        "digest_items": (lines.select(F.concat_ws("-", "l_orderkey", "l_partkey").alias("item_id"), F.col("l_orderkey").alias("digest_id"),
                                      F.col("l_partkey").alias("news_item_id")).distinct(), "item_id"),
        "delivery_attempts": (log.select("event_id", (F.col("event_id") + 1).alias("digest_id")), "event_id"),
        "feed_fetches": (log.select("event_id", F.col("user_id").alias("run_id")), "event_id"),
        "news_items": (t.table(spark, folder, "part").select(F.col("p_partkey").alias("news_item_id")), "news_item_id"),
    }
    runs_, digests, items = (tables[name][0] for name in ("pipeline_runs", "digests", "news_items"))
    asked = {
        "pipeline_runs": runs_.where(F.col("run_id") % 4 == 0),
        "digests": digests.where((F.col("run_id") % 4 == 0) & (F.col("digest_id") % 5 != 0)),
        "news_items": items.where(F.col("news_item_id") % 20 == 0),
    }
    return cascade.closure_summary(cascade.delete_closure(tables, REFERENCES, asked))


QUERIES["cascade_closure"] = Query(cascade_closure, """
WITH run AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 4 = 0),
digest AS (SELECT o_orderkey AS k FROM orders WHERE o_custkey % 4 = 0 AND o_orderkey % 5 <> 0),
bad_run AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey NOT IN (SELECT k FROM digest)),
bad_item AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_orderkey NOT IN (SELECT k FROM digest)),
reached AS (
    SELECT 'pipeline_runs' AS "table", CASE WHEN k IN (SELECT k FROM bad_run) THEN 'blocked' ELSE 'deleted' END AS outcome, 1 AS a FROM run
    UNION ALL SELECT 'digests', 'deleted', 1 FROM digest
    UNION ALL SELECT 'digest_items', 'deleted', 0 FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)
              WHERE l_orderkey IN (SELECT k FROM digest)
    UNION ALL SELECT 'delivery_attempts', 'deleted', 0 FROM events WHERE event_id + 1 IN (SELECT k FROM digest)
    UNION ALL SELECT 'feed_fetches', CASE WHEN user_id IN (SELECT k FROM bad_run) THEN 'kept' ELSE 'deleted' END, 0
              FROM events WHERE user_id IN (SELECT k FROM run)
    UNION ALL SELECT 'news_items', CASE WHEN p_partkey IN (SELECT k FROM bad_item) THEN 'blocked' ELSE 'deleted' END, 1
              FROM part WHERE p_partkey % 20 = 0)
SELECT "table", outcome, count(*) AS rows, CAST(sum(a) AS BIGINT) AS asked FROM reached GROUP BY 1, 2""")


def retention_purge(spark: SparkSession, folder: str) -> DataFrame:
    """Attempts that survive the clean-up of a versioned table, which writes the positions of the others only."""
    table = VersionedTable(spark, f"{shared_folder(spark)}/attempts-{uuid.uuid4().hex}")
    table.append(t.delivery_attempts(spark, folder))
    table.delete(F.col("finished_at") < times.instant(operations.CUTOFF))
    return table.read().select("attempt_number", "digest_id", "status")


QUERIES["retention_purge"] = Query(retention_purge, operations.QUERIES["retention_keep"].sql)


def terminal_immutability_diff(spark: SparkSession, folder: str) -> DataFrame:
    """The illegal rewrites again, from the parts in which the two versions differ."""
    before, after = operations.saved_runs(spark, folder)
    identity, values = ["trigger_type", "started_at"], ["items_inserted"]
    parts = differ.changed_parts(before, after, "run_id", [*identity, "status", *values])
    return state.terminal_immutability(*parts, "run_id", identity, "running", values)


QUERIES["terminal_immutability_diff"] = Query(terminal_immutability_diff, operations.QUERIES["terminal_immutability"].sql)


def duplicate_lookup_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """New documents against an audit that is first cut down to rows with a hash of theirs."""
    new, audit = invoices.new_and_audit(spark, folder)
    likely = prefilter.only_likely(audit, new, (["file_hash"], ["file_hash"]))
    return intake.mark_duplicates(new, likely).select("doc_id", "is_duplicate", "duplicate_status", "duplicate_processed_at")


QUERIES["duplicate_lookup_filtered"] = Query(duplicate_lookup_filtered, invoices.QUERIES["duplicate_lookup"].sql)


def news_insert_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """Arriving items against stored ones that may share a URL or an external id with them."""
    keyed = t.keyed_news(spark, folder)
    stored, arriving = keyed.where(F.col("doc_id") % 2 == 0), keyed.where(F.col("doc_id") % 2 == 1)
    likely = prefilter.only_likely(stored, arriving, (["url_hash"], ["url_hash"]),
                                   (["source_key", "external_id"], ["source_key", "external_id"]))
    return news.insert_if_new(arriving, likely).select("doc_id", "outcome", "matched_id")


QUERIES["news_insert_filtered"] = Query(news_insert_filtered, news_plans.QUERIES["news_insert_if_new"].sql)


def noisy_feed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Failing sources in numbered lines of bounded length."""
    return runs.noisy_feed_lines(operations.sources_after_fetch(spark, folder), 1)


QUERIES["noisy_feed_lines"] = Query(noisy_feed_lines, sql.query(f"""
SELECT (number - 1) // {runs.LINE_KEYS} + 1 AS line, count(*) AS keys, max(noisy) AS noisy,
       'One or more feeds exceeded the consecutive failure threshold: ' || string_agg(source_key, ', ' ORDER BY source_key) AS warning
FROM (SELECT source_key, row_number() OVER (ORDER BY source_key) AS number, count(*) OVER () AS noisy
      FROM ({operations._AFTER_FETCH}) WHERE consecutive_failures >= 1)
GROUP BY 1""", "fetch_log"))


def next_fire_times_summer(spark: SparkSession, folder: str) -> DataFrame:
    """Next daily run in a zone that changes its clock, over a year: half past two does not exist on one day and comes twice on another."""
    rows = t.table(spark, folder, "events").select(
        "event_id", F.timestamp_micros(F.unix_micros("ts") + F.col("event_id") % 366 * F.lit(86_400_000_000)).alias("at"))
    return rows.select("event_id", F.unix_micros(times.next_fire_time(F.col("at"), 2, 30, "Europe/Berlin")).alias("berlin_us"))


QUERIES["next_fire_times_summer"] = Query(next_fire_times_summer, """
WITH shifted AS (SELECT event_id, ts + to_days(CAST(event_id % 366 AS INTEGER)) AS moment FROM events),
days AS (SELECT event_id, moment, date_trunc('day', moment + CASE WHEN moment >= TIMESTAMP '2024-03-31 01:00:00' AND moment < TIMESTAMP '2024-10-27 01:00:00'
                                                          THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END) AS day FROM shifted),
fires AS (SELECT event_id, moment, [d + INTERVAL 150 MINUTE - CASE WHEN d > TIMESTAMP '2024-03-31' AND d <= TIMESTAMP '2024-10-27'
                                                               THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END
                                FOR d IN [CAST(day AS TIMESTAMP), CAST(day AS TIMESTAMP) + INTERVAL 1 DAY]] AS f FROM days)
SELECT event_id, epoch_us(CASE WHEN f[1] >= moment THEN f[1] ELSE f[2] END) AS berlin_us FROM fires""")
