"""Running states, transitions, upserts, rules and clean-up."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from weirgate import constants as C
from weirgate.operators import quality, runs, state
from weirgate.operators.scan import with_bucket

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def history(seed, values, rows=400, keys=4):
    """Random events; the first key owns about half of all rows."""
    chooser = random.Random(seed)
    return [(f"k{max(0, chooser.randrange(keys * 2) - keys)}", i, START + timedelta(minutes=chooser.randrange(3000)),
             chooser.choice(values)) for i in range(rows)]


def by_key(data):
    grouped = {}
    for key, number, at, value in data:
        grouped.setdefault(key, []).append((at, number, value))
    return {key: sorted(rows) for key, rows in grouped.items()}


@pytest.mark.parametrize("bucket_seconds", [600, 7200, 10 ** 9, None])
def test_streaks_equal_the_walk(spark, bucket_seconds):
    data = history(1, ["failed", "failed", "failed", "success", "not_modified"])
    expected = {}
    for rows in by_key(data).values():
        streak = 0
        for _, number, value in rows:
            streak = streak + 1 if value == "failed" else 0
            expected[number] = streak
    frame = spark.createDataFrame(data, "source_key string, fetch_id int, finished_at timestamp, fetch_status string")
    found = runs.failure_streak(frame, bucket_seconds=bucket_seconds)
    assert {row.fetch_id: row.failure_streak for row in found.collect()} == expected


@pytest.mark.parametrize("bucket_seconds", [600, 7200, 10 ** 9, None])
def test_transitions_equal_the_walk(spark, bucket_seconds):
    data = history(2, list(C.DIGEST_STATUSES))
    expected = {}
    for key, rows in by_key(data).items():
        errors = [f"Invalid digest state transition: '{old}' -> '{new}'"
                  for (_, _, old), (_, _, new) in zip(rows, rows[1:]) if (old, new) not in C.TRANSITIONS["digest"]]
        expected[key] = (len(rows) - 1, len(errors), errors[0] if errors else None)
    frame = spark.createDataFrame(data, "entity_id string, event_id int, changed_at timestamp, status string")
    found = state.check_transitions(frame, "digest", bucket_seconds=bucket_seconds)
    assert {row.entity_id: (row.changes, row.invalid_changes, row.first_error) for row in found.collect()} == expected


def test_one_instant_is_split_too(spark):
    """All rows of the hot key carry the same time: the range cut goes by the tie and no piece holds most rows."""
    data = [("hot" if i % 3 else f"k{i % 5}", i, START, "success" if i % 50 == 0 else "failed") for i in range(3000)]
    expected = {}
    for rows in by_key(data).values():
        streak = 0
        for _, number, value in rows:
            streak = streak + 1 if value == "failed" else 0
            expected[number] = streak
    frame = spark.createDataFrame(data, "source_key string, fetch_id int, finished_at timestamp, fetch_status string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = runs.failure_streak(frame, bucket_seconds=None)
        pieces = with_bucket(frame, "source_key", "finished_at", "fetch_id", None).groupBy("source_key", "_bucket").count()
        largest = pieces.agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {row.fetch_id: row.failure_streak for row in found.collect()} == expected
    assert largest <= 1000


@pytest.mark.parametrize("entity,statuses", [
    ("pipeline run", C.RUN_STATUSES), ("news item", C.NEWS_STATUSES), ("digest", C.DIGEST_STATUSES)])
def test_whole_transition_matrix(spark, entity, statuses):
    pairs = [(old, new) for old in statuses for new in statuses]
    frame = spark.createDataFrame(pairs, "a string, b string")
    found = frame.select("a", "b", state.transition_error(entity, F.col("a"), F.col("b")).alias("e")).collect()
    for row in found:
        allowed = (row.a, row.b) in C.TRANSITIONS[entity]
        assert row.e == (None if allowed else f"Invalid {entity} state transition: '{row.a}' -> '{row.b}'")


def test_apply_transitions(spark):
    rows = spark.createDataFrame([(i, "collected", None) for i in range(5)],
                                 "news_item_id int, status string, ignore_reason string")
    requests = spark.createDataFrame([(0, "candidate", None), (1, "ignored", "too_old"), (2, "ignored", None),
                                      (3, "used", None)], "news_item_id int, target_status string, request_reason string")
    found = {row.news_item_id: row for row in state.apply_transitions(rows, requests).collect()}
    assert [(found[i].status, found[i].ignore_reason) for i in range(5)] == [
        ("candidate", None), ("ignored", "too_old"), ("collected", None), ("collected", None), ("collected", None)]
    assert found[2].transition_error == "ignore_reason is required when ignoring a news item"
    assert found[3].transition_error == "Invalid news item state transition: 'collected' -> 'used'"
    assert found[4].transition_error is None


def test_source_sync(spark):
    fields = ("source_key string, name string, feed_url string, allowed_host string, category string, "
              "language string, enabled boolean, priority int")
    stored = spark.createDataFrame([("a", "A", "u", "a.com", "c", "en", True, 5), ("b", "B", "u", "b.com", "c", "en", True, 5),
                                    ("c", "C", "u", "c.com", "c", "en", True, 5)], fields).withColumn("etag", F.lit("e"))
    config = spark.createDataFrame([("a", "A2", "v", "a.com", "d", "de", False, 9), ("b", "B2", "v", "moved.com", "d", "de", True, 9),
                                    ("n", "N", "v", "n.com", "d", "de", True, 1)], fields)
    found = {row.source_key: row for row in state.upsert_sources(stored, config).collect()}
    assert {key: row.change for key, row in found.items()} == {
        "a": "updated", "b": "rejected", "c": "kept", "n": "inserted"}
    assert (found["a"].name, found["a"].enabled, found["a"].priority, found["a"].etag) == ("A2", False, 9, "e")
    assert (found["b"].name, found["b"].allowed_host) == ("B", "b.com") and found["b"].sync_error
    assert found["n"].etag is None and found["n"].allowed_host == "n.com"
    stamped = stored.withColumns({name: F.lit(START) for name in ("created_at", "updated_at")})
    later = START + timedelta(days=1)
    times = {row.source_key: (row.created, row.updated) for row in state.upsert_sources(stamped, config, F.lit(later)).select(
        "source_key", (F.col("created_at") == F.lit(later)).alias("created"),
        (F.col("updated_at") == F.lit(later)).alias("updated")).collect()}
    assert times == {"a": (False, True), "b": (False, False), "c": (False, False), "n": (True, True)}


def test_fetches_update_sources(spark):
    sources = spark.createDataFrame([("a", "old", 2), ("b", "old", 2), ("c", "old", 2)],
                                    "source_key string, etag string, consecutive_failures int").withColumns(
        {"last_checked_at": F.lit(None).cast("timestamp"), "last_success_at": F.lit(None).cast("timestamp")})
    rows = [("a", 1, "failed", None), ("a", 2, "success", "new"), ("a", 3, "not_modified", None), ("a", 4, "failed", None),
            ("b", 5, "failed", None), ("b", 6, "failed", None)]
    fetches = spark.createDataFrame([(*row, START + timedelta(minutes=row[1])) for row in rows],
                                    "source_key string, fetch_id int, fetch_status string, etag string, finished_at timestamp")
    stamped = runs.apply_fetch_results(sources.withColumn("updated_at", F.lit(None).cast("timestamp")), fetches)
    assert {row.source_key for row in stamped.where("updated_at = last_checked_at").collect()} == {"a", "b"}
    found = {row.source_key: row for row in runs.apply_fetch_results(sources, fetches).collect()}
    assert [(found[key].etag, found[key].consecutive_failures) for key in "abc"] == [("new", 1), ("old", 4), ("old", 2)]
    assert found["b"].last_success_at is None and found["c"].last_checked_at is None
    assert runs.noisy_feeds(runs.apply_fetch_results(sources, fetches), 2).first().warning == (
        "One or more feeds exceeded the consecutive failure threshold: b, c")
    assert runs.noisy_feeds(runs.apply_fetch_results(sources, fetches), 9).first().warning is None


def test_run_status(spark):
    cases = [((3, 0, 5, None, False), "success"), ((3, 1, 5, None, False), "partial_success"),
             ((3, 1, 2, "X", False), "no_content"), ((3, 1, 5, "X", False), "failed"), ((0, 0, 0, None, False), "no_content"),
             ((3, 0, 5, None, True), "skipped_locked")]
    frame = spark.createDataFrame([(i, *case) for i, (case, _) in enumerate(cases)],
                                  "n int, total int, failed int, candidates int, code string, locked boolean")
    status = runs.run_status(F.col("total"), F.col("failed"), F.col("candidates"), 3, F.col("code"), F.col("locked"))
    assert [row.s for row in frame.select("n", status.alias("s")).orderBy("n").collect()] == [s for _, s in cases]


def test_status_view_of_an_empty_history(spark, folder):
    from weirgate.plans import tables
    none = runs.status_view(tables.pipeline_runs(spark, folder).where("false"), tables.digests(spark, folder).where("false"))
    row = none.collect()
    assert len(row) == 1 and set(row[0]) == {None}


def test_row_rules(spark):
    fields = ("status string, error_code string, error_summary string, http_status int, entries_count int, "
              "duration_ms int, started_at timestamp, finished_at timestamp")
    later = START + timedelta(seconds=1)
    cases = [
        (("success", None, None, 200, 3, 5, START, later), []),
        (("success", None, None, 304, 3, 5, START, later), ["success_http_valid"]),
        (("success", None, None, None, 3, 5, START, later), ["success_http_valid"]),
        (("not_modified", None, None, 304, 1, 5, START, later), ["not_modified_result_valid"]),
        (("failed", None, None, None, 0, 5, START, later), ["error_matches_status"]),
        (("failed", "FEED_TIMEOUT", None, 99, 0, -1, later, START),
         ["duration_non_negative", "completion_time_valid", "http_status_valid"]),
        (("odd", None, "x", None, 0, 5, START, later), ["status_known", "error_matches_status"]),
    ]
    frame = spark.createDataFrame([case for case, _ in cases], fields).coalesce(1).withColumn(
        "n", F.monotonically_increasing_id())
    checked = quality.check_rules(frame, "feed_fetches")
    assert [row.failed_rules for row in checked.orderBy("n").collect()] == [names for _, names in cases]
    assert {row.rule: row.rows for row in quality.rule_summary(checked).collect()}["success_http_valid"] == 2


def test_attempt_rules(spark):
    fields = ("status string, message_id bigint, http_status int, retry_after_seconds int, error_code string, "
              "error_summary string, started_at timestamp, finished_at timestamp, part_number int, attempt_number int")
    cases = [
        (("pending", None, None, None, None, None, START, None, 1, 1), []),
        (("pending", 5, None, None, None, None, START, None, 1, 1), ["result_matches_status"]),
        (("sent", 5, 200, None, None, None, START, START, 1, 1), []),
        (("sent", None, 200, None, None, None, START, START, 1, 1), ["result_matches_status"]),
        (("failed", None, 429, 3, "TELEGRAM_RATE_LIMITED", None, START, START, 1, 0), ["numbering_positive"]),
    ]
    frame = spark.createDataFrame([case for case, _ in cases], fields).coalesce(1).withColumn(
        "n", F.monotonically_increasing_id())
    found = quality.check_rules(frame, "delivery_attempts").orderBy("n").collect()
    assert [row.failed_rules for row in found] == [names for _, names in cases]


@pytest.mark.parametrize("table", ["feed_sources", "pipeline_runs", "digests", "feed_fetches", "news_items",
                                   "delivery_attempts", "digest_items"])
def test_rule_names_are_unique(spark, table):
    names = [name for name, _ in quality.rule_catalogue(table)]
    assert names and len(set(names)) == len(names)


def test_keys_and_references(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "b")], "k int, e string")
    assert [tuple(row) for row in quality.check_unique(rows, ["k", "e"]).collect()] == [(1, "a", 2)]
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, parent int")
    parent = spark.createDataFrame([(10,)], "pid int")
    assert [row.id for row in quality.orphans(child, parent, "parent", "pid").collect()] == [2]
    effect = quality.cascade_effect(parent.select(F.col("pid").alias("key")), "key", [
        ("c1", child, "parent", "cascade"), ("c2", child, "parent", "restrict")]).collect()
    assert [(row.child_table, row.child_rows, row.blocked_parents) for row in effect] == [("c1", 1, 0), ("c2", 1, 1)]


def test_saved_runs_are_final(spark):
    fields = "run_id int, trigger_type string, status string, n int"
    before = spark.createDataFrame([(1, "manual", "running", 1), (2, "manual", "success", 1), (3, "manual", "success", 1),
                                    (4, "manual", "running", 1)], fields)
    after = spark.createDataFrame([(1, "manual", "success", 2), (2, "manual", "success", 2), (3, "manual", "success", 1),
                                   (4, "dry_run", "running", 1)], fields)
    found = state.terminal_immutability(before, after, "run_id", ["trigger_type"], "running", ["n"])
    assert {row.run_id: row.violation for row in found.collect()} == {2: "terminal", 4: "identity"}


def test_secrets_and_contracts(spark):
    texts = spark.createDataFrame([(1, "x sk-" + "a" * 24 + " bearer " + "b" * 20), (2, "12345678:" + "c" * 30), (3, "clean")],
                                  "id int, text string")
    found = {(row.id, row.label): row.matches for row in quality.scan_secrets(texts, "id", "text").collect()}
    assert found == {(1, "OpenAI key"): 1, (1, "Bearer token"): 1, (2, "Telegram bot token"): 1}
    assert quality.header_mismatch(texts, ("id", "text")) == []
    assert quality.header_mismatch(texts, ("text", "id")) == ["order"]
    assert quality.header_mismatch(texts, ("id", "x")) == ["missing:x", "unexpected:text"]
    keyed = spark.createDataFrame([("demo-1", "a"), ("demo-1", None), ("HOT-2", "b")], "k string, name string")
    errors = sorted(tuple(row.contract_errors) for row in quality.check_contract(keyed, "k", ("name",)).collect())
    assert errors == [("leaks:hot",), ("missing:name", "repeated_key"), ("repeated_key",)]


def test_clean_up(spark):
    rows = spark.createDataFrame([(1, START), (2, START + timedelta(days=2)), (3, None)], "id int, finished_at timestamp")
    cutoff = F.lit(START + timedelta(days=1))
    assert sorted(row.id for row in runs.purge(rows, cutoff).collect()) == [2, 3]
    assert [row.old_rows for row in runs.retention_counts(rows, rows, cutoff).collect()] == [1, 1]
    with pytest.raises(ValueError):
        runs.purge(rows, cutoff, older_than_days=0)
