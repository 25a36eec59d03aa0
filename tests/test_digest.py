"""Digest validation, rendering, splitting and delivery."""

import html
import json
import random

from pyspark.sql import functions as F

from weirgate import schemas
from weirgate.operators import delivery, digest

SUMMARY = "A clear summary that is long enough for the rules, because it says what happened and why it matters."


def lines_frame(spark, rows):
    return spark.createDataFrame(
        rows, "digest_id int, position int, title string, tag string, summary string, canonical_url string, "
        "source_name string, missing_parent boolean")


def test_exact_text(spark):
    lines = lines_frame(spark, [(1, 1, "Launch notes", "PRODUCT", SUMMARY, "https://example.com/launch", "Publisher",
                                 False)])
    row = digest.render_digest(digest.digest_blocks(lines).withColumn("digest_title", F.lit(" Daily Digest "))).first()
    assert row.rendered_text == (
        "🗞 <b>Daily Digest</b>\n\n<b>1. Launch notes</b>\n<blockquote>🏷 PRODUCT</blockquote>\n" + SUMMARY
        + '\n↗ <a href="https://example.com/launch">Read on Publisher</a>\n\n'
        "1 stories · AI-generated digest\nAlways verify details at the original source.\n")


def block_of(line):
    _, position, title, tag, summary, url, source, _ = line
    return "\n".join((
        f"<b>{position}. {html.escape(title)}</b>", f"<blockquote>🏷 {tag}</blockquote>", html.escape(summary),
        f'↗ <a href="{html.escape(url)}">Read on {html.escape(source)}</a>'))


def parts_model(title, blocks, limit):
    head, foot = f"🗞 <b>{html.escape(title)}</b>\n\n", (
        f"\n\n{len(blocks)} stories · AI-generated digest\nAlways verify details at the original source.")
    room = limit - len(head) - len(foot) - 1
    if any(len(block) > room for block in blocks):
        return None
    groups = []
    for block in blocks:
        if groups and len(groups[-1]) + 3 + len(block) <= room:
            groups[-1] += "\n\n\n" + block
        else:
            groups.append(block)
    return [(head if i == 0 else "") + group + (foot if i == len(groups) - 1 else "") + "\n"
            for i, group in enumerate(groups)]


def test_split_equals_the_greedy_model(spark):
    chooser, rows, expected = random.Random(5), [], {}
    for key in range(300):
        lines = [(key, place, "T<" + "x" * chooser.randrange(40), "PRODUCT", "s&🗞" * chooser.randrange(5, 90),
                  "https://a.com/?a=1&b=2", "S\"", False) for place in range(1, chooser.randrange(2, 9))]
        rows += lines
        expected[key] = parts_model("Day & <night>", [block_of(line) for line in lines], 700)
    frame = digest.digest_blocks(lines_frame(spark, rows)).withColumn("digest_title", F.lit("Day & <night>"))
    found = {row.digest_id: row for row in digest.split_messages(frame, 700).collect()}
    assert {key: row.parts for key, row in found.items()} == expected
    failed = [key for key, parts in expected.items() if parts is None]
    assert failed and all(found[key].split_error for key in failed)
    assert all(len(part) <= 700 for parts in expected.values() if parts for part in parts)


def outputs(spark, items, key=1):
    data = {"digest_title": "t", "items": [
        {"candidate_id": name, "summary": summary, "tag": tag, "relevance_score": 0.5, "selection_reason": "r"}
        for name, summary, tag in items]}
    return spark.createDataFrame([(key, key, json.dumps(data))], "digest_id int, run_id int, text string").withColumn(
        "output", F.from_json("text", schemas.DIGEST_OUTPUT))


def contexts(spark, states):
    return spark.createDataFrame([(1, f"c_{i:02d}", f"n{i}", status) for i, status in enumerate(states, start=1)],
                                 "run_id int, candidate_id string, news_item_id string, status string")


def check(spark, items, states):
    return digest.validate_digest_output(outputs(spark, items), contexts(spark, states))


def test_validation_collects_all_errors(spark):
    items = [("c_01", SUMMARY, "PRODUCT"), ("c_01", "short", "PRODUCT"), ("c_99", SUMMARY, "PRODUCT"),
             ("c_02", SUMMARY + " www.x.org", "PRODUCT"), ("c_03", SUMMARY, "NEWS"), ("c_04", SUMMARY, "OTHER")]
    row = check(spark, items, ["candidate", "used", "collected", "candidate"]).first()
    assert row.errors == [
        "item count must be between 3 and 4, got 6", "duplicate candidate_id c_01",
        "summary length must be between 80 and 280 characters", "unknown candidate_id c_99",
        "candidate c_02 was already used", "summary must not contain URLs, HTML, or Telegram markup",
        "candidate c_03 is not in candidate status", "invalid tag for c_03"]
    assert not row.accepted and row.news_ids is None


def test_accepted_output_becomes_items(spark):
    items = [("c_03", SUMMARY, "PRODUCT"), ("c_01", SUMMARY, "OTHER"), ("c_02", SUMMARY, "RESEARCH")]
    checked = check(spark, items, ["candidate"] * 6)
    assert checked.first().accepted
    rows = digest.accepted_items(checked).orderBy("position").collect()
    assert [(row.position, row.news_item_id, row.tag) for row in rows] == [
        (1, "n3", "PRODUCT"), (2, "n1", "OTHER"), (3, "n2", "RESEARCH")]


def test_few_candidates_lower_the_bounds(spark):
    assert check(spark, [("c_01", SUMMARY, "OTHER")], ["candidate"]).first().accepted
    none = digest.validate_digest_output(outputs(spark, [("c_01", SUMMARY, "OTHER")]), contexts(spark, ["candidate"])
                                         .where("run_id = 2")).first()
    assert none.errors == ["item count must be between 0 and 0, got 1", "unknown candidate_id c_01"]


def test_error_text(spark):
    frame = spark.createDataFrame([(["a", "b" * 600],)], "e array<string>")
    assert frame.select(digest.validation_error_text(F.col("e"))).first()[0] == ("- a\n- " + "b" * 600)[:500]


def test_positions(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (2, 1, "b"), (3, 1, "a"), (3, 2, "a"), (4, 2, "a"), (4, 3, "b")]
    rows += [(5, n, f"n{n}") for n in range(1, 9)]
    frame = spark.createDataFrame(rows, "digest_id int, position int, news_item_id string")
    found = {row.digest_id: row.position_error for row in digest.check_positions(frame).collect()}
    assert found == {1: None, 2: "Digest item positions must be unique", 3: "Digest news items must be unique",
                     4: "Digest item positions must be consecutive starting at 1",
                     5: "Digest must contain between 1 and 7 items"}


def test_consumption_is_all_or_nothing(spark):
    items = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "x"), (3, "d")], "digest_id int, news_item_id string")
    news = spark.createDataFrame([("a", "candidate"), ("b", "candidate"), ("c", "candidate"), ("d", "used")],
                                 "news_item_id string, status string")
    created, after = digest.consume_candidates(items, news)
    assert {row.digest_id: row.error for row in created.collect()} == {
        1: None, 2: "One or more selected news items do not exist.",
        3: "All selected news items must have candidate status."}
    assert {row.news_item_id: row.status for row in after.collect()} == {
        "a": "used", "b": "used", "c": "candidate", "d": "used"}


def test_payload_is_the_json_python_writes(spark):
    rows = [("n1", "Z \"q\"", "T\n1", "s" * 1600, 0.1235, "2026-01-01 10:00:00"), ("n2", "é", "T2", "x", 0.9, None)]
    frame = spark.createDataFrame(rows, "news_item_id string, source_name string, title string, "
                                  "sanitized_summary string, score double, at string").withColumns({
                                      "published_at": F.to_timestamp("at"), "run_id": F.lit(1)})
    text = digest.article_payload(digest.candidate_ids(frame)).first().articles_json
    articles = [
        {"candidate_id": "c_01", "source_name": "é", "title": "T2", "summary": "x", "published_at": "",
         "relevance_score": "0.900"},
        {"candidate_id": "c_02", "source_name": "Z \"q\"", "title": "T\n1", "summary": "s" * 1500,
         "published_at": "2026-01-01T10:00:00+00:00", "relevance_score": f"{0.1235:.3f}"}]
    assert text == json.dumps({"articles": articles}, ensure_ascii=False)


def test_delivery(spark):
    attempts = spark.createDataFrame(
        [(1, 1, 1, 0, "failed", "TELEGRAM_TIMEOUT", None), (1, 1, 2, 1, "sent", None, None),
         (1, 2, 1, 0, "failed", "TELEGRAM_RATE_LIMITED", 7), (1, 2, 2, 2, "failed", "TELEGRAM_TIMEOUT", None),
         (2, 1, 1, 1, "failed", "TELEGRAM_PERMANENT_FAILURE", None), (2, 1, 5, 1, "failed", "TELEGRAM_TIMEOUT", 0)],
        "digest_id int, part_number int, attempt_number int, trial int, status string, error_code string, "
        "retry_after_seconds int")
    parts = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "digest_id int, part_number int")
    progress = {row.digest_id: (row.parts_total, row.parts_sent, row.max_attempt, row.delivered)
                for row in delivery.delivery_progress(parts, attempts).collect()}
    assert progress == {1: (2, 1, 2, False), 2: (1, 0, 5, False), 3: (1, 0, 0, False)}
    unsent = {(row.digest_id, row.part_number) for row in delivery.unsent_parts(parts, attempts).collect()}
    assert unsent == {(1, 2), (2, 1), (3, 1)}
    nexts = {(row.digest_id, row.part_number): row.next_attempt for row in delivery.part_progress(attempts).collect()}
    assert nexts == {(1, 1): 3, (1, 2): 3, (2, 1): 6}
    planned = [(row.decision, row.delay_seconds) for row in delivery.attempt_history(
        delivery.retry_schedule(attempts)).collect()]
    assert planned == [("retry", 1.0), ("done", None), ("retry", 7.0), ("fail_digest", None), ("fail_digest", None),
                       ("retry", 2.0)]


def test_missing_parents(spark):
    items = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (1, 3, 12)], "digest_id int, position int, news_item_id int")
    news = spark.createDataFrame([(10, "s", "t", "u"), (11, "none", "t", "u")],
                                 "news_item_id int, source_key string, title string, canonical_url string")
    sources = spark.createDataFrame([("s", "S")], "source_key string, name string")
    found = {row.news_item_id: row.missing_parent for row in digest.digest_lines(items, news, sources).collect()}
    assert found == {10: False, 11: True, 12: True}


def test_tasks_of_digests_follow_the_rows(spark, folder, monkeypatch):
    """Texts are sorted in tasks of bounded size, whatever the number of shuffle partitions, and once."""
    from weirgate.plans import digests, tables

    monkeypatch.setattr(tables, "TASK_ROWS", 100, raising=False)
    rows = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    items = tables.digest_items(spark, folder).groupBy(F.spark_partition_id().alias("task")).count()
    assert max(row["count"] for row in items.collect()) < max(500, rows // 10)
    blocks = digests._blocks(spark, folder)
    plan = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [digest_id" in plan and f", {-(-rows // 100)}" in plan
    assert blocks.count() == tables.digest_items(spark, folder).select("digest_id").distinct().count()
