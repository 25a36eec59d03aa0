"""Feeds, entries, insertion, budgets and selection, against small sequential models."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from weirgate.operators import news, state
from weirgate.sources import feeds
from weirgate.sources.config import TopicProfile, load_source_config, load_topic_profile

NOW = datetime(2026, 1, 10, tzinfo=timezone.utc)
PROFILE = TopicProfile(include_keywords=("ai", " Agent "), exclude_keywords=("casino",))

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>
<title>c</title><item><guid isPermaLink="false">g1</guid><title> One </title><link> https://a.com/1?utm_source=x </link>
<description>&lt;p&gt;d&lt;/p&gt;</description><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate><author>Joe</author></item>
<item><title>Two</title><link>https://a.com/2</link><description> </description><content:encoded><![CDATA[<b>x</b>]]></content:encoded></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><id>e1</id><title type="html">A1</title>
<link rel="self" href="https://a.com/self"/><link href="https://a.com/3"/><summary>s</summary>
<author><name>Ann</name></author><updated>2024-01-01T10:00:00Z</updated></entry></feed>"""


def test_feed_bodies(spark):
    tail = "<rss><channel><item><guid>g9</guid><title>T9</title></item></channel></rss> junk <x"
    bodies = spark.createDataFrame([(1, RSS), (2, ATOM), (3, "not a feed"), (4, tail), (5, "<rss><channel/></rss>")],
                                   "n int, body string")
    parsed = feeds.parse_feed_bodies(bodies)
    found = {(row.n, row.entry_index): row for row in parsed.collect()}
    assert set(found) == {(1, 0), (1, 1), (2, 0), (3, None), (4, 0), (5, None)}
    first, second, atom = found[1, 0], found[1, 1], found[2, 0]
    assert (first.external_id, first.title, first.link, first.summary, first.author) == (
        "g1", "One", "https://a.com/1?utm_source=x", "<p>d</p>", "Joe")
    assert (second.external_id, second.summary) == (None, "<b>x</b>")
    assert (atom.external_id, atom.link, atom.author, atom.summary) == ("e1", "https://a.com/3", "Ann", "s")
    assert first.published_at == atom.published_at is not None
    assert {row.n for row in parsed.where("parse_error is not null").collect()} == {3, 5}
    capped = feeds.cap_entries(parsed, 1)
    assert {(row.n, row.entry_index) for row in capped.collect()} == {(1, 0), (2, 0), (3, None), (4, 0), (5, None)}


def test_feed_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text(RSS)
    (tmp_path / "b.xml").write_text("not a feed")
    found = feeds.read_feed_entries(spark, str(tmp_path)).collect()
    assert sorted(str(row.title) for row in found) == ["None", "One", "Two"]
    assert [row.parse_error for row in found if row.title is None] == ["FEED_PARSE_FAILED"]


def test_fetch_outcomes(spark):
    cases = [
        (200, "application/rss+xml", 10, "<x", 1, None, "success", None),
        (200, "text/html; charset=utf-8", 10, "  <?xml", 1, None, "success", None),
        (200, "text/html", 10, "<html", 1, None, "failed", "FEED_PARSE_FAILED"),
        (200, None, 10, "<html", 1, None, "success", None),
        (304, None, None, None, None, None, "not_modified", None),
        (429, None, None, None, None, None, "failed", "FEED_CONNECTION_FAILED"),
        (302, None, None, None, None, None, "failed", "FEED_CONNECTION_FAILED"),
        (200, "text/xml", 101, "<rss", 1, None, "failed", "FEED_RESPONSE_TOO_LARGE"),
        (200, "text/xml", 10, "<rss", 0, None, "failed", "FEED_PARSE_FAILED"),
        (None, None, None, None, None, "FEED_TIMEOUT", "failed", "FEED_TIMEOUT"),
    ]
    frame = spark.createDataFrame(
        [(i, *case[:6]) for i, case in enumerate(cases)], "n int, http_status int, content_type string, "
        "body_bytes int, body_prefix string, entries_count int, error_code string")
    found = feeds.classify_fetch(frame, 100).orderBy("n").collect()
    assert [(row.fetch_status, row.error_code) for row in found] == [case[6:] for case in cases]


def test_entries_become_items(spark):
    entries = spark.createDataFrame([
        (1, "g1", "https://a.com/1?utm_source=x", "One &amp; only", "<p>Body</p>"),
        (2, "g2", "https://b.com/2", "Two", "x"), (3, "g3", "http://a.com/3", "Three", "x"),
        (4, "g4", "https://a.com/4", "  ", "x"), (5, "g5", "https://a.com/5", "Five", "<script>x</script>"),
        (6, "g6", "https://a.com/6", "<b></b>", "<i></i>"), (7, "g7", "HTTPS://A.com/7", "Seven", None)],
        "n int, external_id string, link string, title string, summary string").withColumns({
            "source_key": F.lit("s"), "author": F.lit(""), "published_at": F.lit(None).cast("timestamp")})
    sources = spark.createDataFrame([("s", "A.com.")], "source_key string, allowed_host string")
    found = {row.n: row for row in news.normalize_entries(entries, sources, F.lit(NOW)).collect()}
    assert {n: row.skip_reason for n, row in found.items()} == {
        1: None, 2: "foreign_host", 3: "invalid_url", 4: "missing_title_or_link", 5: None, 6: "empty_text", 7: None}
    assert found[1].canonical_url == "https://a.com/1" and found[1].sanitized_summary == "Body"
    assert found[1].original_url == "https://a.com/1?utm_source=x"
    assert found[5].sanitized_summary == "Five" and found[7].author is None


def admit_model(rows):
    urls, externals, admitted = set(), set(), []
    for url, external in rows:
        fresh = url not in urls and (external is None or external not in externals)
        if fresh:
            urls.add(url)
            externals |= {external} - {None}
        admitted.append(fresh)
    return admitted


@pytest.mark.parametrize("seed,rows,keys", [(1, 12, 4), (2, 40, 8), (3, 120, 30), (4, 200, 3), (5, 60, 60)])
def test_admission_equals_the_walk(spark, seed, rows, keys):
    chooser = random.Random(seed)
    data = [(f"u{chooser.randrange(keys)}", chooser.choice([None, *[f"e{i}" for i in range(keys)]]))
            for _ in range(rows)]
    frame = spark.createDataFrame([(i, *pair) for i, pair in enumerate(data)], "n int, url_hash string, ext_key string")
    found = news.admit_in_batch(frame.repartition(3), "n").orderBy("n").collect()
    assert [row.admitted for row in found] == admit_model(data)


def test_admission_of_a_chain(spark):
    data = [(f"u{i // 2}", f"e{(i + 1) // 2}") for i in range(9)]
    frame = spark.createDataFrame([(i, *pair) for i, pair in enumerate(data)], "n int, url_hash string, ext_key string")
    found = news.admit_in_batch(frame, "n").orderBy("n").collect()
    assert [row.admitted for row in found] == admit_model(data)


@pytest.mark.parametrize("budget", [1, 7, 100])
def test_budget_equals_the_walk(spark, budget):
    chooser = random.Random(budget)
    data = [(i, chooser.randrange(5), chooser.random() < 0.5) for i in range(80)]
    expected, left = {}, budget
    for n, priority, fresh in sorted(data, key=lambda row: (-row[1], row[0])):
        expected[n] = "over_budget" if left <= 0 else ("inserted" if fresh else "duplicate")
        left -= fresh and left > 0
    frame = spark.createDataFrame(data, "n int, priority int, fresh boolean")
    found = news.insert_budget(frame, F.struct((-F.col("priority")).alias("p"), "n"), F.col("fresh"), budget)
    assert {row.n: row.outcome for row in found.collect()} == expected


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_diversity_equals_the_walk(spark, seed):
    chooser = random.Random(seed)
    data = [(f"{i:03d}", f"s{chooser.randrange(6)}", chooser.randrange(8) / 8) for i in range(90)]
    expected, taken = [], {}
    for key, source, score in sorted(data, key=lambda row: (-row[2], row[0])):
        if taken.get(source, 0) < 3 and len(expected) < 10:
            taken[source] = taken.get(source, 0) + 1
            expected.append(key)
    frame = spark.createDataFrame(data, "news_item_id string, source_key string, score double")
    assert [row.news_item_id for row in news.diversify(frame, 3, 10).collect()] == expected


def item(key, title="An agent for everyone", summary="word " * 10, status="collected", age=1.0, source="s1"):
    return (key, source, title, summary, status, None, NOW - timedelta(hours=age), NOW - timedelta(hours=age))


ITEM_SCHEMA = ("news_item_id string, source_key string, title string, sanitized_summary string, status string, "
               "ignore_reason string, published_at timestamp, collected_at timestamp")
SOURCES = [("s1", 5, True), ("s2", 10, False)]


def test_reasons_and_scores(spark):
    items = spark.createDataFrame([
        item("a"), item("b", status="used"), item("c", age=72.0), item("d", age=72.1), item("e", title="short"),
        item("f", summary="tiny"), item("g", summary="Casino " + "word " * 10), item("h", source="s2"),
        item("i", source="none"), item("j", title="Send an email to AGENT")], ITEM_SCHEMA)
    sources = spark.createDataFrame(SOURCES, "source_key string, priority int, enabled boolean")
    found = {row.news_item_id: row for row in news.score_items(items, sources, PROFILE, NOW).collect()}
    assert {key: row.ignore_reason for key, row in found.items()} == {
        "a": None, "b": "irrelevant", "c": None, "d": "too_old", "e": "missing_title", "f": "missing_content",
        "g": "irrelevant", "h": "irrelevant", "i": "irrelevant", "j": None}
    assert found["a"].score == (0.45 * 0.5) + (0.30 * (1.0 - 1 / 72)) + (0.25 * 0.5)
    assert found["j"].score == (0.45 * 1.0) + (0.30 * (1.0 - 1 / 72)) + (0.25 * 0.5)
    assert found["c"].score == (0.45 * 0.5) + (0.30 * 0.0) + (0.25 * 0.5)
    eligible = news.eligible_items(items, NOW, 72, limit=3).collect()
    assert [row.news_item_id for row in eligible] == ["a", "e", "f"]


def test_selection_is_saved(spark):
    items = spark.createDataFrame([item("a"), item("b", title="short"), item("c", status="candidate"), item("d"),
                                   item("e", status="used")], ITEM_SCHEMA)
    sources = spark.createDataFrame(SOURCES, "source_key string, priority int, enabled boolean")
    scored = news.score_items(items, sources, PROFILE, NOW)
    after = state.persist_selection(items, scored, news.diversify(scored, 3, 1)).collect()
    assert {row.news_item_id: (row.status, row.ignore_reason) for row in after} == {
        "a": ("candidate", None), "b": ("ignored", "missing_title"), "c": ("candidate", None),
        "d": ("collected", None), "e": ("used", None)}


STORED = [("i1", "s", "e1", "u1"), ("i2", "s", None, "u2"), ("i3", "s", "e3", "u3")]
ARRIVING = [("n1", "s", "e1", "u9", "duplicate", "i1"), ("n2", "t", "e1", "u9", "new", None),
            ("n3", "s", None, "u2", "duplicate", "i2"), ("n4", "s", None, "u9", "new", None),
            ("n5", "s", "e1", "u3", "conflict", None), ("n6", "s", "e3", "u3", "duplicate", "i3")]


def test_insert_if_new(spark):
    fields = "news_item_id string, source_key string, external_id string, url_hash string"
    stored = spark.createDataFrame(STORED, fields)
    arriving = spark.createDataFrame([row[:4] for row in ARRIVING], fields)
    found = {row.news_item_id: (row.outcome, row.matched_id) for row in news.insert_if_new(arriving, stored).collect()}
    assert found == {row[0]: row[4:] for row in ARRIVING}
    with pytest.raises(Exception, match="deduplication keys"):
        news.insert_if_new(arriving, stored, on_conflict="fail").collect()


def test_unchanged_bodies(spark):
    from weirgate.functions.hashing import body_validator
    bodies = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x")], "source_key string, body string")
    stored = bodies.limit(1).select("source_key", body_validator(F.col("body")).alias("stored_etag")).unionByName(
        spark.createDataFrame([("b", '"old"')], "source_key string, stored_etag string"))
    found = {row.source_key: (row.unchanged, row.http_status) for row in feeds.detect_unchanged(bodies, stored).collect()}
    assert found == {"a": (True, 304), "b": (False, 200), "c": (False, 200)}


CONFIG = """
version: 1
defaults: {enabled: true, max_items_per_run: 20}
sources:
  - {key: " One ", name: N, url: "https://a.com/f", allowed_host: A.com, category: c, priority: 7.5}
  - {key: two, name: M, url: "https://b.com/f", allowed_host: b.com, category: c, enabled: false, max_items_per_run: 5}
"""


def test_configuration(spark, tmp_path):
    path = tmp_path / "feeds.yaml"
    path.write_text(CONFIG)
    rows = {row.source_key: row for row in load_source_config(spark, str(path)).collect()}
    assert rows["one"].allowed_host == "a.com" and float(rows["one"].priority) == 7.5
    assert (rows["one"].enabled, rows["one"].max_items_per_run, rows["one"].request_timeout_seconds) == (True, 20, 15)
    assert (rows["two"].enabled, rows["two"].max_items_per_run) == (False, 5)
    path.write_text(CONFIG.replace("key: two", "key: ONE"))
    with pytest.raises(ValueError):
        load_source_config(spark, str(path))
    path.write_text("version: 1\nname: p\ninclude_keywords: [' AI ', '']\nmin_title_length: 3\n")
    profile = load_topic_profile(str(path))
    assert profile.include_keywords == ("ai",) and profile.min_title_length == 3
    with pytest.raises(ValueError):
        TopicProfile(include_keywords=(" ",))


def test_limits(spark):
    sources = spark.createDataFrame([("a",), ("b",), ("c",)], "source_key string")
    config = spark.createDataFrame([("a", 5, 30), ("b", 80, 10)],
                                   "source_key string, max_items_per_run int, request_timeout_seconds int")
    found = {row.source_key: (row.max_entries, row.read_timeout_seconds)
             for row in news.resolve_limits(sources, config, 60, 15).collect()}
    assert found == {"a": (5, 30.0), "b": (50, 10.0), "c": (50, 15.0)}
