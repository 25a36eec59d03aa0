"""Vectors and comparisons for column expressions."""

import random
from datetime import datetime, timedelta, timezone
from email.utils import format_datetime
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from weirgate.functions import events, hashing, html, numbers, text, times, urls


def column(spark, values, expression, kind="string"):
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [row[0] for row in frame.select(expression(F.col("x")).alias("y"), "i").orderBy("i").select("y").collect()]


def test_normalize_title(spark):
    values = ["  Hello   WORLD  ", "A  B\x85C", None]
    assert column(spark, values, text.normalize_title) == ["hello world", "a b c", None]


def test_strip_matches_python(spark):
    values = [" \t a b \x1c\n", "　x ", "", " \x85 "]
    assert column(spark, values, text.strip) == [value.strip() for value in values]


@pytest.mark.parametrize("name", ["sanitize_html", "sanitize_markup"])
def test_sanitize_vectors(spark, name):
    run = getattr(html if name == "sanitize_html" else text, name)
    values = ["<p>Hello<script>alert(1)</script><b>World</b></p>", "Alpha&nbsp;&amp;&nbsp;  Beta", None]
    assert column(spark, values, run) == ["HelloWorld", "Alpha & Beta", None]
    assert column(spark, ["abcdefghij"], lambda c: run(c, 5)) == ["abcde"]


def test_sanitize_html_decodes_once_and_drops_comments(spark):
    values = ["a &amp;lt;b&amp;gt; <!-- x -->c", "<style>p{}</style>x &eacute; &#233;", "1 < 2"]
    assert column(spark, values, html.sanitize_html) == ["a &lt;b&gt; c", "x é é", "1 < 2"]


def test_canonical_url_vectors(spark):
    cases = {
        "HTTPS://Example.COM:443/path/article?utm_source=x&b=2&a=1&gclid=1#section":
            "https://example.com/path/article?a=1&b=2",
        "https://example.com": "https://example.com/",
        "https://example.com/a?id=42&ref=manual": "https://example.com/a?id=42&ref=manual",
        "https://münchen.example/path": "https://xn--mnchen-3ya.example/path",
        "http://example.com/a": None, "   ": None, None: None, "https://user@example.com/": None,
        "https://example.com:99999/": None, "https://example.com:8443/x": "https://example.com:8443/x",
        "https://example.com./x?q=a b&q=": "https://example.com/x?q=&q=a+b",
        "https://a..b/x": None,
    }
    assert column(spark, list(cases), urls.canonicalize_url) == list(cases.values())


def test_builtin_url_form_agrees_on_plain_urls(spark):
    values = ["https://a.b/x?b=2&a=1&utm_x=3#f", "https://A.b", "https://a.b:443/?a=&_ga=1", "http://a.b/"]
    assert column(spark, values, text.strip_tracking) == column(spark, values, urls.canonicalize_url)


def test_feed_url_policy(spark):
    cases = [
        ("https://example.com/feed", "example.com", None),
        ("https://EXAMPLE.com.:443/feed", "example.com", None),
        ("http://example.com/feed", "example.com", "feed_url must use HTTPS"),
        ("https://user:pw@example.com/", "example.com", "feed_url must not contain URL credentials"),
        ("https://example.com:0/", "example.com", "feed_url must contain a valid port between 1 and 65535"),
        ("https://example.com:8443/", "example.com", "Feed URL must use the default HTTPS port or explicit port 443"),
        ("https://other.com/", "example.com", "feed_url hostname must exactly match allowed host 'example.com'"),
        ("https://localhost/", "localhost", "Feed URL must not use localhost"),
        ("https://8.8.8.8/", "8.8.8.8", None),
        ("https://100.64.0.1/", "100.64.0.1", "Feed address must be a public unicast IP address"),
        ("https://-bad.com/", "-bad.com", "feed_url must contain a valid hostname"),
    ]
    frame = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(cases)], "i int, u string, h string")
    found = frame.select("i", urls.feed_url_policy(F.col("u"), F.col("h")).alias("p")).orderBy("i").collect()
    assert [row.p for row in found] == [case[2] for case in cases]


def test_public_ip(spark):
    values = ["8.8.8.8", "10.0.0.1", "127.0.0.1", "::ffff:8.8.8.8", "::ffff:10.0.0.1", "2001:4860:4860::8888",
              "fe80::1%eth0", "224.0.0.1", "x", None]
    assert column(spark, values, urls.is_public_ip) == [True, False, False, True, False, True, False, False, False,
                                                        False]


def test_mask_escape_hash(spark):
    assert column(spark, ["test@example.com", "a@b.c"], text.mask_email) == ["te***@example.com", "a***@b.c"]
    assert column(spark, ["<a href=\"x\">'&</a>"], text.escape_html5) == ["&lt;a href=&quot;x&quot;&gt;&#x27;&amp;&lt;/a&gt;"]
    assert column(spark, ["<&>\"", None], text.escape_html3) == ["&lt;&amp;&gt;\"", ""]
    assert column(spark, ["abc"], hashing.url_hash) == [sha256(b"abc").hexdigest()]
    assert column(spark, ["0123456789abcdef", None], text.short_hash) == ["0123456789ab…", "unknown…"]


def test_redaction(spark):
    values = ["key sk-abc_DEF-1 end", "x" * 1600]
    assert column(spark, values, text.redact_secrets) == ["key [REDACTED] end", "x" * 1500]
    bearer = column(spark, [" Authorization: Bearer abc.def, api-key=xyz; token: t1 "],
                    lambda c: text.redact_secrets(c, "bearer"))
    assert bearer == ["Authorization: Bearer [REDACTED], api-key=[REDACTED]; token: [REDACTED]"]


def test_clean_text_and_names(spark):
    assert column(spark, ["a\r\n  b\r​c  ", None], text.clean_text) == ["a\nb\nc", ""]
    assert column(spark, ["Maya  Chen Lee", "Solo"], text.first_name) == ["Maya", "Solo"]
    assert column(spark, ["Maya  Chen Lee", "Solo"], text.last_name) == ["Chen Lee", ""]


def test_headers_and_summaries(spark):
    assert column(spark, ['"abc"', "a\nb", None], text.header_is_safe) == [True, False, True]
    assert column(spark, ["  x ", "   ", None, "y" * 600], text.error_summary) == ["x", None, None, "y" * 500]


def test_log_event(spark):
    frame = spark.createDataFrame([({"event": "a\r\nb", "X-API-Key": "k", "title": "t", "Bot_Token": "z", "n": "1"},)],
                                  "e map<string,string>")
    found = frame.select(events.redact_event(F.col("e")).alias("e")).first().e
    assert found == {"event": "a b", "X-API-Key": "***", "title": "***", "Bot_Token": "***", "n": "1"}


def test_plain_number(spark):
    values = [1.0, 0.8, 0.0001, 1e-7, 1.5e-7, 0.0, 1210.0, 100.8, 12345678.5, -3.25, None]
    assert column(spark, values, numbers.plain_number, "double") == [
        "1", "0.8", "0.0001", "1e-7", "1.5e-7", "0", "1210", "100.8", "12345678.5", "-3.25", "null"]


@pytest.mark.parametrize("digits", [2, 3])
def test_fixed_rounds_the_exact_value(spark, digits):
    chooser = random.Random(7)
    values = [1.005, 0.125, 0.375, 2.675, 0.0005, 1e-9, 0.9999, 53.0, 847.0 - 900.0]
    values += [chooser.uniform(0, 2000) for _ in range(500)]
    values += [round(chooser.uniform(0, 50), digits) + 5 * 10 ** -(digits + 1) for _ in range(500)]
    values += [chooser.randrange(0, 4000) / 8 for _ in range(200)]
    assert column(spark, values, lambda c: numbers.fixed(c, digits), "double") == [f"{v:.{digits}f}" for v in values]


def test_fixed_ties_up(spark):
    assert column(spark, [0.125, 0.375], lambda c: numbers.fixed(c, 2, ties="up"), "double") == ["0.13", "0.38"]


def test_feed_dates(spark):
    chooser = random.Random(3)
    moments = [datetime(2020, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=chooser.randrange(200_000_000))
               for _ in range(50)]
    zone = timezone(timedelta(hours=5, minutes=30))
    mails = [format_datetime(moment) for moment in moments] + [format_datetime(m.astimezone(zone)) for m in moments]
    isos = [moment.isoformat() for moment in moments]
    odd = ["Mon, 01 Jan 2024 10:00:00 EST", "1 Jan 24 10:00 GMT", "2024-01-01T10:00:00", "nonsense", None,
           "Tue, 32 Jan 2024 10:00:00 GMT", "Mon, 01 Jan 2024 10:00:00 GMT (comment)"]
    found = column(spark, mails + isos + odd, lambda c: F.unix_seconds(times.parse_feed_date(c)))
    stamp = [int(moment.timestamp()) for moment in moments]
    ten = int(datetime(2024, 1, 1, 10, tzinfo=timezone.utc).timestamp())
    assert found == stamp * 3 + [ten + 5 * 3600, ten, ten, None, None, None, ten]


def test_freshness_and_age(spark):
    now = datetime(2026, 1, 10, tzinfo=timezone.utc)
    values = [now + timedelta(hours=1), now, now - timedelta(hours=18), now - timedelta(hours=72),
              now - timedelta(hours=73)]
    assert column(spark, values, lambda c: times.freshness(c, now, 72), "timestamp") == [1.0, 1.0, 0.75, 0.0, 0.0]
    old = column(spark, values, lambda c: times.is_too_old(c, now, 72), "timestamp")
    assert old == [False, False, False, False, True]


def test_next_fire_time(spark):
    moment = lambda *parts: datetime(*parts, tzinfo=timezone.utc)
    values = [moment(2026, 1, 10, 5, 0), moment(2026, 1, 10, 7, 0), moment(2026, 1, 10, 7, 0, 1),
              moment(2026, 3, 28, 12, 0)]
    found = column(spark, values, lambda c: F.unix_seconds(times.next_fire_time(c, 9, 0, "Europe/Vilnius")), "timestamp")
    expected = [moment(2026, 1, 10, 7), moment(2026, 1, 10, 7), moment(2026, 1, 11, 7), moment(2026, 3, 29, 6)]
    assert found == [int(value.timestamp()) for value in expected]


def test_durations(spark):
    frame = spark.createDataFrame([(1, 1_000_999, 2_001_000)], "i int, a bigint, b bigint").select(
        F.timestamp_micros("a").alias("a"), F.timestamp_micros("b").alias("b"))
    row = frame.select(times.duration_ms(F.col("a"), F.col("b")).alias("own"),
                       times.fetch_duration_ms(F.col("b"), F.col("a"), F.lit(7)).alias("fetch")).first()
    assert (row.own, row.fetch) == (1000, 7)
