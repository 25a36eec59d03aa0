"""News queries: selection, insertion, normalisation, sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirgate.functions import hashing, html, text, times, urls
from weirgate.operators import news, runs, state
from weirgate.plans import sql, tables as t
from weirgate.plans.registry import Query
from weirgate.session import shared_folder
from weirgate.sources import feeds

QUERIES: dict[str, Query] = {}


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return news.score_items(t.news_items(spark, folder), t.feed_sources(spark, folder), t.PROFILE, t.NOW)


def news_select_top(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: best 25 items, at most three per source."""
    chosen = news.select_candidates(t.news_items(spark, folder), t.feed_sources(spark, folder), t.PROFILE, t.NOW)
    return chosen.select("news_item_id", "source_key", "title", "score", F.col("source_rank").cast("bigint"))


QUERIES["news_select_top"] = Query(news_select_top, sql.query(
    "SELECT * FROM chosen", "feed_source", "news_item", "scored", "chosen"))


def news_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).select("news_item_id", "source_key", "ignore_reason", "score")


QUERIES["news_scores"] = Query(news_scores, sql.query(
    "SELECT news_item_id, source_key, reason AS ignore_reason, score FROM scored",
    "feed_source", "news_item", "scored"))


def news_ignore_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(spark, folder).groupBy("source_key", F.coalesce("ignore_reason", F.lit("scored")).alias("reason")
                                          ).agg(F.count(F.lit(1)).alias("items"))


QUERIES["news_ignore_breakdown"] = Query(news_ignore_breakdown, sql.query(
    "SELECT source_key, coalesce(reason, 'scored') AS reason, count(*) AS items FROM scored GROUP BY 1, 2",
    "feed_source", "news_item", "scored"))


def news_eligible(spark: SparkSession, folder: str) -> DataFrame:
    rows = news.eligible_items(t.news_items(spark, folder), t.NOW, 72, limit=200)
    return rows.select("news_item_id", F.unix_micros(news.age_anchor()).alias("anchor_us"))


QUERIES["news_eligible"] = Query(news_eligible, sql.query(f"""
SELECT news_item_id, coalesce(published_us, collected_us) AS anchor_us FROM news_item
WHERE status IN ('collected', 'candidate') AND {t.NOW_MICROS} - coalesce(published_us, collected_us) <= 259200000000
ORDER BY anchor_us DESC, news_item_id LIMIT 200""", "news_item"))


def news_insert_if_new(spark: SparkSession, folder: str) -> DataFrame:
    keyed = t.keyed_news(spark, folder)
    stored = keyed.where(F.col("doc_id") % 2 == 0)
    arriving = keyed.where(F.col("doc_id") % 2 == 1)
    return news.insert_if_new(arriving, stored).select("doc_id", "outcome", "matched_id")


QUERIES["news_insert_if_new"] = Query(news_insert_if_new, sql.query("""
SELECT doc_id,
       CASE WHEN u IS NOT NULL AND e IS NOT NULL AND u <> e THEN 'conflict'
            WHEN coalesce(u, e) IS NULL THEN 'new' ELSE 'duplicate' END AS outcome,
       CASE WHEN NOT (u IS NOT NULL AND e IS NOT NULL AND u <> e) THEN coalesce(u, e) END AS matched_id
FROM (SELECT * FROM keyed_news WHERE doc_id % 2 = 1)
LEFT JOIN (SELECT url_hash, min(news_item_id) AS u FROM keyed_news WHERE doc_id % 2 = 0 GROUP BY 1) USING (url_hash)
LEFT JOIN (SELECT source_key, external_id, min(news_item_id) AS e FROM keyed_news
           WHERE doc_id % 2 = 0 AND external_id IS NOT NULL GROUP BY 1, 2) USING (source_key, external_id)""",
    "keyed_news"))


def _with_ext_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ext_key", F.when(F.col("external_id").isNotNull(),
                                             F.concat_ws("|", "source_key", "external_id")))


def news_admit_batch(spark: SparkSession, folder: str) -> DataFrame:
    rows = _with_ext_key(t.keyed_news(spark, folder))
    return news.admit_in_batch(rows, "doc_id").select("doc_id", "admitted")


_WALK = """
, numbered AS (SELECT row_number() OVER (ORDER BY {order}) AS n, doc_id, url_hash AS k1,
                      CASE WHEN external_id IS NOT NULL THEN source_key || '|' || external_id END AS k2
               FROM {table}),
walk AS (
  SELECT CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS urls, CAST([] AS VARCHAR[]) AS exts,
         CAST(NULL AS BIGINT) AS doc_id, false AS admitted
  UNION ALL
  SELECT n, CASE WHEN ok THEN list_append(urls, k1) ELSE urls END,
         CASE WHEN ok AND k2 IS NOT NULL THEN list_append(exts, k2) ELSE exts END, doc_id, ok
  FROM (SELECT r.n, r.doc_id, r.k1, r.k2, w.urls, w.exts,
               NOT (list_contains(w.urls, r.k1) OR coalesce(list_contains(w.exts, r.k2), false)) AS ok
        FROM walk w JOIN numbered r ON r.n = w.n + 1))
"""
QUERIES["news_admit_batch"] = Query(news_admit_batch, sql.query("", "keyed_news", recursive=True).rstrip() + _WALK.format(
    order="doc_id", table="keyed_news") + "SELECT doc_id, admitted FROM walk WHERE n > 0")


def news_insert_budget(spark: SparkSession, folder: str) -> DataFrame:
    """Budget over (priority descending, key, entry order); admission by either key in the same order."""
    rows = _with_ext_key(t.keyed_news(spark, folder)).join(
        t.feed_sources(spark, folder).where("enabled").select("source_key", "priority"), "source_key")
    rows = rows.withColumn("place", F.struct((-F.col("priority")).alias("p"), "source_key", "doc_id"))
    admitted = news.admit_in_batch(rows, "place")
    return news.insert_budget(admitted, F.col("place"), F.col("admitted")).select("doc_id", "outcome")


QUERIES["news_insert_budget"] = Query(news_insert_budget, sql.query("", "feed_source", "keyed_news", recursive=True
    ).rstrip() + """
, enabled_news AS (SELECT k.*, priority FROM keyed_news k JOIN feed_source USING (source_key) WHERE enabled)""" +
    _WALK.format(order="priority DESC, source_key, doc_id", table="enabled_news") + """
SELECT doc_id, CASE WHEN before >= 100 THEN 'over_budget' WHEN admitted THEN 'inserted' ELSE 'duplicate' END AS outcome
FROM (SELECT doc_id, admitted, coalesce(sum(CAST(admitted AS INTEGER)) OVER (
        ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM walk WHERE n > 0)""")


def _ingested(spark: SparkSession, folder: str) -> DataFrame:
    keyed = t.keyed_news(spark, folder)
    return news.ingest_batch(keyed.where(F.col("doc_id") % 3 != 0), keyed.where(F.col("doc_id") % 3 == 0), "doc_id")


def ingest_flow(spark: SparkSession, folder: str) -> DataFrame:
    """Two thirds of the entries arrive against the stored third: stored or new, first wins, budget."""
    return _ingested(spark, folder).select("doc_id", "outcome", "matched_id")


_INGEST = """
, compared AS (
  SELECT k.*, u, e FROM (SELECT * FROM keyed_news WHERE doc_id % 3 <> 0) k
  LEFT JOIN (SELECT url_hash, min(news_item_id) AS u FROM keyed_news WHERE doc_id % 3 = 0 GROUP BY 1) USING (url_hash)
  LEFT JOIN (SELECT source_key, external_id, min(news_item_id) AS e FROM keyed_news
             WHERE doc_id % 3 = 0 AND external_id IS NOT NULL GROUP BY 1, 2) USING (source_key, external_id)),
fresh AS (SELECT * FROM compared WHERE coalesce(u, e) IS NULL)""" + _WALK.format(order="doc_id", table="fresh") + """
, ingested AS (
  SELECT doc_id, source_key, CASE WHEN before >= 100 THEN 'over_budget' WHEN u <> e THEN 'conflict'
                      WHEN admitted THEN 'inserted' ELSE 'duplicate' END AS outcome,
         CASE WHEN NOT coalesce(u <> e, false) THEN coalesce(u, e) END AS matched_id
  FROM (SELECT c.*, coalesce(w.admitted, false) AS admitted, coalesce(sum(CAST(coalesce(w.admitted, false) AS INTEGER)) OVER (
               ORDER BY c.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM compared c LEFT JOIN (SELECT doc_id, admitted FROM walk WHERE n > 0) w USING (doc_id)))
"""
QUERIES["ingest_flow"] = Query(ingest_flow, sql.query("", "keyed_news", recursive=True).rstrip() + _INGEST
                               + "SELECT doc_id, outcome, matched_id FROM ingested")


def ingest_flow_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of the same batch by source, and the run's."""
    rows = _ingested(spark, folder).withColumn("run_id", F.lit(1))
    fetches = t.feed_sources(spark, folder).select(
        F.lit(1).alias("run_id"), "source_key", F.when(F.col("number") % 6 == 5, "failed").otherwise("success").alias("fetch_status"))
    return runs.run_counters(runs.ingest_summary(rows, fetches)).drop("run_id")


QUERIES["ingest_flow_counters"] = Query(ingest_flow_counters, sql.query(
    "", "feed_source", "keyed_news", recursive=True).rstrip() + _INGEST + """
SELECT count(*) AS feeds_total, count(*) FILTER (WHERE number % 6 <> 5) AS feeds_succeeded,
       sum(CASE WHEN number % 6 <> 5 THEN coalesce(i, 0) ELSE 0 END) AS items_inserted,
       sum(CASE WHEN number % 6 <> 5 THEN coalesce(d, 0) ELSE 0 END) AS items_duplicate,
       sum(CASE WHEN number % 6 <> 5 THEN coalesce(i, 0) + coalesce(d, 0) ELSE 0 END) AS items_fetched
FROM feed_source LEFT JOIN (
  SELECT source_key, count(*) FILTER (WHERE outcome = 'inserted') AS i, count(*) FILTER (WHERE outcome = 'duplicate') AS d
  FROM ingested GROUP BY 1) USING (source_key)""")


def news_state_after_selection(spark: SparkSession, folder: str) -> DataFrame:
    items = t.news_items(spark, folder)
    scored = _scored(spark, folder)
    after = state.persist_selection(items.select("news_item_id", "status", "ignore_reason"), scored,
                                    news.diversify(scored))
    return after.select("news_item_id", "status", "ignore_reason")


QUERIES["news_state_after_selection"] = Query(news_state_after_selection, sql.query("""
SELECT s.news_item_id,
       CASE WHEN status <> 'collected' THEN status WHEN reason IS NOT NULL THEN 'ignored'
            WHEN c.news_item_id IS NOT NULL THEN 'candidate' ELSE status END AS status,
       CASE WHEN status = 'collected' AND reason IS NOT NULL THEN reason ELSE ignore_reason END AS ignore_reason
FROM scored s LEFT JOIN chosen c USING (news_item_id)""", "feed_source", "news_item", "scored", "chosen"))


def news_transitions(spark: SparkSession, folder: str) -> DataFrame:
    """Requested status changes: each item asks for a status by its number; some requests are wrong."""
    items = t.news_items(spark, folder)
    key = F.col("doc_id")
    requests = items.select(
        "news_item_id", t.pick(key, "candidate", "ignored", "used", None, "collected", "ignored", "used")
        .alias("target_status"), F.when(key % 4 == 1, "too_old").alias("request_reason"))
    return state.apply_transitions(items.select("news_item_id", "status", "ignore_reason"), requests)


QUERIES["news_transitions"] = Query(news_transitions, sql.query(f"""
SELECT news_item_id, CASE WHEN target IS NOT NULL AND error IS NULL THEN target ELSE status END AS status,
       CASE WHEN target IS NOT NULL AND error IS NULL THEN reason ELSE ignore_reason END AS ignore_reason,
       error AS transition_error
FROM (SELECT *, CASE WHEN target IS NULL THEN NULL
        WHEN target = 'ignored' AND reason IS NULL THEN 'ignore_reason is required when ignoring a news item'
        WHEN target <> 'ignored' AND reason IS NOT NULL THEN 'ignore_reason is only allowed for ignored news items'
        WHEN (status = 'collected' AND target IN ('candidate', 'ignored'))
          OR (status = 'candidate' AND target IN ('used', 'collected')) THEN NULL
        ELSE 'Invalid news item state transition: ''' || status || ''' -> ''' || target || '''' END AS error
      FROM (SELECT *, {sql.pick('doc_id', 'candidate', 'ignored', 'used', None, 'collected', 'ignored', 'used')} AS target,
                   CASE WHEN doc_id % 4 = 1 THEN 'too_old' END AS reason FROM news_item))""", "news_item"))


# --- feeds and entries ----------------------------------------------------------------------------

def _page_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """One feed document per page with three entries: RSS or Atom by number, some no feed, some with junk at the end."""
    key = F.col("page_id")
    title = text.escape_html5(F.regexp_replace("title", r"[^\p{Print}\p{L}]", " "))
    link = text.escape_html5("link")

    def entry(place: int, atom: bool):
        number = F.concat_ws("-", key.cast("string"), F.lit(str(place)))
        if atom:
            return F.concat(F.lit("<entry><id>"), number, F.lit("</id><title>"), title, F.lit('</title><link href="'),
                            link, F.lit('"/><updated>2024-01-0'), F.lit(str(place)),
                            F.lit("T10:00:00Z</updated></entry>"))
        return F.concat(F.lit("<item><guid>"), number, F.lit("</guid><title>"), title, F.lit("</title><link>"), link,
                        F.lit("</link><pubDate>Mon, 0"), F.lit(str(place)), F.lit(" Jan 2024 10:00:00 GMT</pubDate></item>"))

    rss = F.concat(F.lit("<rss><channel>"), *[entry(place, False) for place in (1, 2, 3)], F.lit("</channel></rss>"))
    rss = F.concat(rss, F.when(key % 5 == 0, "tail <junk").otherwise(""))
    atom = F.concat(F.lit("<feed>"), *[entry(place, True) for place in (1, 2, 3)], F.lit("</feed>"))
    body = F.when(key % 7 == 0, "not a feed").when(key % 2 == 0, rss).otherwise(atom)
    return t.feed_entries(spark, folder).select("page_id", "source_key", body.alias("body"))


def feed_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies to entries in document order, first two of each."""
    parsed = feeds.cap_entries(feeds.parse_feed_bodies(_page_feeds(spark, folder)), 2)
    return parsed.select("page_id", "entry_index", "external_id", F.unix_micros("published_at").alias("published_us"),
                         "parse_error")


QUERIES["feed_parse"] = Query(feed_parse, """
SELECT page_id, CASE WHEN page_id % 7 <> 0 THEN i END AS entry_index,
       CASE WHEN page_id % 7 <> 0 THEN page_id || '-' || (i + 1) END AS external_id,
       CASE WHEN page_id % 7 <> 0 THEN epoch_us(TIMESTAMP '2024-01-01 10:00:00') + i * 86400000000 END AS published_us,
       CASE WHEN page_id % 7 = 0 THEN 'FEED_PARSE_FAILED' END AS parse_error
FROM pages, (VALUES (0), (1)) AS places(i)
WHERE page_id % 7 <> 0 OR i = 0""")


def feed_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Three entries per page, written as XML files and scanned by tag."""
    place = f"{shared_folder(spark)}/feeds-{uuid.uuid4().hex}"
    entries = t.feed_entries(spark, folder).select(
        "page_id", "title", "link", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"))
    entries.select(
        F.concat_ws("-", "page_id", "n").alias("guid"), "title", "link",
        F.concat(F.lit("Mon, 0"), F.col("n").cast("string"), F.lit(" Jan 2024 10:00:00 GMT")).alias("pubDate"),
    ).write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(place)
    scanned = feeds.read_feed_entries(spark, place, "item")
    return scanned.select("external_id", "link", F.unix_micros("published_at").alias("published_us"), "parse_error")


QUERIES["feed_scan"] = Query(feed_scan, """
SELECT page_id || '-' || i AS external_id, url AS link,
       epoch_us(TIMESTAMP '2024-01-01 10:00:00') + (i - 1) * 86400000000 AS published_us,
       CAST(NULL AS VARCHAR) AS parse_error
FROM pages, (VALUES (1), (2), (3)) AS places(i)""")


def entry_normalize(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as entries; a source accepts its own main host only."""
    entries = t.feed_entries(spark, folder)
    hosts = entries.groupBy("source_key").agg(F.min("host").alias("allowed_host"))
    rows = news.normalize_entries(entries, hosts, t.now())
    return rows.select("page_id", "canonical_url", "url_hash", "title", "normalized_title", "content_hash",
                       F.length("sanitized_summary").alias("summary_length"), "skip_reason")


def url_tracking_strip(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical URLs of the pages in built-in expressions."""
    return t.table(spark, folder, "pages").select("page_id", text.strip_tracking("url").alias("canonical_url"))


QUERIES["url_tracking_strip"] = Query(url_tracking_strip, r"""
SELECT page_id, CASE WHEN regexp_matches(url, '^(?i:https)://') THEN
         'https://' || lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1))
         || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END
       END AS canonical_url
FROM (SELECT page_id, url, regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1) AS path,
        array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
          lambda p: p <> '' AND NOT starts_with(lower(p), 'utm_')
                    AND NOT list_contains(['gclid', 'fbclid', 'mc_cid', 'mc_eid', 'igshid', '_ga'],
                                          lower(split_part(p, '=', 1))))), '&') AS query
      FROM pages)""")


def url_canonicalize(spark: SparkSession, folder: str) -> DataFrame:
    """The exact canonical form agrees with the built-in one on plain URLs."""
    rows = t.table(spark, folder, "pages").select(
        "page_id", urls.canonicalize_url(F.col("url")).alias("canonical_url"),
        text.strip_tracking("url").alias("_builtin"))
    return rows.select("page_id", "canonical_url", F.sha2("canonical_url", 256).alias("url_hash"),
                       F.col("canonical_url").eqNullSafe(F.col("_builtin")).alias("same"))


_UNTAGGED = r"regexp_replace(html, '(?is)<(script|style)\b.*?</(script|style)\s*>|<!--.*?-->|<[^>]*>', '', 'g')"
for _escaped, _plain in text.BASIC_ENTITIES:
    _UNTAGGED = f"replace({_UNTAGGED}, {sql.quote(_escaped)}, {sql.quote(_plain)})"
_UNTAGGED = f"regexp_replace({_UNTAGGED}, {sql.quote(text.AMPERSAND)}, '&', 'g')"
_SUMMARY = f"rtrim(substr({sql.collapse(_UNTAGGED)}, 1, 12000), ' ')"

# On the given pages the tokenizer and the pattern form of the text agree, so SQL can check the exact operator.
QUERIES["entry_normalize"] = Query(entry_normalize, f"""
SELECT page_id, canonical_url, sha256(canonical_url) AS url_hash, substr(title, 1, 500) AS title, normalized_title,
       CASE WHEN skip_reason IS NULL THEN sha256(normalized_title || chr(10) || summary) END AS content_hash,
       CASE WHEN skip_reason IS NULL THEN length(summary) END AS summary_length, skip_reason
FROM (SELECT *, CASE WHEN title = '' THEN 'missing_title_or_link' WHEN canonical_url IS NULL THEN 'invalid_url'
                WHEN host <> allowed_host THEN 'foreign_host' WHEN summary = '' THEN 'empty_text' END AS skip_reason
      FROM (SELECT *, min(host) OVER (PARTITION BY domain) AS allowed_host,
                   substr(lower({sql.collapse('title')}), 1, 500) AS normalized_title
            FROM (SELECT p.page_id, c.canonical_url, {sql.strip("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")}
                    AS title, {_SUMMARY} AS summary, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
                    regexp_extract(url, '^https?://[^/?#]*?([^./?#]+[.][^./?#]+)([/?#]|$)', 1) AS domain
                  FROM pages p JOIN ({QUERIES["url_tracking_strip"].sql}) c USING (page_id))))""")

QUERIES["url_canonicalize"] = Query(url_canonicalize, (
    "SELECT page_id, canonical_url, sha256(canonical_url) AS url_hash, true AS same FROM ("
    + QUERIES["url_tracking_strip"].sql + ")"))


def html_sanitize(spark: SparkSession, folder: str) -> DataFrame:
    """Page text by the exact operator, whole pages."""
    rows = t.table(spark, folder, "pages").select("page_id", html.sanitize_html(F.col("html"), None).alias("summary"))
    return rows.select("page_id", F.length("summary").alias("summary_length"), F.sha2("summary", 256).alias("summary_hash"))


QUERIES["html_sanitize"] = Query(html_sanitize, f"""
SELECT page_id, length(summary) AS summary_length, sha256(summary) AS summary_hash
FROM (SELECT page_id, rtrim({sql.collapse(_UNTAGGED)}, ' ') AS summary FROM pages)""")


def title_normalize(spark: SparkSession, folder: str) -> DataFrame:
    rows = t.news_items(spark, folder)
    return rows.select(
        "doc_id", text.normalize_title("title").alias("normalized_title"),
        text.clean_text("title").alias("clean_title"),
        F.sha2(text.clean_text("sanitized_summary"), 256).alias("clean_hash"),
        text.error_summary("sanitized_summary").alias("summary_500"))


QUERIES["title_normalize"] = Query(title_normalize, sql.query(f"""
SELECT doc_id, lower({sql.collapse('title')}) AS normalized_title, {sql.clean('title')} AS clean_title,
       sha256({sql.clean('sanitized_summary')}) AS clean_hash,
       substr(nullif({sql.strip('sanitized_summary')}, ''), 1, 500) AS summary_500
FROM news_item""", "news_item"))


def text_hash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """First document of each content hash, with the number of its copies (exact-content option)."""
    rows = t.news_items(spark, folder).select(
        "doc_id", hashing.content_hash(text.normalize_title("title"), F.col("sanitized_summary")).alias("content_hash"))
    firsts = rows.groupBy("content_hash").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    return firsts.select("content_hash", "doc_id", "copies", text.short_hash("content_hash").alias("short_hash"))


QUERIES["text_hash_dedup"] = Query(text_hash_dedup, sql.query(f"""
SELECT content_hash, min(doc_id) AS doc_id, count(*) AS copies, substr(content_hash, 1, 12) || '…' AS short_hash
FROM (SELECT doc_id, sha256(lower({sql.collapse('title')}) || chr(10) || sanitized_summary) AS content_hash
      FROM news_item) GROUP BY content_hash""", "news_item"))


def url_policy(spark: SparkSession, folder: str) -> DataFrame:
    """Feed URL rules on the page URLs, each with one host rule broken by number."""
    key = F.col("page_id")
    entries = t.feed_entries(spark, folder)
    broken = F.when(key % 11 == 0, F.lit("https://10.0.0.7/feed")).when(key % 11 == 1, F.lit("https://8.8.8.8/feed")) \
        .when(key % 11 == 2, F.concat(F.lit("https://user@"), F.col("host"), F.lit("/feed"))) \
        .when(key % 11 == 3, F.concat(F.lit("https://"), F.col("host"), F.lit(":8443/feed"))).otherwise(F.col("link"))
    allowed = F.when(key % 11 == 1, "8.8.8.8").otherwise(F.col("host"))
    return entries.select("page_id", urls.feed_url_policy(broken, allowed).alias("problem"),
                          urls.normalize_hostname(F.col("host")).alias("host"),
                          urls.is_public_ip(F.when(key % 2 == 0, "8.8.8.8").otherwise("192.168.0.1")).alias("public"))


QUERIES["url_policy"] = Query(url_policy, """
SELECT page_id, CASE page_id % 11
    WHEN 0 THEN 'feed_url must not use a private, loopback, link-local, multicast, unspecified, or reserved IP address'
    WHEN 1 THEN NULL WHEN 2 THEN 'feed_url must not contain URL credentials'
    WHEN 3 THEN 'Feed URL must use the default HTTPS port or explicit port 443'
    ELSE CASE WHEN NOT starts_with(url, 'https://') THEN 'feed_url must use HTTPS' END END AS problem,
  lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host, page_id % 2 = 0 AS public FROM pages""")


def _fetches(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("page_id")
    prefix = F.when(key % 5 == 0, F.concat(F.lit("  <?xml"), F.col("html"))).otherwise(F.col("html"))
    return t.table(spark, folder, "pages").select(
        "page_id", t.pick(key, "200", "200", "304", "404", "429", "503", "200", None).cast("int").alias("http_status"),
        t.pick(key, "text/html; charset=utf-8", "application/rss+xml", "TEXT/XML ;q=1", None).alias("content_type"),
        F.octet_length("html").alias("body_bytes"), prefix.alias("body_prefix"), (key % 4).alias("entries_count"),
        F.when(key % 8 == 7, "FEED_TIMEOUT").alias("error_code"), F.col("html").alias("body"),
        F.timestamp_micros(key * 1_000_003).alias("started_at"),
        F.timestamp_micros(key * 1_000_003 + key % 9 * 700 + 123_456).alias("finished_at"),
        (key % 300).alias("reported_ms"))


def fetch_classify(spark: SparkSession, folder: str) -> DataFrame:
    rows = feeds.classify_fetch(_fetches(spark, folder), max_bytes=4000)
    return rows.select("page_id", "fetch_status", "error_code",
                       times.duration_ms(F.col("started_at"), F.col("finished_at")).alias("duration_ms"),
                       times.fetch_duration_ms(F.col("started_at"), F.col("finished_at"), F.col("reported_ms"))
                       .alias("fetch_duration_ms"))


_DURATION = "(page_id * 1000003 + page_id % 9 * 700 + 123456 - page_id * 1000003) // 1000"
QUERIES["fetch_classify"] = Query(fetch_classify, f"""
SELECT page_id, CASE WHEN code IS NOT NULL THEN 'failed' WHEN http = 304 THEN 'not_modified' ELSE 'success' END
         AS fetch_status, code AS error_code, {_DURATION} AS duration_ms,
       greatest(0, {_DURATION}, page_id % 300) AS fetch_duration_ms
FROM (SELECT *, CASE WHEN page_id % 8 = 7 THEN 'FEED_TIMEOUT' WHEN http = 304 THEN NULL
        WHEN http IS NULL OR http NOT BETWEEN 200 AND 299 THEN 'FEED_CONNECTION_FAILED'
        WHEN octet_length(encode(html)) > 4000 THEN 'FEED_RESPONSE_TOO_LARGE'
        WHEN (page_id % 4 = 0 AND page_id % 5 <> 0) OR page_id % 4 = 0 THEN 'FEED_PARSE_FAILED' END AS code
      FROM (SELECT *, CAST({sql.pick('page_id', '200', '200', '304', '404', '429', '503', '200', None)} AS INTEGER)
                   AS http FROM pages))""")


def fetch_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies against the validators stored for them; every third one is up to date."""
    bodies = t.table(spark, folder, "pages").select(F.col("page_id").alias("source_key"), F.col("html").alias("body"))
    stored = t.table(spark, folder, "pages").select(
        F.col("page_id").alias("source_key"),
        F.when(F.col("page_id") % 3 == 0, hashing.body_validator(F.col("html")))
        .when(F.col("page_id") % 3 == 1, '"old"').alias("stored_etag"))
    return feeds.detect_unchanged(bodies, stored).select("source_key", "etag", "unchanged", "http_status")


QUERIES["fetch_unchanged"] = Query(fetch_unchanged, """
SELECT page_id AS source_key, '"' || substr(sha256(html), 1, 16) || '"' AS etag, page_id % 3 = 0 AS unchanged,
       CASE WHEN page_id % 3 = 0 THEN 304 ELSE 200 END AS http_status FROM pages""")


# --- sources --------------------------------------------------------------------------------------

def limits_resolve(spark: SparkSession, folder: str) -> DataFrame:
    sources = t.feed_sources(spark, folder)
    config = sources.where(F.col("number") % 3 != 0).select(
        "source_key", F.when(F.col("number") % 2 == 0, F.col("number") * 7 + 1).otherwise(20).alias("max_items_per_run"),
        (F.col("number") + 5).alias("request_timeout_seconds"))
    return news.resolve_limits(sources.select("source_key"), config, 60, 15)


QUERIES["limits_resolve"] = Query(limits_resolve, sql.query("""
SELECT source_key, least(60, CASE WHEN number % 3 = 0 THEN 60 WHEN number % 2 = 0 THEN number * 7 + 1 ELSE 20 END, 50)
         AS max_entries,
       CAST(CASE WHEN number % 3 = 0 THEN 15 ELSE number + 5 END AS DOUBLE) AS read_timeout_seconds
FROM feed_source""", "feed_source"))


def source_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Stored sources against a configuration that renames, adds and (wrongly) moves some of them."""
    sources = t.feed_sources(spark, folder)
    number = F.col("number")
    stored = sources.where((number % 4 != 0) | (number % 3 == 0)).withColumn("consecutive_failures", number.cast("bigint"))
    config = sources.where(number % 3 != 0).withColumn("name", F.concat(F.col("name"), F.lit(" (new)"))).withColumn(
        "allowed_host", F.when(number % 5 == 0, "moved.example.com").otherwise(F.col("allowed_host"))).withColumn(
        "priority", F.lit(5).cast("decimal(4,2)"))
    after = state.upsert_sources(stored.drop("number"), config)
    return after.select("source_key", "allowed_host", "name", F.col("priority").cast("double").alias("priority"),
                        "consecutive_failures", "change", "sync_error")


QUERIES["source_upsert"] = Query(source_upsert, sql.query("""
SELECT source_key,
       CASE WHEN fresh AND number % 5 = 0 THEN 'moved.example.com' ELSE allowed_host END AS allowed_host,
       name || CASE WHEN take THEN ' (new)' ELSE '' END AS name,
       CAST(CASE WHEN take THEN 5 ELSE priority END AS DOUBLE) AS priority,
       CASE WHEN NOT fresh THEN CAST(number AS BIGINT) END AS consecutive_failures,
       CASE WHEN fresh THEN 'inserted' WHEN clash THEN 'rejected' WHEN take THEN 'updated' ELSE 'kept' END
         AS change,
       CASE WHEN clash THEN 'Source URL or allowed hostname differs from the stored source identity.' END AS sync_error
FROM (SELECT *, number % 3 <> 0 AND NOT clash AS take
      FROM (SELECT *, number % 4 = 0 AND number % 3 <> 0 AS fresh,
                   number % 4 <> 0 AND number % 3 <> 0 AND number % 5 = 0 AS clash FROM feed_source))""", "feed_source"))


def source_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """All sources by key, and the one that a loosely written key names."""
    sources = t.feed_sources(spark, folder)
    asked = news.source_by_key(sources, "  SRC3 ").select("source_key", F.lit(True).alias("asked"))
    return news.all_sources(sources.join(asked, "source_key", "left").select(
        "source_key", "name", F.coalesce("asked", F.lit(False)).alias("asked")))


QUERIES["source_lookup"] = Query(source_lookup, sql.query(
    "SELECT source_key, name, source_key = 'src3' AS asked FROM feed_source", "feed_source"))


def header_check(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the texts could be stored as headers: those with a line end or another control character could not."""
    return t.table(spark, folder, "documents").select("doc_id", text.header_is_safe("text").alias("safe"))


QUERIES["header_check"] = Query(header_check, r"""
SELECT doc_id, NOT coalesce(regexp_matches(text, '[\x00-\x1f\x7f]'), false) AS safe FROM documents""")


def source_list(spark: SparkSession, folder: str) -> DataFrame:
    """Enabled sources in fetch order."""
    return news.enabled_sources(t.feed_sources(spark, folder)).select(
        "source_key", "name", F.col("priority").cast("double").alias("priority"))


QUERIES["source_list"] = Query(source_list, sql.query(
    "SELECT source_key, name, CAST(priority AS DOUBLE) AS priority FROM feed_source WHERE enabled "
    "ORDER BY priority DESC, source_key", "feed_source"))
