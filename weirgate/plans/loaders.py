"""Queries that go through the readers and writers: files are written from the given tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirgate import schemas
from weirgate.operators import news, quality
from weirgate.plans import invoices, sql, tables as t
from weirgate.plans.registry import Query
from weirgate.session import shared_folder
from weirgate.sources import config, feeds, leads, responses, sinks

QUERIES: dict[str, Query] = {}


def _place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def lead_intake(spark: SparkSession, folder: str) -> DataFrame:
    """Lead payloads as JSON files, some cut off, read with their fixed schema and keyed."""
    place, key = _place(spark, "leads"), F.col("c_custkey")
    body = F.to_json(F.struct(*schemas.LEAD_REQUEST.fieldNames(), "header_key"))
    t.lead_requests(spark, folder).select(F.when(key % 50 == 0, F.substring(body, 1, 12)).otherwise(body).alias("value")).write.text(place)
    rows = leads.read_lead_requests(spark, place)
    readable = F.col("_corrupt_record").isNull()
    names = ("name", "email", "company", "phone", "source", "consent_to_contact", "idempotency_key", "estimated_budget")
    return rows.select(readable.alias("readable"), *[F.when(readable, F.col(name)).alias(name) for name in names],
                       F.when(readable, F.sha2("message", 256)).alias("message_hash"))


QUERIES["lead_intake"] = Query(lead_intake, sql.query("""
SELECT c_custkey % 50 <> 0 AS readable, CASE WHEN c_custkey % 50 <> 0 THEN name END AS name,
       CASE WHEN c_custkey % 50 <> 0 THEN raw_email END AS email, CASE WHEN c_custkey % 50 <> 0 THEN company END AS company,
       CASE WHEN c_custkey % 50 <> 0 THEN phone END AS phone, CASE WHEN c_custkey % 50 <> 0 THEN source END AS source,
       CASE WHEN c_custkey % 50 <> 0 THEN consent_to_contact END AS consent_to_contact,
       CASE WHEN c_custkey % 50 <> 0 THEN idempotency_key END AS idempotency_key,
       CASE WHEN c_custkey % 50 <> 0 THEN estimated_budget END AS estimated_budget,
       CASE WHEN c_custkey % 50 <> 0 THEN sha256(raw_message) END AS message_hash
FROM lead_request""", "lead_request"))


def _yaml(rows: DataFrame, line, head: str) -> DataFrame:
    """A configuration file with one entry a row: as many as there are configured sources."""
    return rows.agg(F.concat(F.lit(head), F.array_join(F.array_sort(F.collect_list(line)), "")).alias("value"))


def source_limits(spark: SparkSession, folder: str) -> DataFrame:
    """A source list and a topic profile as files, loaded, and the limits that follow for every source."""
    place, sources, number = _place(spark, "config"), t.feed_sources(spark, folder), F.col("number")
    line = F.concat(
        F.lit("- key: ' "), F.upper("source_key"), F.lit("'\n  name: "), F.col("name"), F.lit("\n  url: "), F.col("feed_url"),
        F.lit("\n  allowed_host: "), F.col("allowed_host"), F.lit(".\n  category: "), F.col("category"), F.lit("\n"),
        F.when(number % 2 == 0, F.concat(F.lit("  max_items_per_run: "), (number % 45 + 5).cast("string"), F.lit("\n"))).otherwise(""),
        F.when(number % 5 == 0, F.concat(F.lit("  request_timeout_seconds: "), (number % 50 + 1).cast("string"), F.lit("\n"))).otherwise(""))
    _yaml(sources.where(number % 3 != 0), line, "version: 1\ndefaults:\n  max_items_per_run: 30\nsources:\n").write.text(f"{place}/sources")
    words = ", ".join(f"' {word.upper()} '" for word in t.PROFILE.include_keywords)
    spark.range(1).select(F.lit(f"version: 1\nname: topics\ninclude_keywords: [{words}]\nmin_title_length: 9\n").alias("value")).write.text(
        f"{place}/profile")
    profile = config.load_topic_profile(f"{place}/profile", spark)
    loaded = config.load_source_config(spark, f"{place}/sources")
    limits = news.resolve_limits(sources.select("source_key"), loaded, 60, 15)
    hits = sum((F.contains(F.replace("category", F.lit("_"), F.lit(" ")), F.lit(word)).cast("int") for word in profile.include_keywords),
               F.lit(0))
    known = loaded.select("source_key", F.col("priority").cast("double").alias("priority"), "language", "enabled", hits.alias("hits"))
    return limits.join(known, "source_key", "left").withColumn("min_title_length", F.lit(profile.min_title_length))


_HITS = sql.keyword_hits("replace(category, '_', ' ')", t.PROFILE.include_keywords)
QUERIES["source_limits"] = Query(source_limits, sql.query(f"""
SELECT source_key, least(60, CASE WHEN number % 3 = 0 THEN 60 WHEN number % 2 = 0 THEN number % 45 + 5 ELSE 30 END, 50) AS max_entries,
       CAST(CASE WHEN number % 3 = 0 OR number % 5 <> 0 THEN 15 ELSE number % 50 + 1 END AS DOUBLE) AS read_timeout_seconds,
       CASE WHEN number % 3 <> 0 THEN CAST(5 AS DOUBLE) END AS priority, CASE WHEN number % 3 <> 0 THEN 'en' END AS language,
       CASE WHEN number % 3 <> 0 THEN true END AS enabled, CASE WHEN number % 3 <> 0 THEN {_HITS} END AS hits, 9 AS min_title_length
FROM feed_source""", "feed_source"))


def model_responses_lead(spark: SparkSession, folder: str) -> DataFrame:
    """Lead answers as JSON texts bound to their closed schema and its ranges; seven of eight have a fault."""
    key = F.col("c_custkey")
    signals = t.lead_signals(spark, folder).select(
        "c_custkey", F.when(key % 8 == 3, "sales").otherwise(F.col("intent")).alias("intent"), "requested_service", "urgency",
        "budget_category", "decision_maker_signal", F.when(key % 8 == 5, "").otherwise("Wants a call.").alias("summary"),
        F.when(key % 8 == 4, F.array(F.lit("budget"), F.lit("budget"))).otherwise(F.array(F.lit("budget"))).alias("missing_information"),
        "confidence")
    good = F.to_json(F.struct(*schemas.LEAD_SIGNALS.fieldNames()))
    answer = (F.when(key % 8 == 0, F.substring(good, 1, 60)).when(key % 8 == 1, F.replace(good, F.lit('"summary"'), F.lit('"x":1,"summary"')))
              .when(key % 8 == 2, F.regexp_replace(good, r'"confidence":([0-9.]+)', '"confidence":"$1"'))
              .when(key % 8 == 6, F.regexp_replace(good, r'"urgency":"[a-z_]+",', "")).otherwise(good))
    found = responses.read_model_responses(signals.select("c_custkey", answer.alias("output_text")), schemas.LEAD_SIGNALS,
                                           rules=responses.lead_output_rules(F.col("output")))
    return found.select("c_custkey", "schema_error", F.col("output.intent").alias("intent"), F.col("output.confidence").alias("confidence"))


QUERIES["model_responses_lead"] = Query(model_responses_lead, sql.query("""
SELECT c_custkey, CASE WHEN c_custkey % 8 <> 7 THEN 'INVALID_STRUCTURED_OUTPUT' END AS schema_error,
       CASE WHEN c_custkey % 8 = 7 THEN intent END AS intent, CASE WHEN c_custkey % 8 = 7 THEN confidence END AS confidence
FROM lead_signal""", "lead_signal"))


def message_outbox(spark: SparkSession, folder: str) -> DataFrame:
    """Invoice messages appended to the outbox in two rounds, and what it then holds."""
    place = f"{_place(spark, 'outbox')}/messages"
    messages = invoices.invoice_messages(spark, folder).select(
        F.lit("telegram").alias("channel"), F.col("order_key").cast("string").alias("request_id"), F.col("message").alias("text"), "order_key")
    for turn in (0, 1):
        sinks.write_messages(messages.where(F.pmod("order_key", F.lit(2)) == turn), place)
    return spark.read.parquet(place)


QUERIES["message_outbox"] = Query(message_outbox, f"""
SELECT 'telegram' AS channel, CAST(order_key AS VARCHAR) AS request_id, message AS text
FROM ({invoices.QUERIES["invoice_messages"].sql})""")


def feed_scan_order(spark: SparkSession, folder: str) -> DataFrame:
    """The entries of one XML file for each source, in document order, the first fifty of each."""
    place = _place(spark, "feeds")
    title = F.regexp_replace("title", r"[^\p{Print}\p{L}]", " ")
    entries = t.feed_entries(spark, folder).select("source_key", "page_id", title.alias("title"), "link",
                                                   F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"))
    dealt = entries.repartition("source_key").sortWithinPartitions("source_key", "page_id", "n")
    dealt.select("source_key", F.concat_ws("-", "page_id", "n").alias("guid"), "title", "link",
                 F.concat(F.lit("About "), "title", F.lit(" & more")).alias("description"),
                 F.concat(F.lit("Mon, 0"), F.col("n").cast("string"), F.lit(" Jan 2024 10:00:00 GMT")).alias("pubDate"),
                 ).write.format("xml").option("rootTag", "channel").option("rowTag", "item").partitionBy("source_key").save(place)
    capped = feeds.cap_entries(feeds.scan_feed_entries(spark, place, "item"), 50)
    return capped.select("source_key", "entry_index", "external_id", F.nullif("title", F.lit("")).alias("title"), "link", "summary",
                         F.unix_micros("published_at").alias("published_us"), "parse_error")


QUERIES["feed_scan_order"] = Query(feed_scan_order, rf"""
WITH entry AS (
    SELECT page_id, url, regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '[^\x20-\x7E\p{{L}}]', ' ', 'g') AS title,
           regexp_extract(regexp_extract(url, '^https?://([^/?#]+)', 1), '([^.]+\.[^.]+)$', 1) AS source_key, i
    FROM pages, (VALUES (1), (2), (3)) AS places(i))
SELECT source_key, CAST(number - 1 AS INTEGER) AS entry_index, page_id || '-' || i AS external_id,
       nullif({sql.strip('title')}, '') AS title, url AS link, 'About ' || title || ' & more' AS summary,
       epoch_us(TIMESTAMP '2024-01-01 10:00:00') + (i - 1) * 86400000000 AS published_us, CAST(NULL AS VARCHAR) AS parse_error
FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY page_id, i) AS number FROM entry)
WHERE number <= 50""")


def contract_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Contract errors of the requests where some sources tell what a record is for."""
    key = F.col("c_custkey")
    rows = t.lead_requests(spark, folder).withColumn("source", F.when(key % 50 == 3, "Prompt-Security lab").otherwise(F.col("source")))
    checked = quality.check_contract(rows, "request_id", ("company",), source="source")
    return checked.select("request_id", F.array_join("contract_errors", "; ").alias("errors"))


QUERIES["contract_sources"] = Query(contract_sources, sql.query("""
SELECT request_id, array_to_string(list_filter([CASE WHEN company IS NULL THEN 'missing:company' END,
         CASE WHEN c_custkey % 50 = 3 THEN 'tells:prompt' END, CASE WHEN c_custkey % 50 = 3 THEN 'tells:security' END],
       lambda e: e IS NOT NULL), '; ') AS errors FROM lead_request""", "lead_request"))


def unknown_fixtures(spark: SparkSession, folder: str) -> DataFrame:
    """Expected cases, one for each order, whose request does not exist (every seventh customer sent none)."""
    cases = t.table(spark, folder, "orders").select("o_orderkey", F.concat(F.lit("req-"), F.col("o_custkey").cast("string")).alias("fixture"))
    fixtures = t.lead_requests(spark, folder).where(F.col("c_custkey") % 7 != 0).select(F.col("request_id").alias("fixture"))
    return quality.unknown_fixtures(cases, fixtures).select("o_orderkey", "fixture")


QUERIES["unknown_fixtures"] = Query(unknown_fixtures, """
SELECT o_orderkey, 'req-' || o_custkey AS fixture FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)""")
