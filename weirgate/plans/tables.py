"""The library's inputs, derived from the given tables.

Every rule is deterministic and covers all rows: a column of the library's data model is computed from columns that
exist. The matching SQL is in ``plans.sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weirgate.functions.times import instant
from weirgate.session import use_utc
from weirgate.sources.config import TopicProfile

NOW = "2026-02-01T00:00:00+00:00"
NOW_MICROS = 1_769_904_000_000_000
MINUTE = 60_000_000
#: Rows that a task of ``dealt`` gets, whatever the size of the table.
TASK_ROWS = 250_000

#: Keywords that occur in the invented prose.
PROFILE = TopicProfile(
    include_keywords=("tion", "ment", "thanea", "eriner", "lich", "ción", "que", "the"),
    exclude_keywords=("token =", "license"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables; zone-free times are read as UTC."""
    use_utc(spark)
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    zone_free = [field.name for field in rows.schema.fields if field.dataType.typeName() == "timestamp_ntz"]
    return rows.withColumns({column: F.col(column).cast("timestamp") for column in zone_free}) if zone_free else rows


def dealt(rows: DataFrame, counted: DataFrame, key: str) -> DataFrame:
    """Rows with the same key in one task, in as many tasks as the rows of ``counted`` ask for.

    Where rows are sorted, the memory of a task so stays the same on any table. A single hot key is not spread.
    """
    tasks = max(-(-counted.count() // TASK_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks, key)


def minutes_before_now(minutes: Column) -> Column:
    return F.timestamp_micros(F.lit(NOW_MICROS) - minutes * MINUTE)


def now() -> Column:
    return instant(NOW)


def pick(number: Column, *values: str | None) -> Column:
    """``values[number % len(values)]``."""
    place = number % len(values)
    choice = F.lit(values[-1]).cast("string")
    for index, value in reversed(list(enumerate(values[:-1]))):
        choice = F.when(place == index, F.lit(value).cast("string")).otherwise(choice)
    return choice


# --- news -----------------------------------------------------------------------------------------

def feed_sources(spark: SparkSession, folder: str) -> DataFrame:
    """One source per value of ``documents.source``."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    return table(spark, folder, "documents").select("source").distinct().select(
        F.col("source").alias("source_key"), F.concat(F.lit("Source "), number.cast("string")).alias("name"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/feed.xml")).alias("feed_url"),
        F.concat(F.col("source"), F.lit(".example.com")).alias("allowed_host"),
        pick(number, "artificial_intelligence", "software_development").alias("category"),
        F.lit("en").alias("language"), (number % 7 != 3).alias("enabled"),
        (number % 11).cast("decimal(4,2)").alias("priority"), number.alias("number"),
    )


def news_items(spark: SparkSession, folder: str) -> DataFrame:
    """One news item per document; ages spread over a week at every scale."""
    key = F.col("doc_id")
    return table(spark, folder, "documents").select(
        F.md5(F.concat(F.lit("news-"), key.cast("string"))).alias("news_item_id"), "doc_id",
        F.col("source").alias("source_key"),
        F.substring_index("text", "\n", 1).alias("title"), F.col("text").alias("sanitized_summary"),
        F.when(key % 11 != 0, minutes_before_now(key * 37 % 10080)).alias("published_at"),
        minutes_before_now(key * 13 % 5000).alias("collected_at"),
        F.when(key % 10 == 0, "used").when(key % 10 == 1, "ignored").when(key % 10 == 2, "candidate")
        .otherwise("collected").alias("status"),
        F.when(key % 10 == 1, "irrelevant").alias("ignore_reason"),
    )


def keyed_news(spark: SparkSession, folder: str) -> DataFrame:
    """News keys: the hash of the whole text stands for the URL hash, so true copies collide; three rows of a source
    share an external id."""
    key = F.col("doc_id")
    return table(spark, folder, "documents").select(
        "doc_id", F.md5(F.concat(F.lit("news-"), key.cast("string"))).alias("news_item_id"),
        F.col("source").alias("source_key"), F.sha2("text", 256).alias("url_hash"),
        F.when(key % 4 != 0, F.floor(key / 60).cast("string")).alias("external_id"),
    )


def feed_entries(spark: SparkSession, folder: str) -> DataFrame:
    """One feed entry per page; its source is the page's registered domain."""
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    return table(spark, folder, "pages").select(
        "page_id", F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("source_key"),
        F.concat(F.lit("p-"), F.col("page_id").cast("string")).alias("external_id"), F.col("url").alias("link"),
        F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"), F.col("html").alias("summary"),
        F.lit(None).cast("string").alias("author"), minutes_before_now(F.col("page_id")).alias("published_at"),
        host.alias("host"),
    )


def fetch_log(spark: SparkSession, folder: str) -> DataFrame:
    """One fetch per event; the user stands for the source."""
    kind, key = F.col("event_type"), F.col("event_id")
    return table(spark, folder, "events").select(
        key.alias("fetch_id"), F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("source_key"),
        F.col("ts").alias("finished_at"),
        F.when(kind == "error", "failed").when(kind == "view", "not_modified").otherwise("success")
        .alias("fetch_status"),
        F.when((kind == "purchase") & (key % 3 == 0), F.concat(F.lit("tag-"), key.cast("string"))).alias("etag"),
    )


def status_events(spark: SparkSession, folder: str) -> DataFrame:
    """One digest status change per event; the user stands for the digest."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("user_id").alias("entity_id"), "event_id", F.col("ts").alias("changed_at"),
        F.when(kind == "signup", "generated").when(kind.isin("view", "click"), "sending")
        .when(kind == "purchase", "sent").otherwise("failed").alias("status"),
    )


def delivery_attempts(spark: SparkSession, folder: str) -> DataFrame:
    """One delivery attempt per event."""
    return attempts_of(table(spark, folder, "events"))


def attempts_of(events: DataFrame) -> DataFrame:
    """Delivery attempts from events; an event without a kind has no status."""
    kind, key = F.col("event_type"), F.col("event_id")
    failed = kind.isin("error", "click", "view")
    return events.select(
        F.col("user_id").alias("digest_id"), (key % 3 + 1).alias("part_number"), (key + 1).alias("attempt_number"),
        (key % 4).alias("trial"),
        F.when(kind == "purchase", "sent").when(kind == "signup", "pending").when(kind.isNotNull(), "failed").alias("status"),
        F.when(kind == "purchase", key + 1).alias("message_id"),
        F.when(kind == "purchase", 200).when(kind == "click", 429).when(kind == "view", 400).alias("http_status"),
        F.when((kind == "click") & (F.col("value") > 20), F.floor("value").cast("int")).alias("retry_after_seconds"),
        F.when(kind == "error", "TELEGRAM_TIMEOUT").when(kind == "click", "TELEGRAM_RATE_LIMITED")
        .when(kind == "view", "TELEGRAM_PERMANENT_FAILURE").alias("error_code"),
        F.when(failed & (key % 2 == 0), "Request failed.").alias("error_summary"),
        F.col("ts").alias("started_at"),
        F.when(kind != "signup", F.timestamp_micros(
            F.unix_micros("ts") + F.floor(F.col("value") * 1000).cast("bigint") - F.lit(5_000))).alias("finished_at"),
    )


# --- invoices -------------------------------------------------------------------------------------

def invoice_extractions(spark: SparkSession, folder: str) -> DataFrame:
    """One extraction per order with lines: sums of its lines, with printing errors by key."""
    # Whole cents and whole percents keep the sums exact and in 64-bit integers.
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    percent = F.round(F.col("l_tax") * 100).cast("bigint")
    sums = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.sum(cents).alias("net"), F.sum(cents * percent).alias("tax"))
    sums = sums.withColumn("tax", F.floor((F.col("tax") + 50) / F.lit(100)))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    names = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    rows = orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey")).join(
        names, F.col("o_custkey") == F.col("c_custkey"), "left")
    key = F.col("o_orderkey")
    due = F.date_add(F.col("o_orderdate").cast("date"), 14)
    extra = F.when(key % 7 == 0, F.lit(500)).otherwise(F.lit(0))
    return rows.select(
        key.alias("order_key"),
        F.when(key % 23 == 0, "not_invoice").otherwise("invoice").alias("document_type"),
        F.when(key % 29 == 0, "").when(key % 11 != 0, F.concat(F.lit("INV-"), key.cast("string")))
        .alias("invoice_number"),
        F.col("c_name").alias("vendor_name"),
        F.when(key % 13 == 0, F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("invoice_date"),
        F.date_format(due, "yyyy-MM-dd").alias("due_date"),
        pick(F.col("c_nationkey"), "EUR", "USD", "GBP", "usd", None).alias("currency"),
        (F.col("net") / F.lit(100.0)).alias("subtotal"), (F.col("tax") / F.lit(100.0)).alias("tax_amount"),
        ((F.col("net") + F.col("tax") + extra) / F.lit(100.0)).alias("total_amount"),
        F.when(key % 5 == 0, 0.99).when(key % 5 == 1, 0.9).when(key % 5 == 2, 0.85).when(key % 5 == 3, 0.8)
        .otherwise(1.0).alias("confidence"),
        F.when(key % 31 == 0, F.array(F.lit("due_date"), F.lit("invoice_number")))
        .otherwise(F.array().cast("array<string>")).alias("missing_fields"),
    )


def invoice_files(spark: SparkSession, folder: str) -> DataFrame:
    """One file per document: most start like a PDF, some have another name, type or content, some are empty."""
    key, text = F.col("doc_id"), F.col("text")
    body = F.when(key % 19 == 0, F.lit("")).when(key % 7 == 0, text).otherwise(F.concat(F.lit("%PDF-1.7 "), text))
    return table(spark, folder, "documents").select(
        "doc_id", F.col("source").alias("message_id"),
        F.concat(F.lit("Doc_"), key.cast("string"), F.when(key % 5 == 0, ".txt").when(key % 3 == 0, ".PDF")
                 .otherwise(".pdf")).alias("file_name"),
        pick(key, "application/pdf", "APPLICATION/X-PDF", "", "text/plain", None).alias("mime_type"),
        F.when(key % 17 != 0, F.encode(body, "UTF-8")).alias("content"),
        F.when(key % 34 == 0, "Upload was interrupted.").alias("rejection_reason"),
    )


# --- leads ----------------------------------------------------------------------------------------

def lead_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per customer; the message is the text of the document with the same number."""
    key = F.col("c_custkey")
    texts = table(spark, folder, "documents").select(F.col("doc_id").alias("c_custkey"), "text")
    rows = table(spark, folder, "customer").join(texts, "c_custkey", "left")
    return rows.select(
        "c_custkey", F.concat(F.lit("req-"), key.cast("string")).alias("request_id"),
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("name"),
        F.concat(F.when(key % 6 == 0, "  User").otherwise("user"), F.floor(key / 2).cast("string"),
                 F.when(key % 13 == 0, ".mail").otherwise("@mail"), F.lit(".example.com")).alias("email"),
        F.when(key % 4 == 0, "").when(key % 9 != 0, F.concat(F.lit("Company "), F.col("c_nationkey").cast("string")))
        .alias("company"),
        F.when(key % 3 == 0, F.concat(F.lit("+1 202 555 "), F.lpad((key % 10000).cast("string"), 4, "0")))
        .alias("phone"),
        F.coalesce("text", F.lit("Please call.")).alias("message"),
        (F.col("c_acctbal") * (key % 4)).alias("estimated_budget"),
        F.when(key % 41 == 0, "").when(key % 2 == 0, "website").otherwise("partner").alias("source"),
        F.when(key % 37 != 0, key % 9 != 4).alias("consent_to_contact"),
        F.when(key % 17 != 0, F.concat(F.lit("key-"), key.cast("string"))).alias("header_key"),
        F.when(key % 34 != 0, F.concat(F.lit("body-"), key.cast("string"))).alias("idempotency_key"),
        minutes_before_now(key).alias("received_at"),
    )


def lead_signals(spark: SparkSession, folder: str) -> DataFrame:
    """One model answer per customer; urgency from the newest order's priority."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    newest = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).getField("o_orderpriority").alias("priority"))
    priority, segment = F.col("priority"), F.col("c_mktsegment")
    return table(spark, folder, "customer").join(newest, "c_custkey", "left").select(
        "c_custkey", pick(key, "new_project", "consultation", "partnership", "support", "other").alias("intent"),
        F.when(segment == "BUILDING", "workflow_automation").when(segment == "AUTOMOBILE", "ai_integration")
        .when(segment == "MACHINERY", "crm_integration").when(segment == "HOUSEHOLD", "other")
        .when(key % 2 == 0, "data_pipeline").otherwise("unclear").alias("requested_service"),
        F.when(priority == "1-URGENT", "immediate").when(priority == "2-HIGH", "within_month")
        .when(priority == "3-MEDIUM", "this_quarter").when(priority == "4-NOT SPECIFIED", "exploring")
        .otherwise("unclear").alias("urgency"),
        pick(nation, "under_5k", "5k_10k", "10k_20k", "20k_plus", "unknown").alias("budget_category"),
        pick(nation, "strong", "medium", "weak", "unknown").alias("decision_maker_signal"),
        ((key * 7 % 100).cast("double") / F.lit(100.0)).alias("confidence"),
        (key % 19 == 0).alias("extraction_failed"),
    )


def leads(spark: SparkSession, folder: str) -> DataFrame:
    """Requests with their model answers and two outcome flags."""
    key = F.col("c_custkey")
    return lead_requests(spark, folder).join(lead_signals(spark, folder), "c_custkey").withColumn(
        "known", key % 5 == 0).withColumn("crm_failed", key % 27 == 1)


# --- runs and digests -----------------------------------------------------------------------------

def pipeline_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One run per order, with breaches of the row rules by key."""
    key = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "running").otherwise(
        "failed")
    rows = table(spark, folder, "orders").withColumn("status", status)
    finished = F.timestamp_micros(F.unix_micros("o_orderdate") + (key % 50 - 1) * MINUTE)
    closed = (F.col("status") != "running") | (key % 101 == 0)
    return rows.select(
        key.alias("run_id"), "status",
        pick(key, "scheduled", "manual", "dry_run", "cron").alias("trigger_type"),
        F.col("o_orderdate").alias("started_at"), F.when(closed, finished).alias("finished_at"),
        F.when(closed, (key % 50 - 1) * 60_000).alias("duration_ms"),
        (key % 4).alias("feeds_total"), (key % 5).alias("feeds_succeeded"),
        (key % 40).alias("items_fetched"), (key % 30).alias("items_inserted"), (key % 7).alias("items_duplicate"),
        (key % 26).alias("candidates_count"), (key % 8).alias("selected_count"),
        F.when((F.col("status") == "failed") & (key % 6 != 0), pick(key, "FEED_TIMEOUT", "OPENAI_TIMEOUT", "UNKNOWN"))
        .alias("error_code"),
        F.when((F.col("status") == "failed") | (key % 71 == 0), "Stopped.").alias("error_summary"),
        F.lit("1.0").alias("app_version"),
    )


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """One digest per order."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        key.alias("digest_id"), key.alias("run_id"), F.col("o_orderdate").cast("date").alias("digest_date"),
        F.concat(F.lit("Digest <"), F.col("o_orderpriority"), F.lit("> & more ")).alias("digest_title"),
        F.when(status == "F", "sent").when(status == "O", "generated").otherwise("failed").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.when((status == "F") & (key % 9 != 0), F.timestamp_micros(
            F.unix_micros("o_orderdate") + (key % 60) * MINUTE)).alias("sent_at"),
    )


def digest_items(spark: SparkSession, folder: str) -> DataFrame:
    """Items of each order's digests: all lines of an order by number, cut into digests of at most seven.

    ``digest_id`` is the order's key and the number of the cut.
    """
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    given = table(spark, folder, "lineitem")
    lines = dealt(given.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), given, "l_orderkey").withColumn(
        "place", F.row_number().over(order) - 1)
    part = F.col("l_partkey")
    return lines.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.floor(F.col("place") / 7).cast("string")).alias("digest_id"),
        (F.col("place") % 7 + 1).alias("position"), part.alias("news_item_id"),
        pick(part, "AI_MODELS", "AUTOMATION", "DEVELOPER_TOOLS", "PRODUCT").alias("tag"),
        F.concat(F.lit("Part "), part.cast("string"), F.lit(" from supplier "), F.col("l_suppkey").cast("string"),
                 F.lit(" <b>is</b> \"new\" & improved; it's worth a look for every team that builds things.")
                 ).alias("summary"),
    )


def order_of(digest_id: str = "digest_id") -> Column:
    """The order a digest of ``digest_items`` belongs to."""
    return F.substring_index(digest_id, "-", 1).cast("long")


def part_news(spark: SparkSession, folder: str) -> DataFrame:
    """One article per part; the brand stands for the source."""
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.alias("news_item_id"), F.col("p_brand").alias("source_key"),
        F.concat(F.col("p_name"), F.lit(" & "), F.col("p_type")).alias("title"),
        F.concat(F.lit("https://parts.example.com/a?x=1&id="), key.cast("string")).alias("canonical_url"),
        pick(key, "candidate", "candidate", "candidate", "candidate", "candidate", "candidate", "candidate", "used",
             "collected").alias("status"),
    )


def brand_sources(spark: SparkSession, folder: str) -> DataFrame:
    """One source per brand."""
    return table(spark, folder, "part").select("p_brand").distinct().select(
        F.col("p_brand").alias("source_key"), F.concat(F.lit("Brand \""), F.col("p_brand"), F.lit("\"")).alias("name"))
