"""Feed bodies and fetch results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weirgate import constants as C, schemas
from weirgate.functions import hashing
from weirgate.functions.text import header_is_safe, strip
from weirgate.functions.times import parse_feed_date

_XML = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _filled(value: Column) -> Column:
    return F.when(strip(value) != "", value)


def _first_text(parts: Column) -> Column:
    return F.try_element_at(F.filter(F.transform(parts, lambda part: _filled(part["_VALUE"])),
                                     lambda text: text.isNotNull()), F.lit(1))


def _entry_columns(item: Column) -> list[Column]:
    """Entry fields of one parsed item, each with its fallbacks in order."""
    links = item["link"]
    alternate = F.filter(links, lambda link: F.coalesce(link["_rel"], F.lit("alternate")) == "alternate")

    def first_href(options: Column) -> Column:
        hrefs = F.filter(F.transform(options, lambda link: strip(link["_href"])), lambda href: href != "")
        return F.try_element_at(hrefs, F.lit(1))

    external = F.coalesce(item["id"]["_VALUE"], item["guid"]["_VALUE"])
    return [
        strip(external).alias("external_id"),
        F.coalesce(strip(_first_text(links)), first_href(alternate), first_href(links)).alias("link"),
        strip(item["title"]["_VALUE"]).alias("title"),
        F.coalesce(
            _filled(item["summary"]["_VALUE"]), _filled(item["description"]["_VALUE"]),
            _filled(F.try_element_at(item["content"], F.lit(1))["_VALUE"]), _filled(item["encoded"]["_VALUE"]),
        ).alias("summary"),
        strip(F.coalesce(item["author"]["name"], item["author"]["_VALUE"], item["creator"])).alias("author"),
        F.coalesce(
            parse_feed_date(F.coalesce(item["pubDate"], item["published"], item["date"])),
            parse_feed_date(item["updated"]),
        ).alias("published_at"),
    ]


def parse_feed_bodies(bodies: DataFrame, body: str = "body") -> DataFrame:
    """Entries of RSS, Atom and RDF bodies in document order (A2).

    Adds ``entry_index`` (from 0) and the entry fields to the other columns of ``bodies``. A body without entries
    keeps one row with a null ``entry_index`` and ``parse_error`` = ``FEED_PARSE_FAILED``; junk after the last good
    entry is ignored.
    """
    kept = [name for name in bodies.columns if name != body]
    parsed = bodies.select(*kept, F.from_xml(F.col(body), schemas.FEED_BODY.simpleString(), _XML).alias("_feed"))
    items = parsed.select(*kept, F.coalesce(
        F.col("_feed.channel.item"), F.col("_feed.entry"), F.col("_feed.item")).alias("_items"))
    rows = items.select(*kept, F.posexplode_outer("_items").alias("entry_index", "_item"))
    return rows.select(
        *kept, "entry_index", *_entry_columns(F.col("_item")),
        F.when(F.col("entry_index").isNull(), "FEED_PARSE_FAILED").alias("parse_error"),
    )


def read_feed_entries(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Entries of XML files, scanned by tag (A2). Rows carry ``parse_error`` where the text was unreadable.

    Each file is one feed or several well-formed ones; the scan ends at the first junk in a file and keeps what came
    before. It has no document order: ``scan_feed_entries`` adds it. For bodies in a table use ``parse_feed_bodies``.
    """
    scanned = (
        spark.read.format("xml").schema(schemas.FEED_ITEM).options(**_XML).option("rowTag", row_tag).load(path)
    )
    fields = [field.name for field in schemas.FEED_ITEM.fields if field.name != "_corrupt"]
    rows = scanned.select(F.struct(*fields).alias("_item"), "_corrupt")
    return rows.select(
        *_entry_columns(F.col("_item")),
        F.when(F.col("_corrupt").isNotNull(), "FEED_PARSE_FAILED").alias("parse_error"),
    )


def scan_feed_entries(spark: SparkSession, path: str, row_tag: str = "item") -> DataFrame:
    """Entries of XML files in document order (A2): the columns of ``read_feed_entries``, those of partition folders, ``file`` and
    ``entry_index`` (from 0 in each file).

    Files are scanned in blocks. Inside a block entries are numbered where they are read; the entries of earlier blocks of the
    file are added from one count a block, so a file of any size is numbered without meeting in one task.
    """
    reader = spark.read.format("xml").schema(schemas.FEED_ITEM).options(**_XML).option("rowTag", row_tag)
    scanned = reader.load(path)
    fields = [field.name for field in schemas.FEED_ITEM.fields if field.name != "_corrupt"]
    folders = [name for name in scanned.columns if name not in schemas.FEED_ITEM.fieldNames()]
    rows = scanned.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_read"), *folders, F.struct(*fields).alias("_item"), "_corrupt")
    blocks = rows.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_entries"))
    upto = F.sum("_entries").over(Window.partitionBy("file").orderBy("_block"))
    before = blocks.select("file", "_block", (upto - F.col("_entries")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("file", "_block").orderBy("_read")) - 1
    placed = rows.withColumn("_inside", inside).join(before, ["file", "_block"])
    return placed.select(
        "file", *folders, (F.col("_before") + F.col("_inside")).cast("int").alias("entry_index"),
        *_entry_columns(F.col("_item")), F.when(F.col("_corrupt").isNotNull(), "FEED_PARSE_FAILED").alias("parse_error"))


def cap_entries(entries: DataFrame, limit: int | Column) -> DataFrame:
    """First ``limit`` entries of each document in document order (A3); parse failures stay."""
    return entries.where(F.col("entry_index").isNull() | (F.col("entry_index") < limit))


def classify_fetch(fetches: DataFrame, max_bytes: int) -> DataFrame:
    """Outcome of each landed fetch (A13): ``fetch_status`` and ``error_code``.

    Needs ``http_status, content_type, body_bytes, body_prefix, entries_count``; a network ``error_code`` already on
    the row wins. ``body_prefix`` is the head of the body as text.
    """
    status = F.col("http_status")
    kind = F.lower(_filled(strip(F.substring_index("content_type", ";", 1))))  # a blank header counts as absent
    looks_like_xml = F.lit(False)
    for prefix in C.FEED_XML_PREFIXES:
        looks_like_xml = looks_like_xml | F.regexp_replace("body_prefix", r"\A[ \t\n\r\x0b\f]+", "").startswith(prefix)
    wrong_type = kind.isNotNull() & ~kind.isin(*C.FEED_CONTENT_TYPES) & ~F.coalesce(looks_like_xml, F.lit(False))
    code = (
        F.when(F.col("error_code").isNotNull(), F.col("error_code"))
        .when(status == 304, F.lit(None).cast("string"))
        .when(status.isNull() | ~status.between(200, 299), "FEED_CONNECTION_FAILED")
        .when(F.col("body_bytes") > max_bytes, "FEED_RESPONSE_TOO_LARGE")
        .when(wrong_type | (F.coalesce("entries_count", F.lit(0)) == 0), "FEED_PARSE_FAILED")
    )
    outcome = (
        F.when(F.col("error_code").isNotNull(), "failed")
        .when(F.col("http_status") == 304, "not_modified")
        .otherwise("success")
    )
    return fetches.withColumn("error_code", code).withColumn("fetch_status", outcome)


def detect_unchanged(bodies: DataFrame, sources: DataFrame, key: str = "source_key") -> DataFrame:
    """Compare each landed body with the validator stored for its source.

    Adds ``etag``, ``http_status`` (304 or 200) and ``unchanged``. ``sources`` has one row per key with
    ``stored_etag``; an unsafe stored header never matches.
    """
    stored = sources.select(key, F.when(header_is_safe("stored_etag"), F.col("stored_etag")).alias("stored_etag"))
    joined = bodies.withColumn("etag", hashing.body_validator(F.col("body"))).join(stored, key, "left")
    same = F.coalesce(F.col("etag") == F.col("stored_etag"), F.lit(False))
    return joined.withColumn("unchanged", same).withColumn(
        "http_status", F.when(same, 304).otherwise(200)
    ).drop("stored_etag")
