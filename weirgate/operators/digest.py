"""Digest candidates, validation, rendering and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirgate import constants as C
from weirgate.functions.numbers import fixed
from weirgate.functions.text import escape_html5, strip
from weirgate.operators.keys import one_per_key

#: Anything in a summary that looks like a link or like markup.
URL_OR_MARKUP = r"(?i)(https?://|www\.|<|>|\[/?(b|i|u|code|pre|a)\]|telegram\.me)"


def candidate_ids(candidates: DataFrame, run: str = "run_id") -> DataFrame:
    """Opaque ids ``c_01``, ``c_02``, ... in rank order per run (E6); from 100 on they are longer, never cut."""
    ranked = Window.partitionBy(run).orderBy(F.col("score").desc(), F.col("news_item_id").asc())
    return candidates.withColumn("rank", F.row_number().over(ranked)).withColumn(
        "candidate_id", F.concat(F.lit("c_"), F.when(F.col("rank") < 10, "0").otherwise(""), F.col("rank").cast("string")))


def _json_text(value: Column) -> Column:
    quoted = F.to_json(F.array(F.coalesce(value, F.lit(""))))
    return F.regexp_extract(quoted, r"(?s)\A\[(.*)\]\z", 1)


def _iso_offset(moment: Column) -> Column:
    micros = F.unix_micros(moment) % 1_000_000
    fraction = F.when(micros == 0, "").otherwise(F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0")))
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def article_json() -> Column:
    """One article of the model request, as JSON text."""
    fields = {
        "candidate_id": F.col("candidate_id"),
        "source_name": F.col("source_name"),
        "title": F.col("title"),
        "summary": F.substring("sanitized_summary", 1, C.EXCERPT_MAX_CHARS),
        "published_at": F.coalesce(_iso_offset(F.col("published_at")), F.lit("")),
        "relevance_score": fixed(F.coalesce("score", F.lit(0.0)), 3),
    }
    pieces = [F.concat(F.lit(f'"{name}": '), _json_text(value)) for name, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pieces), F.lit("}"))


def article_payload(candidates: DataFrame, run: str = "run_id", limit: int = C.MAX_CANDIDATES) -> DataFrame:
    """The request text per run (H16): articles in rank order.

    One slot per rank instead of a collected list, so a group can never outgrow ``limit`` articles. A run with more gets no
    text but ``payload_error``.
    """
    text = article_json()
    slots = [F.max(F.when(F.col("rank") == place, text)).alias(f"_{place}") for place in range(1, limit + 1)]
    grouped = candidates.withColumn("_json", text).groupBy(run).agg(*slots, F.count(F.lit(1)).alias("_count"))
    error = F.when(F.col("_count") > limit, F.concat(
        F.lit(f"a request holds at most {limit} articles, got "), F.col("_count").cast("string")))
    body = F.array_join(F.array_compact(F.array(*[f"_{place}" for place in range(1, limit + 1)])), ", ")
    whole = F.when(error.isNull(), F.concat(F.lit('{"articles": ['), body, F.lit("]}")))
    return grouped.select(run, whole.alias("articles_json"), error.alias("payload_error"))


def digest_item_bounds(top: int, maximum: int, minimum: int, available: Column) -> tuple[Column, Column]:
    """Fewest and most items a digest may have."""
    desired = F.least(F.lit(top), F.lit(maximum), available.cast("int"))
    return F.least(F.lit(minimum), desired), desired


def validate_digest_output(outputs: DataFrame, contexts: DataFrame, top: int = 5, maximum: int = 7,
                           minimum: int = 3, run: str = "run_id") -> DataFrame:
    """All rule breaches of each model output (B14): adds ``errors``, ``accepted`` and ``news_ids``.

    ``outputs`` has an ``output`` struct; ``contexts`` has ``candidate_id, news_item_id, status`` per run. The contexts of
    a run travel as one map, so items are checked in place and never regrouped. The contract gives ids of two digits; a
    run with others is refused with an error, and only ids of two digits enter the map, which bounds it. Nulls in an item
    count as breaches.
    """
    usable = contexts.where("candidate_id is not null").groupBy(run, "candidate_id").agg(
        F.min(F.struct("news_item_id", "status")).alias("_context"))
    entry = F.when(F.rlike("candidate_id", F.lit(r"\Ac_\d{2}\z")), F.struct("candidate_id", "_context"))
    by_run = one_per_key(usable, [run], F.map_from_entries(F.collect_list(entry)).alias("_contexts"),
                         F.count(F.lit(1)).alias("_given"))
    rows = outputs.join(by_run, run, "left")
    contexts_map = F.col("_contexts")
    items = F.coalesce(F.col("output.items"), F.expr("array()").cast(
        "array<struct<candidate_id:string,summary:string,tag:string,relevance_score:double,selection_reason:string>>"))
    given = F.coalesce("_given", F.lit(0))
    least, most = digest_item_bounds(top, maximum, minimum, given)
    rows = rows.withColumn("_items", items).withColumn("_least", least).withColumn("_most", most).withColumn(
        "_ids", F.transform("_items", lambda item: F.coalesce(item["candidate_id"], F.lit(""))))
    size = F.size("_items")
    count_error = F.when(~size.between(F.col("_least"), F.col("_most")), F.concat(
        F.lit("item count must be between "), F.col("_least").cast("string"), F.lit(" and "),
        F.col("_most").cast("string"), F.lit(", got "), size.cast("string")))
    foreign = F.when(given > F.coalesce(F.size(contexts_map), F.lit(0)), F.lit("candidate ids must be c_ and two digits"))

    def item_errors(item: Column, index: Column) -> Column:
        name = F.coalesce(item["candidate_id"], F.lit(""))
        summary = F.coalesce(item["summary"], F.lit(""))
        context = F.try_element_at(contexts_map, name)
        known = context.isNotNull()
        length_ok = F.length(summary).between(80, 280)
        checks = [
            F.when(F.array_position("_ids", name) != index + 1, F.concat(F.lit("duplicate candidate_id "), name)),
            F.when(~known, F.concat(F.lit("unknown candidate_id "), name)),
            F.when(known & (context["status"] == "used"),
                   F.concat(F.lit("candidate "), name, F.lit(" was already used"))),
            F.when(known & ~F.coalesce(context["status"].isin("used", "candidate"), F.lit(False)),
                   F.concat(F.lit("candidate "), name, F.lit(" is not in candidate status"))),
            F.when(known & ~length_ok, F.lit("summary length must be between 80 and 280 characters")),
            F.when(known & F.rlike(summary, F.lit(URL_OR_MARKUP)),
                   F.lit("summary must not contain URLs, HTML, or Telegram markup")),
            F.when(known & ~F.coalesce(item["tag"].isin(*C.DIGEST_TAGS), F.lit(False)),
                   F.concat(F.lit("invalid tag for "), name)),
        ]
        return F.array_compact(F.array(*checks))

    errors = F.concat(F.array_compact(F.array(foreign, count_error)), F.flatten(F.transform("_items", item_errors)))
    rows = rows.withColumn("errors", errors).withColumn("accepted", F.size("errors") == 0)
    news = F.transform("_ids", lambda name: F.try_element_at(contexts_map, name)["news_item_id"])
    return rows.withColumn("news_ids", F.when(F.col("accepted"), news)).drop(
        "_contexts", "_given", "_items", "_ids", "_least", "_most")


def validation_error_text(errors: Column) -> Column:
    """One ``- error`` line each, at most 500 characters (K6)."""
    return F.substring(F.array_join(F.transform(errors, lambda error: F.concat(F.lit("- "), error)), "\n"), 1, 500)


def repair_outcome(primary: DataFrame, repair: DataFrame, run: str = "run_id") -> DataFrame:
    """What a run's two answers come to: both are results of ``validate_digest_output``, one row a run.

    Adds ``answer`` (``primary``, ``repair`` or null), ``repair_errors`` (what the second request is told; null where the
    first answer is accepted) and, where both answers are rejected, ``error_code`` and ``error_summary``. ``news_ids`` are
    those of the answer taken.
    """
    second = one_per_key(repair, [run], F.max(F.struct("accepted", "errors", "news_ids")).alias("_second"))
    rows = primary.join(second, run, "left")
    taken = F.when(F.col("accepted"), "primary").when(F.col("_second.accepted"), "repair")
    failed = taken.isNull() & F.col("_second").isNotNull()
    return rows.withColumns({
        "answer": taken,
        "repair_errors": F.when(~F.col("accepted"), validation_error_text(F.col("errors"))),
        "error_code": F.when(failed, "OUTPUT_POST_VALIDATION_FAILED"),
        "error_summary": F.when(failed, validation_error_text(F.col("_second.errors"))),
        "news_ids": F.when(F.col("accepted"), F.col("news_ids")).when(
            F.col("_second.accepted"), F.col("_second.news_ids")),
    }).drop("_second")


def accepted_items(validated: DataFrame, key: str = "digest_id") -> DataFrame:
    """Digest items of accepted outputs, in output order."""
    rows = validated.where("accepted").select(
        key, F.posexplode(F.arrays_zip(F.col("output.items").alias("item"), F.col("news_ids").alias("news"))))
    return rows.select(
        key, F.col("col.news").alias("news_item_id"), (F.col("pos") + 1).alias("position"),
        F.col("col.item.summary").alias("summary"), F.col("col.item.tag").alias("tag"),
        F.col("col.item.relevance_score").cast("decimal(4,3)").alias("relevance_score"),
        F.col("col.item.selection_reason").alias("selection_reason"),
    )


def _position_error() -> Column:
    """The first broken position rule of a group with ``items``, ``_low``, ``_high``, ``_mask`` and ``_news``."""
    return (
        F.when(F.col("items") > C.DIGEST_MAX_ITEMS, "Digest must contain between 1 and 7 items")
        .when(F.bit_count("_mask") + F.col("_outside") < F.col("items"), "Digest item positions must be unique")
        .when(F.col("_news") < F.col("items"), "Digest news items must be unique")
        .when(F.coalesce((F.col("_low") != 1) | (F.col("_high") != F.col("items")), F.lit(True)),
              "Digest item positions must be consecutive starting at 1")
    )


def _position_state(position: str) -> list[Column]:
    """Aggregates of fixed size over positions: those up to 62 as bits, the others (never allowed) as a count."""
    inside = F.col(position).between(0, 62)
    bit = F.when(inside, F.expr(f"shiftleft(1L, cast(`{position}` as int))"))
    return [F.count(F.lit(1)).alias("items"), F.min(position).alias("_low"), F.max(position).alias("_high"),
            F.coalesce(F.bit_or(bit), F.lit(0)).alias("_mask"),
            F.count_if(~F.coalesce(inside, F.lit(False))).alias("_outside")]


def check_positions(items: DataFrame, key: str = "digest_id", position: str = "position",
                    news: str = "news_item_id") -> DataFrame:
    """Position errors per digest (E7): count out of range, repeated positions or news, gaps.

    Rows are combined by digest and article first, so distinct articles need no second copy of the rows.
    """
    by_news = items.groupBy(key, news).agg(*_position_state(position))
    counted = by_news.groupBy(key).agg(
        F.sum("items").alias("items"), F.min("_low").alias("_low"), F.max("_high").alias("_high"),
        F.bit_or("_mask").alias("_mask"), F.sum("_outside").alias("_outside"), F.count(news).alias("_news"))
    return counted.select(key, "items", _position_error().alias("position_error"))


def digest_lines(items: DataFrame, news: DataFrame, sources: DataFrame) -> DataFrame:
    """Items with their article and source (C7); ``missing_parent`` marks items without one."""
    joined = items.join(
        news.select("news_item_id", "source_key", "title", "canonical_url"), "news_item_id", "left"
    ).join(sources.select("source_key", F.col("name").alias("source_name"), F.lit(True).alias("_source")),
           "source_key", "left")
    missing = F.col("title").isNull() | F.col("_source").isNull()
    return joined.withColumn("missing_parent", missing).drop("_source")


def render_item() -> Column:
    """One digest entry (K1): numbered title, tag, summary, link."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("<b>"), F.col("position").cast("string"), F.lit(". "), escape_html5("title"), F.lit("</b>")),
        F.concat(F.lit(f"<blockquote>{C.TAG_EMOJI} "), escape_html5("tag"), F.lit("</blockquote>")),
        escape_html5("summary"),
        F.concat(F.lit(f'{C.LINK_EMOJI} <a href="'), escape_html5("canonical_url"), F.lit(f'">{C.READ_ON}'),
                 escape_html5("source_name"), F.lit("</a>")),
    )


def digest_blocks(lines: DataFrame, key: str = "digest_id") -> DataFrame:
    """Rendered entries of each digest as an array in position order, with ``items`` and ``digest_error``.

    A digest has at most seven positions. Each has its own slot in the aggregate, so the group state is bounded and
    combined before the shuffle, whatever the input holds. A digest that breaks a position rule, repeats an article or
    has an item without article or source gets the error and no entries.
    """
    rendered = lines.withColumn("_block", render_item())
    places = range(1, C.DIGEST_MAX_ITEMS + 1)
    article = F.col("news_item_id") if "news_item_id" in lines.columns else F.col("position")
    news = [F.max(F.when(F.col("position") == place, article)).alias(f"_n{place}") for place in places]
    slots = [F.max(F.when(F.col("position") == place, F.col("_block"))).alias(f"_{place}") for place in places]
    grouped = rendered.groupBy(key).agg(
        *slots, *news, *_position_state("position"), F.count_if("missing_parent").alias("missing_parents"))
    # With unique positions from 1 to 7 each slot holds one item, so the slots tell whether an article is repeated.
    grouped = grouped.withColumn("_news", F.size(F.array_distinct(F.array_compact(
        F.array(*[f"_n{place}" for place in places]))))).withColumn(
        "_news", F.when((F.col("_outside") == 0) & (F.col("_high") <= C.DIGEST_MAX_ITEMS) & (F.col("_low") >= 1),
                        F.col("_news")).otherwise(F.col("items")))
    error = F.coalesce(_position_error(), F.when(F.col("missing_parents") > 0, C.DIGEST_UNUSABLE))
    blocks = F.array_compact(F.array(*[f"_{place}" for place in places]))
    return grouped.select(key, "items", "missing_parents", error.alias("digest_error"),
                          F.when(error.isNull(), blocks).alias("blocks"))


def _title(title: Column) -> Column:
    return F.concat(F.lit(f"{C.TITLE_EMOJI} <b>"), escape_html5(strip(title)), F.lit("</b>"))


def _footer(count: Column) -> Column:
    return F.concat(count.cast("string"), F.lit(C.FOOTER_STORIES), F.lit("\n" + C.FOOTER_VERIFY))


def render_digest(digests: DataFrame) -> DataFrame:
    """Full text of each digest (K2), null where ``blocks`` is. Needs ``digest_title`` and ``blocks``."""
    body = F.array_join("blocks", C.ITEM_SEPARATOR)
    return digests.withColumn("rendered_text", F.concat(
        _title(F.col("digest_title")), F.lit("\n\n"), body, F.lit("\n\n"), _footer(F.size("blocks")), F.lit("\n")))


def split_messages(digests: DataFrame, limit: int = C.MESSAGE_LIMIT) -> DataFrame:
    """Message parts of each digest (K3): adds ``parts`` and ``split_error``.

    Entries fill a part greedily. Every part reserves room for title and footer, though only the first shows the title
    and only the last the footer. An entry that does not fit alone fails the digest.
    """
    rows = digests.withColumn("_title", _title(F.col("digest_title"))).withColumn("_footer", _footer(F.size("blocks")))
    overhead = F.length("_title") + F.length("_footer") + 5
    rows = rows.withColumn("_room", F.lit(limit) - overhead)
    state = "struct<done:array<string>,open:string>"
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def fill(filled: Column, block: Column) -> Column:
        wider = F.concat(filled["open"], F.lit(C.ITEM_SEPARATOR), block)
        fits = F.length(wider) <= F.col("_room")
        return (
            F.when(filled["open"].isNull(), F.struct(filled["done"].alias("done"), block.alias("open")))
            .when(fits, F.struct(filled["done"].alias("done"), wider.alias("open")))
            .otherwise(F.struct(F.concat(filled["done"], F.array(filled["open"])).alias("done"), block.alias("open")))
        ).cast(state)

    groups = F.aggregate("blocks", start.cast(state), fill,
                         lambda filled: F.concat(filled["done"], F.array(filled["open"])))
    rows = rows.withColumn("_groups", groups)
    oversized = F.exists("blocks", lambda block: F.length(block) > F.col("_room"))
    given = F.col("digest_error") if "digest_error" in digests.columns else F.lit(None).cast("string")
    error = F.when(given.isNotNull(), given).when(
        F.coalesce(F.size("blocks") == 0, F.lit(True)), "digest must contain at least one item").when(
        oversized, "a single digest item exceeds the Telegram message size limit")
    parts = F.transform("_groups", lambda group, index: F.concat(
        F.when(index == 0, F.concat(F.col("_title"), F.lit("\n\n"))).otherwise(""), group,
        F.when(index == F.size("_groups") - 1, F.concat(F.lit("\n\n"), F.col("_footer"))).otherwise(""),
        F.lit("\n")))
    return rows.withColumn("split_error", error).withColumn(
        "parts", F.when(F.col("split_error").isNull(), parts)).drop("_title", "_footer", "_room", "_groups")


def consume_candidates(items: DataFrame, news: DataFrame, key: str = "digest_id") -> tuple[DataFrame, DataFrame]:
    """Take the candidates of new digests, all or nothing per digest.

    Returns the digests with ``created`` and ``error``, and the news table with consumed items set to ``used``.
    """
    states = news.select("news_item_id", F.col("status").alias("_status"))
    checked = one_per_key(
        items.join(states, "news_item_id", "left"), [key], F.count_if(F.col("_status").isNull()).alias("missing"),
        F.count_if(F.col("_status") != "candidate").alias("not_candidate"))
    error = F.when(F.col("missing") > 0, "One or more selected news items do not exist.").when(
        F.col("not_candidate") > 0, "All selected news items must have candidate status.")
    digests = checked.select(key, error.isNull().alias("created"), error.alias("error"))
    taken = items.join(digests.where("created").select(key), key, "left_semi").select("news_item_id").distinct()
    updated = news.join(taken.withColumn("_taken", F.lit(True)), "news_item_id", "left").withColumn(
        "status", F.when(F.col("_taken"), "used").otherwise(F.col("status"))).drop("_taken")
    return digests, updated
