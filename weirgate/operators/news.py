"""News intake and selection."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from weirgate import constants as C
from weirgate.functions import hashing, html, text, times, urls
from weirgate.operators.components import components
from weirgate.operators.keys import one_per_key
from weirgate.session import cut_lineage
from weirgate.sources.config import TopicProfile


def normalize_entries(entries: DataFrame, sources: DataFrame, collected_at: Column,
                      maximum: int = C.ARTICLE_TEXT_MAX) -> DataFrame:
    """Feed entries as news items (B11). Unusable entries stay with a ``skip_reason``.

    ``entries`` has ``source_key, external_id, link, title, summary, author, published_at``; ``sources`` has
    ``source_key, allowed_host``. URL and HTML parsing run in Arrow UDFs; the text of an entry that is already skipped
    is not parsed.
    """
    hosts = sources.select("source_key", urls.normalize_hostname(F.col("allowed_host")).alias("_host"))
    rows = entries.withColumn("title", text.strip(F.coalesce("title", F.lit("")))).withColumn(
        "link", text.strip(F.coalesce("link", F.lit(""))))
    rows = rows.withColumn("canonical_url", urls.canonicalize_url(F.col("link"))).join(hosts, "source_key", "left")
    rows = rows.withColumn("_article_host", urls.normalize_hostname(urls.canonical_host(F.col("canonical_url"))))
    body = F.when(F.coalesce(F.col("summary"), F.lit("")) == "", F.col("title")).otherwise(F.col("summary"))
    usable = F.coalesce((F.col("title") != "") & (F.col("_article_host") == F.col("_host")), F.lit(False))
    rows = rows.withColumn("_from_body", html.sanitize_html(F.when(usable, body), maximum)).withColumn(
        "_from_title", html.sanitize_html(F.when(F.col("_from_body") == "", F.col("title")), maximum))
    cleaned = F.when(F.col("_from_body") == "", F.col("_from_title")).otherwise(F.col("_from_body"))
    rows = rows.withColumn("sanitized_summary", cleaned).withColumn(
        "normalized_title", F.substring(text.normalize_title("title"), 1, 500))
    reason = (
        F.when((F.col("title") == "") | (F.col("link") == ""), "missing_title_or_link")
        .when(F.col("canonical_url").isNull() | F.col("_article_host").isNull() | F.col("_host").isNull(),
              "invalid_url")
        .when(F.col("_article_host") != F.col("_host"), "foreign_host")
        .when((F.col("sanitized_summary") == "") | (F.col("normalized_title") == ""), "empty_text")
    )
    return (
        rows.withColumn("skip_reason", reason)
        .withColumn("original_url", F.when(F.lower("link").startswith("https://"), F.col("link"))
                    .otherwise(F.col("canonical_url")))
        .withColumn("url_hash", hashing.url_hash(F.col("canonical_url")))
        .withColumn("content_hash", hashing.content_hash(F.col("normalized_title"), F.col("sanitized_summary")))
        .withColumn("title", F.substring("title", 1, 500))
        .withColumn("author", F.substring(F.nullif("author", F.lit("")), 1, 255))
        .withColumn("collected_at", collected_at)
        .withColumn("status", F.lit("collected"))
        .drop("_host", "_article_host", "_from_body", "_from_title")
    )


def age_anchor() -> Column:
    """Publication time, else collection time."""
    return F.coalesce("published_at", "collected_at")


def eligible_items(items: DataFrame, now: datetime | str, max_age_hours: int, limit: int | None = None) -> DataFrame:
    """Collected or candidate items inside the age window, newest first (F1).

    With a ``limit`` (the reporting feature) Spark plans a top-k that keeps ``limit`` rows per task; without one the
    whole table passes.
    """
    rows = items.where(F.col("status").isin("collected", "candidate")
                       & ~times.is_too_old(age_anchor(), now, max_age_hours))
    if limit is None:
        return rows
    return rows.orderBy(age_anchor().desc(), F.col("news_item_id").asc()).limit(limit)


def enabled_sources(sources: DataFrame) -> DataFrame:
    """Enabled sources by priority, then key."""
    return sources.where("enabled").orderBy(F.col("priority").desc(), F.col("source_key").asc())


def all_sources(sources: DataFrame) -> DataFrame:
    """All sources by key."""
    return sources.orderBy("source_key")


def source_by_key(sources: DataFrame, key: str) -> DataFrame:
    """Source with the given key, after trimming and lower-casing it."""
    return sources.where(F.col("source_key") == key.strip().lower())


def attach_source(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Add ``priority`` and ``source_known`` from the enabled sources (C4)."""
    enabled = sources.where("enabled").select("source_key", "priority", F.lit(True).alias("source_known"))
    joined = items.join(enabled, "source_key", "left")
    return joined.withColumn("source_known", F.coalesce("source_known", F.lit(False)))


def ignore_reason(profile: TopicProfile, now: datetime | str, max_age_hours: int) -> Column:
    """First reason to ignore an item, null when there is none."""
    excluded = F.lit(False)
    for keyword in profile.exclude_keywords:
        excluded = excluded | F.contains(F.col("_haystack"), F.lit(keyword))
    return (
        F.when(~F.col("source_known"), "irrelevant")
        .when(F.col("status").isin("used", "ignored"), "irrelevant")
        .when(times.is_too_old(age_anchor(), now, max_age_hours), "too_old")
        .when(F.length("_title") < profile.min_title_length, "missing_title")
        .when(F.length("_summary") < profile.min_summary_length, "missing_content")
        .when(excluded, "irrelevant")
    )


def relevance_score(profile: TopicProfile, now: datetime | str, max_age_hours: int) -> Column:
    """Weighted keyword share, freshness and source priority."""
    return (
        F.lit(C.KEYWORD_WEIGHT) * text.keyword_share(F.col("_haystack"), profile.include_keywords)
        + F.lit(C.FRESHNESS_WEIGHT) * times.freshness(age_anchor(), now, max_age_hours)
        + F.lit(C.SOURCE_WEIGHT) * (F.col("priority").cast("double") / F.lit(10.0))
    )


def score_items(items: DataFrame, sources: DataFrame, profile: TopicProfile, now: datetime | str,
                max_age_hours: int = 72) -> DataFrame:
    """Add ``ignore_reason`` and, where it is null, ``score``. Texts are dropped: only they are large.

    Trimmed texts and the haystack are worked out once, only for rows that pass the cheap status and age rules, and
    live in the map stage only; rows leave it with keys, reason and score.
    """
    open_row = F.col("source_known") & ~F.col("status").isin("used", "ignored") & ~times.is_too_old(
        age_anchor(), now, max_age_hours)
    rows = attach_source(items, sources).withColumns(
        {f"_{short}": F.when(open_row, text.strip(name))
         for short, name in (("title", "title"), ("summary", "sanitized_summary"))})
    rows = rows.withColumn("_haystack", F.lower(F.concat("_title", F.lit(" "), "_summary")))
    rows = rows.withColumn("ignore_reason", ignore_reason(profile, now, max_age_hours))
    score = F.when(F.col("ignore_reason").isNull(), relevance_score(profile, now, max_age_hours))
    return rows.select("news_item_id", "source_key", "title", "status", "published_at", "ignore_reason",
                       score.alias("score"))


def diversify(scored: DataFrame, per_source: int = C.MAX_ITEMS_PER_SOURCE, limit: int = C.MAX_CANDIDATES) -> DataFrame:
    """At most ``per_source`` items per source, best ``limit`` overall.

    Equal to walking the ranking and skipping full sources. The rank filter becomes a group limit before the shuffle,
    so each task sends at most ``per_source`` rows per source, however large the source is. Rows without a score rank
    last and are dropped afterwards: a filter before the rank would work out every score twice.
    """
    by_rank = Window.partitionBy("source_key").orderBy(F.col("score").desc_nulls_last(), F.col("news_item_id").asc())
    kept = scored.withColumn("source_rank", F.row_number().over(by_rank)).where(F.col("source_rank") <= per_source)
    return kept.where(F.col("score").isNotNull()).orderBy(F.col("score").desc(), F.col("news_item_id").asc()).limit(limit)


def select_candidates(items: DataFrame, sources: DataFrame, profile: TopicProfile, now: datetime | str,
                      max_age_hours: int = 72, per_source: int = C.MAX_ITEMS_PER_SOURCE,
                      limit: int = C.MAX_CANDIDATES) -> DataFrame:
    """Ranked candidates of a selection pass."""
    return diversify(score_items(items, sources, profile, now, max_age_hours), per_source, limit)


def external_key() -> Column:
    """Key of (source, external id). Rows without an external id get a key of their own that matches nothing, so
    they spread over all tasks instead of meeting in the null partition."""
    return F.when(F.col("external_id").isNotNull(), F.concat(F.lit("e"), F.concat_ws("\x1f", "source_key", "external_id"))
                  ).otherwise(F.concat(F.lit("n"), F.col("url_hash")))


def insert_if_new(new: DataFrame, existing: DataFrame, on_conflict: str = "mark") -> DataFrame:
    """Compare new items with stored ones (C5): adds ``outcome`` and ``matched_id``.

    A stored item matches by URL hash or by (source, external id). Matching two different stored items is a
    ``conflict``; ``on_conflict="fail"`` raises an error for the first such row instead.
    """
    by_url = one_per_key(existing, ["url_hash"], F.min("news_item_id").alias("_by_url"))
    by_external = one_per_key(
        existing.where(F.col("external_id").isNotNull()).select(external_key().alias("_ext"), "news_item_id"), ["_ext"],
        F.min("news_item_id").alias("_by_ext"))
    rows = new.withColumn("_ext", external_key()).join(by_url, "url_hash", "left").join(by_external, "_ext", "left")
    both = F.col("_by_url").isNotNull() & F.col("_by_ext").isNotNull() & (F.col("_by_url") != F.col("_by_ext"))
    conflict: Column = F.lit("conflict")
    if on_conflict == "fail":
        conflict = F.raise_error(F.lit("deduplication keys do not identify one stored item")).cast("string")
    outcome = F.when(both, conflict).when(
        F.coalesce("_by_url", "_by_ext").isNull(), "new").otherwise("duplicate")
    return rows.withColumn("outcome", outcome).withColumn(
        "matched_id", F.when(~both, F.coalesce("_by_url", "_by_ext"))).drop("_ext", "_by_url", "_by_ext")


#: Rounds after which ``admit_in_batch`` follows chains: a random order is nearly done by then.
CHAIN_ROUND = 6


def _firsts(active: DataFrame, key: str, parents: bool) -> DataFrame:
    """The first row of each key; with ``parents`` also the second, with the first as ``_parent``."""
    held = active.where(F.col(key).isNotNull())
    first = held.groupBy(key).agg(F.min("_ord").alias("_first"))
    if not parents:
        return first.select(F.col("_first").alias("_ord"))
    rest = held.join(first.select(F.col("_first").alias("_ord")), "_ord", "left_anti")
    second = rest.groupBy(key).agg(F.min("_ord").alias("_second"))
    both = first.join(second, key, "left")
    return both.select(F.col("_first").alias("_ord"), F.lit(None).alias("_parent")).unionByName(
        both.where("_second is not null").select(F.col("_second").alias("_ord"), F.col("_first").alias("_parent")))


def _follow_chains(active: DataFrame) -> DataFrame:
    """Rows that are decided by a chain of single earlier neighbours from a first row on: ``_ord``, ``_take``.

    Such a row is admitted if its only earlier neighbour is not. Chains are followed by pointer doubling, so the joins
    grow with the logarithm of their length.
    """
    one = _firsts(active, "_k1", True).withColumnRenamed("_parent", "_p1").withColumn("_in_1", F.lit(True))
    two = _firsts(active, "_k2", True).withColumnRenamed("_parent", "_p2").withColumn("_in_2", F.lit(True))
    known = active.join(one, "_ord").join(two, "_ord", "left").where(
        (F.col("_k2").isNull() | F.col("_in_2")) & (F.col("_p1").isNull() | F.col("_p2").isNull()))
    steps = cut_lineage(known.select("_ord", F.coalesce("_p1", "_p2").alias("_up"), F.lit(0).alias("_odd")).withColumn(
        "_odd", F.when(F.col("_up").isNull(), 0).otherwise(1)))
    while True:
        up = steps.select(F.col("_ord").alias("_up"), F.col("_up").alias("_next"), F.col("_odd").alias("_more"))
        moved = cut_lineage(steps.join(up, "_up", "left").select(
            "_ord", F.when(F.col("_more").isNull(), F.col("_up")).otherwise(F.col("_next")).alias("_up"),
            F.when(F.col("_more").isNull(), F.col("_odd")).otherwise((F.col("_odd") + F.col("_more")) % 2).alias("_odd"),
            (F.col("_more").isNotNull() & F.col("_next").isNotNull()).alias("_on")))
        steps = moved.drop("_on")
        if moved.where("_on").isEmpty():
            return steps.where("_up is null").select("_ord", (F.col("_odd") == 0).alias("_take"))


#: Rows that one task walks over in their order once rounds no longer get through.
WALKED = 20_000


def _walked(active: DataFrame, limit: int) -> DataFrame:
    """Rows admitted (``_ord``) among those of small conflict components, and among the earliest ``limit`` rows of large ones.

    Rows that share a key, and rows connected through such rows, are a component; no row outside has a say in it. Components of up to ``limit`` rows
    are dealt into groups of about that size and walked over in their order, each group in one task. Of larger components the earliest
    rows of all are walked over: nothing later can change them. They fall apart with what is taken out.
    """
    edges = None
    for key in ("_k1", "_k2"):
        held = active.where(F.col(key).isNotNull()).select(key, "_ord")
        first = one_per_key(held, [key], F.min("_ord").alias("b"))
        found = held.join(first, key).select(F.col("_ord").alias("a"), "b")
        edges = found if edges is None else edges.unionByName(found)
    parts = components(edges).withColumnsRenamed({"node": "_ord", "component": "_part"})
    named = cut_lineage(active.join(parts, "_ord", "left").withColumn("_part", F.coalesce("_part", "_ord")))
    sized = named.join(one_per_key(named, ["_part"], F.count(F.lit(1)).alias("_size")), "_part")
    groups = max(named.count() // limit, 1)
    small = sized.where(F.col("_size") <= limit).withColumn("_group", F.pmod(F.xxhash64("_part"), F.lit(groups)))
    early = sized.where(F.col("_size") > limit).orderBy("_ord").limit(limit).withColumn("_group", F.lit(-1).cast("bigint"))

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_ord")
        urls, externals, taken = set(), set(), []
        for order, url, external in zip(group["_ord"], group["_k1"], group["_k2"]):
            if url not in urls and (external is None or external not in externals):
                taken.append(order)
                urls.add(url)
                externals.add(external)
        return pd.DataFrame({"_ord": pd.Series(taken, dtype=group["_ord"].dtype)})

    kind = active.schema["_ord"].dataType.simpleString()
    # Keys travel as texts: a missing number would come as a float.
    columns = ["_group", "_ord", *[F.col(key).cast("string").alias(key) for key in ("_k1", "_k2")]]
    return small.unionByName(early).select(*columns).groupBy("_group").applyInPandas(walk, f"_ord {kind}")


def admit_in_batch(rows: DataFrame, order: str, url_key: str = "url_hash", ext_key: str = "ext_key") -> DataFrame:
    """First-wins admission on either of two keys, as if rows came one by one (E2): adds ``admitted``.

    ``order`` is a unique sortable column. A null ``ext_key`` never collides. Each round admits the rows that are first
    on both keys and removes all rows that share a key with them; the result is the sequential one, and for an
    arbitrary order the number of rounds grows with the logarithm of the rows (Blelloch, Fineman and Shun 2012). Orders
    that run along chains of keys would take a round per link: from round ``CHAIN_ROUND`` on, chains are followed by
    pointer doubling, and two rounds later what is left, chains that cross, is walked over by conflict components
    (``_walked``), which ends it unless a single component is larger than ``WALKED`` rows.

    Only one row per distinct key pair takes part: later copies of a pair can never be admitted. First rows are found
    by aggregates (combined before the shuffle) and joined by ``order``, which is unique, so a hot key makes no hot
    task. Rounds are cut with reliable checkpoints.
    """
    pairs = rows.groupBy(F.col(url_key).alias("_k1"), F.col(ext_key).alias("_k2")).agg(F.min(order).alias("_ord"))
    active = cut_lineage(pairs)
    admitted: DataFrame | None = None
    turn = 0
    while not active.isEmpty():
        turn += 1
        if turn < CHAIN_ROUND:
            winners = active.join(_firsts(active, "_k1", False), "_ord").join(
                _firsts(active, "_k2", False).withColumn("_first_2", F.lit(True)), "_ord", "left").where(
                F.col("_k2").isNull() | F.col("_first_2"))
        elif turn < CHAIN_ROUND + 2 or turn % 2 == 1:  # a component too large to walk over gets both in turn
            winners = active.join(_follow_chains(active).where("_take"), "_ord")
        else:
            winners = active.join(_walked(active, WALKED), "_ord")
        winners = cut_lineage(winners.select("_k1", "_k2", "_ord"))
        admitted = winners if admitted is None else admitted.unionByName(winners)
        left = active.join(winners.select("_k1"), "_k1", "left_anti")
        taken = winners.select("_k2").where(F.col("_k2").isNotNull())
        active = cut_lineage(left.join(taken, "_k2", "left_anti"))
    if admitted is None:
        return rows.withColumn("admitted", F.lit(True))
    chosen = admitted.select(F.col("_ord").alias(order), F.lit(True).alias("admitted"))
    return rows.join(chosen, order, "left").withColumn("admitted", F.coalesce("admitted", F.lit(False)))


def insert_budget(rows: DataFrame, order: Column, is_new: Column, budget: int = C.MAX_NEW_ITEMS_PER_RUN) -> DataFrame:
    """Spend an insert budget in one global order (E3): adds ``outcome`` inserted, duplicate or over_budget.

    Rows after the one that takes the last slot are neither inserted nor tested. The position of that row is found by
    a top-k over the new rows, so no window over the whole table is needed.
    """
    cut = (
        rows.where(is_new).select(order.alias("_order")).orderBy("_order").limit(budget)
        .agg(F.when(F.count(F.lit(1)) >= budget, F.max("_order")).alias("_cut"))
    )
    ordered = rows.withColumn("_order", order).withColumn("_cut", cut.scalar())
    outcome = F.when(F.col("_order") > F.col("_cut"), "over_budget").when(is_new, "inserted").otherwise("duplicate")
    return ordered.withColumn("outcome", outcome).drop("_order", "_cut")


def ingest_batch(new: DataFrame, existing: DataFrame, order: str, budget: int = C.MAX_NEW_ITEMS_PER_RUN) -> DataFrame:
    """One batch of entries against the stored ones, as if they came one by one (C5, E2, E3): adds ``outcome`` (inserted,
    duplicate, conflict or over_budget) and ``matched_id``.

    An entry that matches a stored item is not inserted, so its keys block no later entry of the batch; the first
    entry of the others on both of its keys is. Entries after the one that spends the budget are not tested.
    """
    compared = insert_if_new(new, existing).withColumn("_key", F.when(F.col("external_id").isNotNull(), external_key()))
    fresh = admit_in_batch(compared.where(F.col("outcome") == "new").select(order, "url_hash", "_key"), order,
                           ext_key="_key").select(order, F.col("admitted").alias("_admitted"))
    joined = compared.withColumnRenamed("outcome", "_compared").join(fresh, order, "left")
    spent = insert_budget(joined, F.col(order), F.coalesce("_admitted", F.lit(False)), budget)
    outcome = F.when((F.col("outcome") != "over_budget") & (F.col("_compared") == "conflict"), "conflict").otherwise(
        F.col("outcome"))
    return spent.withColumn("outcome", outcome).drop("_key", "_compared", "_admitted")


def resolve_limits(sources: DataFrame, config: DataFrame, max_per_source: int, timeout_seconds: int) -> DataFrame:
    """Entry and time limits per source (C6). ``config`` already has its defaults applied."""
    configured = config.select("source_key", F.col("max_items_per_run").alias("_items"),
                               F.col("request_timeout_seconds").alias("_timeout"))
    joined = sources.join(configured, "source_key", "left")
    return joined.select(
        *sources.columns,
        F.least(F.lit(max_per_source), F.coalesce("_items", F.lit(max_per_source)),
                F.lit(C.MAX_ENTRIES_PER_SOURCE)).alias("max_entries"),
        F.coalesce("_timeout", F.lit(timeout_seconds)).cast("double").alias("read_timeout_seconds"),
    )
