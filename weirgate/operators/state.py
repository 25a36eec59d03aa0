"""Status changes and table updates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weirgate import constants as C
from weirgate.operators.keys import one_per_key
from weirgate.operators.scan import BUCKET_SECONDS, previous_value


def is_allowed(entity: str, current: Column, target: Column) -> Column:
    """True for a status change in the entity's table. The table is fixed and small, so it is part of the expression."""
    allowed = [f"{old}>{new}" for old, new in C.TRANSITIONS[entity]]
    return F.coalesce(F.concat(current, F.lit(">"), target).isin(*allowed), F.lit(False))


def transition_error(entity: str, current: Column, target: Column) -> Column:
    """Message about a forbidden change, null for an allowed one."""
    quoted = [F.concat(F.lit("'"), status, F.lit("'")) for status in (current, target)]
    return F.when(~is_allowed(entity, current, target), F.concat(
        F.lit(f"Invalid {entity} state transition: "), quoted[0], F.lit(" -> "), quoted[1]))


def check_transitions(events: DataFrame, entity: str, key: str = "entity_id", at: str = "changed_at",
                      tie: str = "event_id", status: str = "status",
                      bucket_seconds: int | None = BUCKET_SECONDS) -> DataFrame:
    """First forbidden status change per key, with the number of changes and of forbidden ones.

    The first status of a key is its start, not a change.
    """
    changes = previous_value(events.select(key, at, tie, status), key, at, tie, status, "previous_status",
                             bucket_seconds)
    error = F.when(F.col("previous_status").isNotNull(),
                   transition_error(entity, F.col("previous_status"), F.col(status)))
    return changes.withColumn("_error", error).groupBy(key).agg(
        F.count("previous_status").alias("changes"), F.count("_error").alias("invalid_changes"),
        F.min(F.when(F.col("_error").isNotNull(), F.struct(at, tie, "_error"))).getField("_error").alias("first_error"),
    )


def apply_transitions(rows: DataFrame, requests: DataFrame, key: str = "news_item_id",
                      entity: str = "news item") -> DataFrame:
    """Apply one requested status per key (J4): allowed requests change the row, others leave an error.

    ``requests`` has ``key, target_status, request_reason``. Ignoring needs a reason; other targets forbid one. Several
    requests for one key change nothing and leave an error.
    """
    asked = one_per_key(requests, [key], F.max(F.struct("target_status", "request_reason")).alias("_asked"),
                        F.count(F.lit(1)).alias("_requests"))
    joined = rows.join(asked, key, "left").withColumns({
        "target_status": F.col("_asked.target_status"), "request_reason": F.col("_asked.request_reason")})
    target, reason = F.col("target_status"), F.col("request_reason")
    error = (
        F.when(F.col("_requests") > 1, "several status changes are requested at once")
        .when(target.isNull(), F.lit(None).cast("string"))
        .when((target == "ignored") & reason.isNull(), "ignore_reason is required when ignoring a news item")
        .when((target != "ignored") & reason.isNotNull(), "ignore_reason is only allowed for ignored news items")
        .otherwise(transition_error(entity, F.col("status"), target))
    )
    joined = joined.withColumn("transition_error", error)
    changed = target.isNotNull() & F.col("transition_error").isNull()
    return (
        joined.withColumn("status", F.when(changed, target).otherwise(F.col("status")))
        .withColumn("ignore_reason", F.when(changed, reason).otherwise(F.col("ignore_reason")))
        .drop("target_status", "request_reason", "_asked", "_requests")
    )


def persist_selection(items: DataFrame, scored: DataFrame, chosen: DataFrame, key: str = "news_item_id") -> DataFrame:
    """News statuses after a selection pass (J5). Only collected items change; scored items over the cap stay."""
    ignored = scored.where(F.col("ignore_reason").isNotNull()).select(key, F.col("ignore_reason").alias("_reason"))
    picked = chosen.select(key, F.lit(True).alias("_picked"))
    rows = items.join(ignored, key, "left").join(picked, key, "left")
    collected = F.col("status") == "collected"
    ignore = collected & F.col("_reason").isNotNull()
    return (
        rows.withColumn("ignore_reason", F.when(ignore, F.col("_reason")).otherwise(F.col("ignore_reason")))
        .withColumn("status", F.when(ignore, "ignored").when(collected & F.col("_picked"), "candidate")
                    .otherwise(F.col("status")))
        .drop("_reason", "_picked")
    )


MUTABLE_SOURCE_COLUMNS = ("name", "feed_url", "category", "language", "enabled", "priority")


def upsert_sources(current: DataFrame, config: DataFrame, now: Column | None = None) -> DataFrame:
    """Sources after a configuration sync (J1): adds ``change`` and ``sync_error``.

    New keys are inserted, settings of known keys follow the configuration, identity and history stay. A different
    allowed host is an error and changes nothing. Keys absent from the configuration stay as they are.
    """
    settings = config.select("source_key", F.col("allowed_host").alias("_host"), F.lit(True).alias("_configured"),
                             *[F.col(name).alias(f"_{name}") for name in MUTABLE_SOURCE_COLUMNS])
    stored = current.withColumn("_stored", F.lit(True))
    rows = stored.join(settings, "source_key", "full_outer")
    known, configured = F.col("_stored").isNotNull(), F.col("_configured").isNotNull()
    clash = known & configured & ~F.col("allowed_host").eqNullSafe(F.col("_host"))
    take = configured & ~clash
    columns = [
        F.when(take, F.col(f"_{name}")).otherwise(F.col(name)).alias(name) for name in MUTABLE_SOURCE_COLUMNS
    ]
    rest = [name for name in current.columns if name not in (*MUTABLE_SOURCE_COLUMNS, "source_key", "allowed_host")]
    stamps = {"created_at": ~known, "updated_at": take} if now is not None else {}
    rest = [F.when(stamps[name], now).otherwise(F.col(name)).alias(name) if name in stamps else F.col(name)
            for name in rest]
    return rows.select(
        "source_key", F.coalesce("allowed_host", "_host").alias("allowed_host"), *columns, *rest,
        F.when(~known, "inserted").when(clash, "rejected").when(configured, "updated").otherwise("kept")
        .alias("change"),
        F.when(clash, "Source URL or allowed hostname differs from the stored source identity.").alias("sync_error"),
    )


def terminal_immutability(before: DataFrame, after: DataFrame, key: str, identity: list[str], open_status: str,
                          values: list[str]) -> DataFrame:
    """Illegal rewrites between two versions of a table.

    Identity columns never change; a row whose status is no longer ``open_status`` may only be saved unchanged.
    """
    columns = [*identity, "status", *values]
    old = before.select(key, *[F.col(name).alias(f"_{name}") for name in columns])
    rows = after.select(key, *columns).join(old, key)

    def differs(names: list[str]) -> Column:
        return reduce(lambda left, right: left | right,
                      [~F.col(name).eqNullSafe(F.col(f"_{name}")) for name in names])

    problem = F.when(differs(identity), "identity").when(
        (F.col("_status") != open_status) & differs(["status", *values]), "terminal")
    return rows.select(key, F.col("_status").alias("stored_status"), "status", problem.alias("violation")).where(
        F.col("violation").isNotNull())
