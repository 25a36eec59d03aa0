"""Validation, scoring, routing and contacts for leads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weirgate import constants as C
from weirgate.functions.text import clean_text, first_name, last_name, mask_email, not_blank

#: Pragmatic address shape: no blanks, one ``@``, a dot in the domain.
EMAIL_SHAPE = r"\A[^\s@]+@[^\s@]+\.[^\s@]+\z"


def validate_lead(requests: DataFrame) -> DataFrame:
    """Outcome of the entry checks (B5, B6): adds ``outcome, error_code, http_code`` and a normalised ``message``.

    Input rules come before consent. Accepted rows have outcome ``accepted`` and no codes.
    """
    rows = requests.withColumn("message", clean_text("message")).withColumn("email", F.lower(F.trim("email")))
    complete = [not_blank(F.trim(name)) for name in ("name", "email", "message", "source", "idempotency_key")]
    usable = reduce(lambda left, right: left & right, complete) & F.col("consent_to_contact").isNotNull()
    usable = usable & F.coalesce(F.rlike("email", F.lit(EMAIL_SHAPE)), F.lit(False))
    usable = usable & (F.length("message") <= C.LEAD_MESSAGE_MAX)
    code = F.when(~usable, "INVALID_INPUT").when(~F.col("consent_to_contact"), "CONSENT_REQUIRED")
    return (
        rows.withColumn("error_code", code)
        .withColumn("outcome", F.when(code.isNull(), "accepted").otherwise("rejected"))
        .withColumn("http_code", F.when(F.col("error_code") == "INVALID_INPUT", 400)
                    .when(F.col("error_code") == "CONSENT_REQUIRED", 422))
    )


def gate_consent(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests with consent, and the others with their error (B6). The others must not be stored."""
    agreed = F.coalesce(F.col("consent_to_contact"), F.lit(False))
    refused = requests.where(~agreed).withColumn("error_code", F.lit("CONSENT_REQUIRED")).withColumn(
        "http_code", F.lit(422))
    return requests.where(agreed), refused


def lead_budget_category(budget: Column, model_value: Column) -> Column:
    """Category of an explicit budget above zero, else what the model said (B7); bounds belong to the upper class."""
    stated = (F.when(budget >= 20_000, "20k_plus").when(budget >= 10_000, "10k_20k")
              .when(budget >= 5_000, "5k_10k").otherwise("under_5k"))
    return F.when(budget > 0, stated).otherwise(F.coalesce(model_value, F.lit("unknown")))


def _points(name: str) -> Column:
    table = C.LEAD_POINTS[name]
    value = F.col(name)
    return F.coalesce(*[F.when(value == label, F.lit(points)) for label, points in table.items()], F.lit(0))


def lead_score(leads: DataFrame) -> DataFrame:
    """Add ``score_breakdown`` and ``score`` (B8), after setting ``budget_category`` by B7."""
    rows = leads.withColumn(
        "budget_category", lead_budget_category(F.col("estimated_budget"), F.col("budget_category")))
    useful = F.length(F.coalesce("message", F.lit(""))) >= C.LEAD_MESSAGE_USEFUL
    parts = {
        "budget": _points("budget_category"),
        "urgency": _points("urgency"),
        "decision_maker": _points("decision_maker_signal"),
        "service_fit": _points("requested_service"),
        "company": F.when(not_blank("company"), C.LEAD_COMPANY_POINTS).otherwise(0),
        "message": F.when(useful, C.LEAD_MESSAGE_POINTS).otherwise(0),
    }
    rows = rows.withColumn("score_breakdown", F.struct(*[part.alias(name) for name, part in parts.items()]))
    total = reduce(lambda left, right: left + right, [F.col(f"score_breakdown.{name}") for name in parts])
    return rows.withColumn("score", total)


def lead_tier(scored: DataFrame) -> DataFrame:
    """Add ``review_reasons`` and ``tier`` (B9). Any reason overrides the score.

    ``extraction_failed`` marks rows whose model response was missing or failed.
    """
    failed = F.coalesce("extraction_failed", F.lit(False))
    reasons = F.array_compact(F.array(
        F.when(failed, "ai_extraction_failed"),
        F.when(~failed & F.coalesce(F.col("confidence") < C.LEAD_MIN_CONFIDENCE, F.lit(True)), "low_confidence"),
        F.when(~failed & F.coalesce(F.col("requested_service") == "unclear", F.lit(True)), "unclear_service"),
        F.when(~failed & F.coalesce(F.col("urgency") == "unclear", F.lit(True)), "unclear_urgency"),
    ))
    rows = scored.withColumn("review_reasons", reasons)
    return rows.withColumn("tier", F.when(F.size("review_reasons") > 0, "needs_review")
                           .when(F.col("score") >= C.LEAD_HOT_FROM, "hot")
                           .when(F.col("score") >= C.LEAD_WARM_FROM, "warm").otherwise("cold"))


def lead_route(tiered: DataFrame) -> DataFrame:
    """Actions, status and answer code (B10). ``crm_failed`` marks a failed contact upsert, ``known`` a repeat.

    A repeat does nothing again; a failed upsert is kept and answered with 503.
    """
    tier = F.col("tier")
    known, crm_failed = F.coalesce("known", F.lit(False)), F.coalesce("crm_failed", F.lit(False))
    action = (
        F.when(known, "none").when(crm_failed, "technical_alert")
        .when(tier == "hot", "alert+draft").when(tier == "warm", "draft")
        .when(tier == "cold", "store").otherwise("review_alert")
    )
    status = (
        F.when(known, "duplicate").when(crm_failed, "failed")
        .when(tier == "needs_review", "needs_review").otherwise("completed")
    )
    return (
        tiered.withColumn("action", action).withColumn("status", status)
        .withColumn("http_code", F.when(known, 200).when(crm_failed, 503).otherwise(202))
        .withColumn("error_code", F.when(crm_failed & ~known, "CRM_UPSERT_FAILED"))
        .withColumn("crm_status", F.when(known, "skipped").when(crm_failed, "failed").otherwise("upserted"))
    )


def lead_audit_rows(routed: DataFrame) -> DataFrame:
    """The 19 audit columns (A10) for success and failure alike: masked address, no message; repeats are left out."""
    rows = routed.where(F.col("status") != "duplicate").withColumn("email_masked", mask_email("email"))
    rows = rows.withColumn("score_breakdown", F.to_json("score_breakdown"))
    return rows.select(*[F.col(name) for name in C.LEAD_AUDIT_COLUMNS])


def lead_model_input(requests: DataFrame) -> DataFrame:
    """What may leave for the model (B18): never the address or the phone."""
    return requests.select("request_id", "name", "company", "estimated_budget", "source", "message")


def lead_alert_view(routed: DataFrame) -> DataFrame:
    """What an alert may show."""
    return routed.select("request_id", "name", "company", "summary", "score", "tier",
                         F.array_join("review_reasons", ", ").alias("review_reasons"))


def follow_up_drafts(routed: DataFrame) -> DataFrame:
    """One prepared draft per hot or warm lead (K7). Drafts are rows for a human; nothing is sent."""
    rows = routed.where(F.col("tier").isin("hot", "warm") & (F.col("status") == "completed"))
    hot = F.col("tier") == "hot"
    service = F.replace(F.col("requested_service"), F.lit("_"), F.lit(" "))
    body = F.concat_ws(
        "\n",
        F.concat(F.lit("Hello "), first_name("name"), F.lit(",")), F.lit(""),
        F.concat(F.lit("thank you for your enquiry about "), service, F.lit(".")),
        F.when(hot, "We would like to schedule a call this week.").otherwise(
            "Could you tell us more about your timeline and goals?"),
        F.lit(""), F.lit("Kind regards"),
    )
    return rows.select("request_id", F.col("email").alias("recipient"),
                       F.concat(F.lit("Your enquiry: "), service).alias("subject"), body.alias("body"),
                       F.lit(False).alias("sent"))


def upsert_contacts(current: DataFrame, leads: DataFrame, at: str = "received_at") -> DataFrame:
    """Contacts after a set of leads (J2): one row per normalised address.

    ``current`` has ``contact_id, email, first_name, last_name, company, phone, created_at``. The record id and the
    create time are kept; the newest name wins; company and phone change only when a lead provides them. All picks
    are aggregates, so nothing is collected per address.
    """
    def newest(column: Column, filled: Column) -> Column:
        return F.max(F.when(filled, F.struct(F.col(at), F.col("request_id"), column.alias("value")))).getField("value")

    rows = leads.withColumn("email", F.lower(F.trim("email")))
    newcomers = rows.groupBy("email").agg(
        newest(first_name("name"), F.lit(True)).alias("n_first"),
        newest(last_name("name"), F.lit(True)).alias("n_last"),
        newest(F.col("company"), not_blank("company")).alias("n_company"),
        newest(F.col("phone"), not_blank("phone")).alias("n_phone"),
        F.min(at).alias("n_created"),
    )
    merged = current.join(newcomers, "email", "full_outer")
    return merged.select(
        F.coalesce("contact_id", F.sha2("email", 256)).alias("contact_id"), "email",
        F.coalesce("n_first", "first_name").alias("first_name"),
        F.coalesce("n_last", "last_name").alias("last_name"),
        F.coalesce("n_company", "company").alias("company"), F.coalesce("n_phone", "phone").alias("phone"),
        F.coalesce("created_at", "n_created").alias("created_at"),
        F.when(F.col("contact_id").isNull(), "created").when(F.col("n_created").isNull(), "kept")
        .otherwise("updated").alias("change"),
    )


def score_extraction(expected: DataFrame, actual: DataFrame, key: str = "fixture",
                     fields: tuple[str, ...] = tuple(C.LEAD_ENUMS)) -> DataFrame:
    """Share of matching values per field."""
    left = expected.select(key, *[F.col(name).alias(f"e_{name}") for name in fields])
    right = actual.select(key, *[F.col(name).alias(f"a_{name}") for name in fields])
    matches = F.array(*[
        F.struct(F.lit(name).alias("field"),
                 F.col(f"e_{name}").eqNullSafe(F.col(f"a_{name}")).cast("bigint").alias("hit"))
        for name in fields
    ])
    pairs = left.join(right, key).select(F.inline(matches))
    return pairs.groupBy("field").agg(
        F.count(F.lit(1)).alias("cases"), F.sum("hit").alias("matches")
    ).withColumn("accuracy", F.col("matches").cast("double") / F.col("cases").cast("double"))
