"""Lead queries: checks, scores, tiers, routing, contacts, drafts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirgate.functions import text
from weirgate.operators import intake, lead, runs
from weirgate.plans import sql, tables as t
from weirgate.plans.registry import Query
from weirgate.sources.leads import with_idempotency_key

QUERIES: dict[str, Query] = {}


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return with_idempotency_key(t.lead_requests(spark, folder))


def lead_validate(spark: SparkSession, folder: str) -> DataFrame:
    rows = lead.validate_lead(_requests(spark, folder))
    return rows.select("request_id", "email", "outcome", "error_code", "http_code", F.length("message").alias("length"))


QUERIES["lead_validate"] = Query(lead_validate, sql.query(
    "SELECT request_id, email, outcome, error_code, http_code, length(message) AS length FROM lead_checked",
    "lead_request", "lead_checked"))


def lead_consent(spark: SparkSession, folder: str) -> DataFrame:
    """Requests kept and refused by the consent gate; refused ones leave only their number."""
    kept, refused = lead.gate_consent(_requests(spark, folder))
    return kept.select("source", F.lit("kept").alias("gate"), F.lit(202).alias("http_code")).unionByName(
        refused.select("source", F.lit("refused").alias("gate"), "http_code")).groupBy(
        "source", "gate", "http_code").agg(F.count(F.lit(1)).alias("requests"))


QUERIES["lead_consent"] = Query(lead_consent, sql.query("""
SELECT source, CASE WHEN coalesce(consent_to_contact, false) THEN 'kept' ELSE 'refused' END AS gate,
       CASE WHEN coalesce(consent_to_contact, false) THEN 202 ELSE 422 END AS http_code, count(*) AS requests
FROM lead_request GROUP BY 1, 2, 3""", "lead_request"))


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    return lead.lead_route(lead.lead_tier(lead.lead_score(t.leads(spark, folder))))


def lead_score(spark: SparkSession, folder: str) -> DataFrame:
    rows = lead.lead_score(t.leads(spark, folder))
    return rows.select("request_id", "budget_category", "score", *[
        F.col(f"score_breakdown.{part}").alias(f"p_{part}")
        for part in ("budget", "urgency", "decision_maker", "service_fit", "company", "message")])


QUERIES["lead_score"] = Query(lead_score, sql.query(
    "SELECT request_id, budget_category, score, p_budget, p_urgency, p_decision AS p_decision_maker, "
    "p_service AS p_service_fit, p_company, p_message FROM lead_routed", "lead_request", "lead_signal", "lead_routed"))


def lead_tier_routing(spark: SparkSession, folder: str) -> DataFrame:
    return _routed(spark, folder).select(
        "request_id", "tier", "action", "status", "http_code", "error_code", text.mask_email("email").alias("masked"),
        F.array_join("review_reasons", "; ").alias("reasons"))


QUERIES["lead_tier_routing"] = Query(lead_tier_routing, sql.query(r"""
SELECT request_id, tier, action, status, http_code, error_code,
       regexp_replace(raw_email, '\A(.{0,2})[^@]*@', '\1***@') AS masked, array_to_string(review_reasons, '; ') AS reasons
FROM lead_routed""", "lead_request", "lead_signal", "lead_routed"))


def lead_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The 19 audit columns; the breakdown stays parsed text."""
    rows = _routed(spark, folder).withColumns({
        "hubspot_contact_id": F.when(~F.col("crm_failed"), F.sha2(F.lower("email"), 256)),
        "error_message": F.when(F.col("error_code").isNotNull(), "Contact upsert failed."),
        "received_at": F.unix_micros("received_at"),
    })
    return lead.lead_audit_rows(with_idempotency_key(rows))


QUERIES["lead_audit"] = Query(lead_audit, sql.query(r"""
SELECT received_us AS received_at, request_id, idempotency_key,
       regexp_replace(raw_email, '\A(.{0,2})[^@]*@', '\1***@') AS email_masked, company, source, intent,
       requested_service, urgency, budget_category, score, tier,
       '{"budget":' || p_budget || ',"urgency":' || p_urgency || ',"decision_maker":' || p_decision
         || ',"service_fit":' || p_service || ',"company":' || p_company || ',"message":' || p_message || '}'
         AS score_breakdown, crm_status,
       CASE WHEN NOT crm_failed THEN sha256(lower(raw_email)) END AS hubspot_contact_id, action, status, error_code,
       CASE WHEN error_code IS NOT NULL THEN 'Contact upsert failed.' END AS error_message
FROM lead_routed WHERE status <> 'duplicate'""", "lead_request", "lead_signal", "lead_routed"))


def lead_idempotency(spark: SparkSession, folder: str) -> DataFrame:
    """New requests against an audit that holds every fifth key."""
    rows = _requests(spark, folder)
    audit = rows.where(F.col("c_custkey") % 5 == 0).select("idempotency_key")
    return intake.mark_known_keys(rows, audit).select("request_id", "idempotency_key", "known")


QUERIES["lead_idempotency"] = Query(lead_idempotency, sql.query("""
SELECT request_id, idempotency_key, c_custkey % 5 = 0 AND idempotency_key IS NOT NULL AS known FROM lead_request""",
    "lead_request"))


def lead_split(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides of the split as one table: the requests are built once."""
    rows = _requests(spark, folder)
    audit = rows.where(F.col("c_custkey") % 5 == 0).select("idempotency_key")
    return intake.tag_by_idempotency(rows.select("request_id", "idempotency_key"), audit).select("request_id", "outcome")


QUERIES["lead_split"] = Query(lead_split, sql.query("""
SELECT request_id, CASE WHEN c_custkey % 5 = 0 AND idempotency_key IS NOT NULL THEN 'duplicate' ELSE 'new' END
  AS outcome FROM lead_request""", "lead_request"))


def lead_model_input(spark: SparkSession, folder: str) -> DataFrame:
    """What leaves for the model, with the split name beside it."""
    sent = lead.lead_model_input(t.lead_requests(spark, folder))
    return sent.select("request_id", text.first_name("name").alias("first_name"),
                       text.last_name("name").alias("last_name"), "company", "estimated_budget", "source",
                       F.sha2("message", 256).alias("message_hash"))


QUERIES["lead_model_input"] = Query(lead_model_input, sql.query("""
SELECT request_id, split_part(name, ' ', 1) AS first_name, substr(name, strpos(name, ' ') + 1) AS last_name, company,
       estimated_budget, source, sha256(raw_message) AS message_hash FROM lead_request""", "lead_request"))


def lead_alerts(spark: SparkSession, folder: str) -> DataFrame:
    rows = _routed(spark, folder).where(F.col("action").isin("alert+draft", "review_alert")).withColumn(
        "summary", F.col("message"))
    return lead.lead_alert_view(rows)


QUERIES["lead_alerts"] = Query(lead_alerts, sql.query("""
SELECT request_id, name, company, raw_message AS summary, score, tier,
       array_to_string(review_reasons, ', ') AS review_reasons
FROM lead_routed WHERE action IN ('alert+draft', 'review_alert')""", "lead_request", "lead_signal", "lead_routed"))


def lead_drafts(spark: SparkSession, folder: str) -> DataFrame:
    return lead.follow_up_drafts(_routed(spark, folder))


QUERIES["lead_drafts"] = Query(lead_drafts, sql.query("""
SELECT request_id, raw_email AS recipient, 'Your enquiry: ' || replace(requested_service, '_', ' ') AS subject,
       'Hello ' || split_part(name, ' ', 1) || ',' || chr(10) || chr(10) || 'thank you for your enquiry about '
         || replace(requested_service, '_', ' ') || '.' || chr(10)
         || CASE WHEN tier = 'hot' THEN 'We would like to schedule a call this week.'
                 ELSE 'Could you tell us more about your timeline and goals?' END
         || chr(10) || chr(10) || 'Kind regards' AS body, false AS sent
FROM lead_routed WHERE tier IN ('hot', 'warm') AND status = 'completed'""",
    "lead_request", "lead_signal", "lead_routed"))


def contact_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Stored contacts (every sixth request's) after the others and some of their own."""
    requests = t.lead_requests(spark, folder).withColumn("email", F.lower(F.trim("email")))
    stored = requests.where(F.col("c_custkey") % 6 == 0).select(
        F.concat(F.lit("c-"), F.col("c_custkey").cast("string")).alias("contact_id"), "email",
        F.lit("Old").alias("first_name"), F.lit("Name").alias("last_name"), F.lit("Old Company").alias("company"),
        F.lit("000").alias("phone"), F.timestamp_micros(F.lit(0)).alias("created_at"))
    incoming = requests.where((F.col("c_custkey") % 4 != 2) | (F.col("c_custkey") % 6 != 0))
    after = lead.upsert_contacts(stored, incoming)
    return after.withColumn("created_at", F.unix_micros("created_at"))


QUERIES["contact_upsert"] = Query(contact_upsert, sql.query("""
SELECT coalesce(contact_id, sha256(email)) AS contact_id, email,
       CASE WHEN n_name IS NOT NULL THEN split_part(n_name, ' ', 1) ELSE 'Old' END AS first_name,
       CASE WHEN n_name IS NOT NULL THEN substr(n_name, strpos(n_name, ' ') + 1) ELSE 'Name' END AS last_name,
       coalesce(n_company, CASE WHEN contact_id IS NOT NULL THEN 'Old Company' END) AS company,
       coalesce(n_phone, CASE WHEN contact_id IS NOT NULL THEN '000' END) AS phone,
       CASE WHEN contact_id IS NOT NULL THEN 0 ELSE n_created END AS created_at,
       CASE WHEN contact_id IS NULL THEN 'created' WHEN n_created IS NULL THEN 'kept' ELSE 'updated' END AS change
FROM (SELECT 'c-' || c_custkey AS contact_id, lower(trim(raw_email)) AS email FROM lead_request WHERE c_custkey % 6 = 0)
FULL OUTER JOIN (
  SELECT lower(trim(raw_email)) AS email, arg_max(name, received_us) AS n_name,
         arg_max(company, received_us) FILTER (WHERE coalesce(company, '') <> '') AS n_company,
         arg_max(phone, received_us) FILTER (WHERE coalesce(phone, '') <> '') AS n_phone, min(received_us) AS n_created
  FROM lead_request WHERE c_custkey % 4 <> 2 OR c_custkey % 6 <> 0 GROUP BY 1) USING (email)""", "lead_request"))


def extraction_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Signals against a second opinion that differs for some customers."""
    actual = t.lead_signals(spark, folder).withColumnRenamed("c_custkey", "fixture")
    key = F.col("fixture")
    expected = actual.withColumn("intent", F.when(key % 7 == 0, "support").otherwise(F.col("intent"))).withColumn(
        "urgency", F.when(key % 3 == 0, "exploring").otherwise(F.col("urgency")))
    return lead.score_extraction(expected, actual)


QUERIES["extraction_accuracy"] = Query(extraction_accuracy, sql.query("""
SELECT field, count(*) AS cases, CAST(sum(CAST(hit AS INTEGER)) AS BIGINT) AS matches,
       CAST(sum(CAST(hit AS INTEGER)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS accuracy
FROM (SELECT 'intent' AS field, c_custkey % 7 <> 0 OR intent = 'support' AS hit FROM lead_signal
      UNION ALL SELECT 'urgency', c_custkey % 3 <> 0 OR urgency = 'exploring' FROM lead_signal
      UNION ALL SELECT unnest(['requested_service', 'budget_category', 'decision_maker_signal']), true FROM lead_signal)
GROUP BY 1""", "lead_signal"))


def ops_metrics(spark: SparkSession, folder: str) -> DataFrame:
    audit = _routed(spark, folder).withColumn("model_tokens", F.length("message").cast("bigint"))
    return runs.operational_metrics(audit, t.now())


QUERIES["ops_metrics"] = Query(ops_metrics, sql.query(f"""
SELECT count(*) AS requests, count(error_code) AS errors,
       count(*) FILTER (WHERE error_code = 'CRM_UPSERT_FAILED') AS crm_failures,
       count(*) FILTER (WHERE status = 'needs_review') AS needs_review,
       count(*) FILTER (WHERE status = 'duplicate') AS duplicates,
       CAST(count(*) FILTER (WHERE status = 'duplicate') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS duplicate_ratio,
       ({t.NOW_MICROS} - min(received_us) FILTER (WHERE status = 'failed')) // 1000000 AS oldest_open_failure_seconds,
       CAST(sum(length(raw_message)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS tokens_per_request
FROM lead_routed""", "lead_request", "lead_signal", "lead_routed"))


def lead_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return runs.status_breakdown(_routed(spark, folder), status="tier")


QUERIES["lead_breakdown"] = Query(lead_breakdown, sql.query("""
SELECT tier AS status, reason, count(*) AS rows FROM (
  SELECT tier, unnest(CASE WHEN len(review_reasons) = 0 THEN ['none'] ELSE review_reasons END) AS reason FROM lead_routed)
GROUP BY 1, 2""", "lead_request", "lead_signal", "lead_routed"))


def contract_check(spark: SparkSession, folder: str) -> DataFrame:
    """Contract errors of the requests; one key is used twice and some give their class away."""
    from weirgate.operators.quality import check_contract
    key = F.col("c_custkey")
    rows = _requests(spark, folder).withColumn("idempotency_key", F.when(
        key % 100 == 7, F.concat(F.lit("key-"), (key + 1).cast("string"))).when(
        key % 100 == 9, F.concat(F.lit("HOT-"), F.col("idempotency_key"))).otherwise(F.col("idempotency_key")))
    checked = check_contract(rows, "idempotency_key", ("company", "phone", "idempotency_key"))
    return checked.select("request_id", "idempotency_key", F.array_join("contract_errors", "; ").alias("errors"))


QUERIES["contract_check"] = Query(contract_check, sql.query("""
, keyed AS (SELECT request_id, company, phone, CASE WHEN c_custkey % 100 = 7 THEN 'key-' || (c_custkey + 1)
              WHEN c_custkey % 100 = 9 THEN 'HOT-' || idempotency_key ELSE idempotency_key END AS key FROM lead_request)
SELECT request_id, key AS idempotency_key, array_to_string(list_filter([
         CASE WHEN company IS NULL THEN 'missing:company' END, CASE WHEN phone IS NULL THEN 'missing:phone' END,
         CASE WHEN key IS NULL THEN 'missing:idempotency_key' END, CASE WHEN n > 1 THEN 'repeated_key' END,
         CASE WHEN contains(lower(key), 'hot') THEN 'leaks:hot' END], lambda e: e IS NOT NULL), '; ') AS errors
FROM keyed LEFT JOIN (SELECT key, count(*) AS n FROM keyed WHERE key IS NOT NULL GROUP BY 1) USING (key)""",
    "lead_request"))
