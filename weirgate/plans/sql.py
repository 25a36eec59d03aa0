"""SQL forms of the derived inputs, as named common table expressions for the checking engine."""

from __future__ import annotations

from weirgate.plans.tables import MINUTE, NOW_MICROS, PROFILE

SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"


def pick(number: str, *values: str | None) -> str:
    cases = " ".join(
        f"WHEN {index} THEN " + ("NULL" if value is None else f"'{value}'") for index, value in enumerate(values))
    return f"CASE ({number}) % {len(values)} {cases} END"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '\A{SPACE}+|{SPACE}+\z', '', 'g')"


def collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACE}+', ' ', 'g'), ' ')"


def escape3(text: str) -> str:
    return f"replace(replace(replace(coalesce({text}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def escape5(text: str) -> str:
    return f"replace(replace({escape3(text)}, '\"', '&quot;'), '''', '&#x27;')"


def number_text(value: str) -> str:
    return f"regexp_replace(CAST({value} AS VARCHAR), '\\.0$', '')"


def clean(text: str) -> str:
    lead = (r"(?m)^[ \t\x{00A0}\x{1680}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}\x{FEFF}\x{200B}-\x{200D}\x{2060}]+")
    return strip(rf"regexp_replace(regexp_replace(coalesce({text}, ''), '\r\n?', chr(10), 'g'), '{lead}', '', 'g')")


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def keyword_hits(text: str, keywords: tuple[str, ...]) -> str:
    return " + ".join(f"CAST(contains({text}, {quote(word)}) AS INTEGER)" for word in keywords)


HAYSTACK = f"lower({strip('title')}) || ' ' || lower({strip('sanitized_summary')})"
EXCLUDED = " OR ".join(f"contains(haystack, {quote(word)})" for word in PROFILE.exclude_keywords)

CTES: dict[str, str] = {}

CTES["feed_source"] = f"""
  SELECT source AS source_key, 'Source ' || num AS name, source || '.example.com' AS allowed_host,
         {pick('num', 'artificial_intelligence', 'software_development')} AS category,
         (num % 7 <> 3) AS enabled, CAST(num % 11 AS DECIMAL(4,2)) AS priority, num AS number
  FROM (SELECT DISTINCT source, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS num FROM documents)"""

CTES["news_item"] = f"""
  SELECT md5('news-' || doc_id) AS news_item_id, doc_id, source AS source_key, split_part(text, chr(10), 1) AS title,
         text AS sanitized_summary,
         CASE WHEN doc_id % 11 <> 0 THEN {NOW_MICROS} - (doc_id * 37 % 10080) * {MINUTE} END AS published_us,
         {NOW_MICROS} - (doc_id * 13 % 5000) * {MINUTE} AS collected_us,
         CASE doc_id % 10 WHEN 0 THEN 'used' WHEN 1 THEN 'ignored' WHEN 2 THEN 'candidate' ELSE 'collected' END
           AS status,
         CASE WHEN doc_id % 10 = 1 THEN 'irrelevant' END AS ignore_reason
  FROM documents"""

CTES["scored"] = f"""
  SELECT *, CASE WHEN reason IS NULL THEN
      (CAST(0.45 AS DOUBLE) * least(CAST(1.0 AS DOUBLE), CAST(hits AS DOUBLE) / CAST({len(PROFILE.include_keywords)} AS DOUBLE))
       + CAST(0.30 AS DOUBLE) * fresh) + CAST(0.25 AS DOUBLE) * (CAST(priority AS DOUBLE) / CAST(10 AS DOUBLE)) END
      AS score
  FROM (SELECT *, {keyword_hits('haystack', PROFILE.include_keywords)} AS hits,
          CASE WHEN age < 0 THEN CAST(1.0 AS DOUBLE) WHEN age >= 259200000000 THEN CAST(0.0 AS DOUBLE)
               ELSE CAST(1.0 AS DOUBLE) - CAST(age AS DOUBLE) / CAST(259200000000 AS DOUBLE) END AS fresh,
          CASE WHEN priority IS NULL THEN 'irrelevant' WHEN status IN ('used', 'ignored') THEN 'irrelevant'
               WHEN age > 259200000000 THEN 'too_old'
               WHEN length({strip('title')}) < {PROFILE.min_title_length} THEN 'missing_title'
               WHEN length({strip('sanitized_summary')}) < {PROFILE.min_summary_length} THEN 'missing_content'
               WHEN {EXCLUDED} THEN 'irrelevant' END AS reason
        FROM (SELECT n.*, s.priority, {NOW_MICROS} - coalesce(published_us, collected_us) AS age,
                     {HAYSTACK} AS haystack
              FROM news_item n LEFT JOIN (SELECT * FROM feed_source WHERE enabled) s USING (source_key)))"""

CTES["chosen"] = """
  SELECT news_item_id, source_key, title, score, source_rank
  FROM (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY score DESC, news_item_id) AS source_rank
        FROM scored WHERE score IS NOT NULL)
  WHERE source_rank <= 3 ORDER BY score DESC, news_item_id LIMIT 25"""

CTES["keyed_news"] = """
  SELECT doc_id, md5('news-' || doc_id) AS news_item_id, source AS source_key, sha256(text) AS url_hash,
         CASE WHEN doc_id % 4 <> 0 THEN CAST(doc_id // 60 AS VARCHAR) END AS external_id
  FROM documents"""

CTES["fetch_log"] = """
  SELECT event_id AS fetch_id, 's' || user_id AS source_key, ts AS finished_at,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'not_modified' ELSE 'success' END AS fetch_status,
         CASE WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 'tag-' || event_id END AS etag
  FROM events"""

CTES["status_event"] = """
  SELECT user_id AS entity_id, event_id, ts AS changed_at,
         CASE event_type WHEN 'signup' THEN 'generated' WHEN 'view' THEN 'sending' WHEN 'click' THEN 'sending'
              WHEN 'purchase' THEN 'sent' ELSE 'failed' END AS status
  FROM events"""

CTES["attempt"] = """
  SELECT user_id AS digest_id, event_id % 3 + 1 AS part_number, event_id + 1 AS attempt_number, event_id % 4 AS trial,
         CASE event_type WHEN 'purchase' THEN 'sent' WHEN 'signup' THEN 'pending' ELSE 'failed' END AS status,
         CASE WHEN event_type = 'purchase' THEN event_id + 1 END AS message_id,
         CASE event_type WHEN 'purchase' THEN 200 WHEN 'click' THEN 429 WHEN 'view' THEN 400 END AS http_status,
         CASE WHEN event_type = 'click' AND value > 20 THEN CAST(floor(value) AS INTEGER) END AS retry_after_seconds,
         CASE event_type WHEN 'error' THEN 'TELEGRAM_TIMEOUT' WHEN 'click' THEN 'TELEGRAM_RATE_LIMITED'
              WHEN 'view' THEN 'TELEGRAM_PERMANENT_FAILURE' END AS error_code,
         CASE WHEN event_type IN ('error', 'click', 'view') AND event_id % 2 = 0 THEN 'Request failed.' END
           AS error_summary,
         epoch_us(ts) AS started_us,
         CASE WHEN event_type <> 'signup' THEN epoch_us(ts) + CAST(floor(value * 1000) AS BIGINT) - 5000 END
           AS finished_us
  FROM events"""

CTES["extraction"] = f"""
  SELECT o_orderkey AS order_key,
         CASE WHEN o_orderkey % 23 = 0 THEN 'not_invoice' ELSE 'invoice' END AS document_type,
         CASE WHEN o_orderkey % 29 = 0 THEN '' WHEN o_orderkey % 11 <> 0 THEN 'INV-' || o_orderkey END
           AS invoice_number,
         c_name AS vendor_name,
         CASE WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, '%Y-%m-%d')
           END AS invoice_date,
         strftime(CAST(o_orderdate AS DATE) + 14, '%Y-%m-%d') AS due_date,
         {pick('c_nationkey', 'EUR', 'USD', 'GBP', 'usd', None)} AS currency,
         CAST(net AS DOUBLE) AS subtotal, CAST(tax AS DOUBLE) AS tax_amount,
         CAST(net + tax + CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE 0 END AS DOUBLE) AS total_amount,
         CAST(CASE o_orderkey % 5 WHEN 0 THEN 0.99 WHEN 1 THEN 0.9 WHEN 2 THEN 0.85 WHEN 3 THEN 0.8 ELSE 1.0 END
           AS DOUBLE) AS confidence,
         CASE WHEN o_orderkey % 31 = 0 THEN ['due_date', 'invoice_number'] ELSE CAST([] AS VARCHAR[]) END
           AS missing_fields
  FROM orders
  JOIN (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS net,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS tax
        FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
  LEFT JOIN customer ON c_custkey = o_custkey"""

_BAD = "{f} IS NOT NULL AND NOT regexp_full_match({f}, '{p}')"
_REPORTED = ("list_filter(missing_fields, lambda f: NOT (f = 'invoice_number' AND coalesce(invoice_number, '') = '') "
             "AND NOT (f = 'due_date' AND coalesce(due_date, '') = ''))")
CTES["reviewed"] = f"""
  SELECT *, CASE WHEN len(reasons) = 0 THEN 'processed' ELSE 'needs_review' END AS status
  FROM (SELECT *, list_filter([
      CASE WHEN coalesce(invoice_number, '') = '' THEN 'missing:invoice_number' END,
      CASE WHEN coalesce(vendor_name, '') = '' THEN 'missing:vendor_name' END,
      CASE WHEN coalesce(invoice_date, '') = '' THEN 'missing:invoice_date' END,
      CASE WHEN coalesce(due_date, '') = '' THEN 'missing:due_date' END,
      CASE WHEN coalesce(currency, '') = '' THEN 'missing:currency' END,
      CASE WHEN subtotal IS NULL THEN 'missing:subtotal' END,
      CASE WHEN tax_amount IS NULL THEN 'missing:tax_amount' END,
      CASE WHEN total_amount IS NULL THEN 'missing:total_amount' END]
      || list_transform({_REPORTED}, lambda f: 'missing:' || f)
      || [CASE WHEN document_type <> 'invoice' THEN 'document_type:' || document_type END,
      CASE WHEN confidence < 0.85::DOUBLE THEN 'low_confidence:' || {number_text('confidence')} END,
      CASE WHEN {_BAD.format(f='invoice_date', p='[0-9]{4}-[0-9]{2}-[0-9]{2}')} THEN 'invalid_date:invoice_date' END,
      CASE WHEN {_BAD.format(f='due_date', p='[0-9]{4}-[0-9]{2}-[0-9]{2}')} THEN 'invalid_date:due_date' END,
      CASE WHEN {_BAD.format(f='currency', p='[A-Z]{3}')} THEN 'invalid_currency' END,
      CASE WHEN subtotal < 0 THEN 'invalid_amount:subtotal' END,
      CASE WHEN tax_amount < 0 THEN 'invalid_amount:tax_amount' END,
      CASE WHEN total_amount < 0 THEN 'invalid_amount:total_amount' END,
      CASE WHEN abs(subtotal + tax_amount - total_amount) > 0.02::DOUBLE
           THEN 'totals_mismatch:' || printf('%.2f', abs(subtotal + tax_amount - total_amount)) END],
      lambda r: r IS NOT NULL) AS reasons
    FROM extraction)"""

CTES["file"] = f"""
  SELECT doc_id, source AS message_id,
         'Doc_' || doc_id || CASE WHEN doc_id % 5 = 0 THEN '.txt' WHEN doc_id % 3 = 0 THEN '.PDF' ELSE '.pdf' END
           AS file_name,
         {pick('doc_id', 'application/pdf', 'APPLICATION/X-PDF', '', 'text/plain', None)} AS mime_type,
         CASE WHEN doc_id % 17 <> 0 THEN encode(CASE WHEN doc_id % 19 = 0 THEN '' WHEN doc_id % 7 = 0 THEN text
              ELSE '%PDF-1.7 ' || text END) END AS content,
         CASE WHEN doc_id % 34 = 0 THEN 'Upload was interrupted.' END AS upstream
  FROM documents"""

CTES["gated"] = """
  SELECT *, coalesce(upper_reason IS NULL, false) AS valid FROM (
    SELECT *, CASE
      WHEN content IS NULL THEN coalesce(upstream, 'No binary PDF data found.')
      WHEN octet_length(content) = 0 THEN 'The uploaded file is empty.'
      WHEN octet_length(content) > 20000 THEN 'File is too large (' || octet_length(content)
           || ' bytes). Maximum is 20000 bytes.'
      WHEN NOT lower(file_name) LIKE '%.pdf' THEN 'Unsupported file extension in "' || file_name
           || '". Only PDF is accepted.'
      WHEN lower(coalesce(mime_type, '')) NOT IN ('application/pdf', 'application/x-pdf', 'application/octet-stream', '')
           THEN 'Unsupported file type: ' || lower(mime_type) || '. Only PDF is accepted.'
      WHEN NOT starts_with(text_head, '%PDF-') THEN 'The uploaded file does not contain a valid PDF signature.'
      END AS upper_reason
    FROM (SELECT *, CASE WHEN content IS NOT NULL AND octet_length(content) > 0 THEN substr(decode(content), 1, 5)
                    ELSE '' END AS text_head FROM file))"""

CTES["lead_request"] = f"""
  SELECT c_custkey, 'req-' || c_custkey AS request_id, replace(c_name, '#', ' ') AS name,
         (CASE WHEN c_custkey % 6 = 0 THEN '  User' ELSE 'user' END) || (c_custkey // 2)
           || (CASE WHEN c_custkey % 13 = 0 THEN '.mail' ELSE '@mail' END) || '.example.com' AS raw_email,
         CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 9 <> 0 THEN 'Company ' || c_nationkey END AS company,
         CASE WHEN c_custkey % 3 = 0 THEN '+1 202 555 ' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END
           AS phone,
         coalesce(text, 'Please call.') AS raw_message, c_acctbal * (c_custkey % 4) AS estimated_budget,
         CASE WHEN c_custkey % 41 = 0 THEN '' WHEN c_custkey % 2 = 0 THEN 'website' ELSE 'partner' END AS source,
         CASE WHEN c_custkey % 37 <> 0 THEN c_custkey % 9 <> 4 END AS consent_to_contact,
         coalesce(CASE WHEN c_custkey % 17 <> 0 THEN 'key-' || c_custkey END,
                  CASE WHEN c_custkey % 34 <> 0 THEN 'body-' || c_custkey END) AS idempotency_key,
         {NOW_MICROS} - c_custkey * {MINUTE} AS received_us
  FROM customer LEFT JOIN documents ON doc_id = c_custkey"""

CTES["lead_checked"] = rf"""
  SELECT *, CASE WHEN error_code IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome,
         CASE error_code WHEN 'INVALID_INPUT' THEN 400 WHEN 'CONSENT_REQUIRED' THEN 422 END AS http_code
  FROM (SELECT *, CASE
      WHEN coalesce(trim(name), '') = '' OR coalesce(email, '') = '' OR message = '' OR coalesce(trim(source), '') = ''
           OR coalesce(idempotency_key, '') = '' OR consent_to_contact IS NULL
           OR NOT regexp_full_match(email, '[^\s@]+@[^\s@]+\.[^\s@]+') OR length(message) > 4000
      THEN 'INVALID_INPUT' WHEN NOT consent_to_contact THEN 'CONSENT_REQUIRED' END AS error_code
    FROM (SELECT *, lower(trim(raw_email)) AS email, {clean('raw_message')} AS message FROM lead_request))"""

CTES["lead_signal"] = f"""
  SELECT c_custkey, {pick('c_custkey', 'new_project', 'consultation', 'partnership', 'support', 'other')} AS intent,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'workflow_automation' WHEN 'AUTOMOBILE' THEN 'ai_integration'
              WHEN 'MACHINERY' THEN 'crm_integration' WHEN 'HOUSEHOLD' THEN 'other'
              ELSE CASE WHEN c_custkey % 2 = 0 THEN 'data_pipeline' ELSE 'unclear' END END AS requested_service,
         CASE priority WHEN '1-URGENT' THEN 'immediate' WHEN '2-HIGH' THEN 'within_month'
              WHEN '3-MEDIUM' THEN 'this_quarter' WHEN '4-NOT SPECIFIED' THEN 'exploring' ELSE 'unclear' END AS urgency,
         {pick('c_nationkey', 'under_5k', '5k_10k', '10k_20k', '20k_plus', 'unknown')} AS model_budget,
         {pick('c_nationkey', 'strong', 'medium', 'weak', 'unknown')} AS decision_maker_signal,
         CAST(c_custkey * 7 % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS confidence,
         (c_custkey % 19 = 0) AS extraction_failed
  FROM customer LEFT JOIN (
    SELECT o_custkey, o_orderpriority AS priority FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn = 1) ON o_custkey = c_custkey"""

CTES["lead_routed"] = """
  SELECT *,
    CASE WHEN known THEN 'none' WHEN crm_failed THEN 'technical_alert' WHEN tier = 'hot' THEN 'alert+draft'
         WHEN tier = 'warm' THEN 'draft' WHEN tier = 'cold' THEN 'store' ELSE 'review_alert' END AS action,
    CASE WHEN known THEN 'duplicate' WHEN crm_failed THEN 'failed' WHEN tier = 'needs_review' THEN 'needs_review'
         ELSE 'completed' END AS status,
    CASE WHEN known THEN 200 WHEN crm_failed THEN 503 ELSE 202 END AS http_code,
    CASE WHEN crm_failed AND NOT known THEN 'CRM_UPSERT_FAILED' END AS error_code,
    CASE WHEN known THEN 'skipped' WHEN crm_failed THEN 'failed' ELSE 'upserted' END AS crm_status
  FROM (SELECT *, CASE WHEN len(review_reasons) > 0 THEN 'needs_review' WHEN score >= 75 THEN 'hot'
                  WHEN score >= 45 THEN 'warm' ELSE 'cold' END AS tier
    FROM (SELECT *, p_budget + p_urgency + p_decision + p_service + p_company + p_message AS score,
        list_filter([CASE WHEN extraction_failed THEN 'ai_extraction_failed' END,
          CASE WHEN NOT extraction_failed AND confidence < 0.65::DOUBLE THEN 'low_confidence' END,
          CASE WHEN NOT extraction_failed AND requested_service = 'unclear' THEN 'unclear_service' END,
          CASE WHEN NOT extraction_failed AND urgency = 'unclear' THEN 'unclear_urgency' END],
          lambda r: r IS NOT NULL) AS review_reasons
      FROM (SELECT *,
          CASE budget_category WHEN '20k_plus' THEN 30 WHEN '10k_20k' THEN 24 WHEN '5k_10k' THEN 16
               WHEN 'under_5k' THEN 6 ELSE 0 END AS p_budget,
          CASE urgency WHEN 'immediate' THEN 25 WHEN 'within_month' THEN 20 WHEN 'this_quarter' THEN 10
               WHEN 'exploring' THEN 2 ELSE 0 END AS p_urgency,
          CASE decision_maker_signal WHEN 'strong' THEN 20 WHEN 'medium' THEN 10 WHEN 'weak' THEN 3 ELSE 0 END
            AS p_decision,
          CASE WHEN requested_service IN ('workflow_automation', 'ai_integration', 'crm_integration', 'data_pipeline')
               THEN 15 ELSE 0 END AS p_service,
          CASE WHEN coalesce(company, '') <> '' THEN 5 ELSE 0 END AS p_company,
          CASE WHEN length(coalesce(raw_message, '')) >= 80 THEN 5 ELSE 0 END AS p_message
        FROM (SELECT *, (c_custkey % 5 = 0) AS known, (c_custkey % 27 = 1) AS crm_failed,
                CASE WHEN estimated_budget > 0 THEN CASE WHEN estimated_budget >= 20000 THEN '20k_plus'
                     WHEN estimated_budget >= 10000 THEN '10k_20k' WHEN estimated_budget >= 5000 THEN '5k_10k'
                     ELSE 'under_5k' END ELSE model_budget END AS budget_category
              FROM lead_request JOIN lead_signal USING (c_custkey)))))"""

CTES["run"] = f"""
  SELECT o_orderkey AS run_id, status, {pick('o_orderkey', 'scheduled', 'manual', 'dry_run', 'cron')} AS trigger_type,
         epoch_us(o_orderdate) AS started_us,
         CASE WHEN closed THEN epoch_us(o_orderdate) + (o_orderkey % 50 - 1) * {MINUTE} END AS finished_us,
         CASE WHEN closed THEN (o_orderkey % 50 - 1) * 60000 END AS duration_ms,
         o_orderkey % 4 AS feeds_total, o_orderkey % 5 AS feeds_succeeded, o_orderkey % 40 AS items_fetched,
         o_orderkey % 30 AS items_inserted, o_orderkey % 7 AS items_duplicate, o_orderkey % 26 AS candidates_count,
         o_orderkey % 8 AS selected_count,
         CASE WHEN status = 'failed' AND o_orderkey % 6 <> 0
              THEN {pick('o_orderkey', 'FEED_TIMEOUT', 'OPENAI_TIMEOUT', 'UNKNOWN')} END AS error_code,
         CASE WHEN status = 'failed' OR o_orderkey % 71 = 0 THEN 'Stopped.' END AS error_summary
  FROM (SELECT *, (status <> 'running' OR o_orderkey % 101 = 0) AS closed
        FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'running' ELSE 'failed' END AS status
              FROM orders))"""

CTES["digest"] = f"""
  SELECT o_orderkey AS digest_id, o_orderkey AS run_id, CAST(o_orderdate AS DATE) AS digest_date,
         'Digest <' || o_orderpriority || '> & more ' AS digest_title,
         CASE o_orderstatus WHEN 'F' THEN 'sent' WHEN 'O' THEN 'generated' ELSE 'failed' END AS status,
         epoch_us(o_orderdate) AS created_us,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 9 <> 0
              THEN epoch_us(o_orderdate) + (o_orderkey % 60) * {MINUTE} END AS sent_us
  FROM orders"""

CTES["digest_item"] = f"""
  SELECT l_orderkey || '-' || (place // 7) AS digest_id, place % 7 + 1 AS position, l_partkey AS news_item_id,
         {pick('l_partkey', 'AI_MODELS', 'AUTOMATION', 'DEVELOPER_TOOLS', 'PRODUCT')} AS tag,
         'Part ' || l_partkey || ' from supplier ' || l_suppkey
           || ' <b>is</b> "new" & improved; it''s worth a look for every team that builds things.' AS summary
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS place
        FROM lineitem)"""

CTES["part_news"] = f"""
  SELECT p_partkey AS news_item_id, p_brand AS source_key, p_name || ' & ' || p_type AS title,
         'https://parts.example.com/a?x=1&id=' || p_partkey AS canonical_url,
         {pick('p_partkey', *['candidate'] * 7, 'used', 'collected')} AS status
  FROM part"""

_BLOCK = (f"'<b>' || position || '. ' || {escape5('title')} || '</b>' || chr(10) || '<blockquote>🏷 ' || "
          f"{escape5('tag')} || '</blockquote>' || chr(10) || {escape5('summary')} || chr(10) || '↗ <a href=\"' || "
          f"{escape5('canonical_url')} || '\">Read on ' || {escape5('source_name')} || '</a>'")
CTES["blocks"] = f"""
  SELECT digest_id, position, {_BLOCK} AS block
  FROM digest_item JOIN part_news USING (news_item_id)
  JOIN (SELECT DISTINCT p_brand AS source_key, 'Brand "' || p_brand || '"' AS source_name FROM part)
    USING (source_key)"""

CTES["titled"] = f"""
  SELECT digest_id, '🗞 <b>' || {escape5(strip('digest_title'))} || '</b>' AS title,
         n || ' stories · AI-generated digest' || chr(10) || 'Always verify details at the original source.' AS footer,
         n, items, body, CASE WHEN news < items THEN 'Digest news items must be unique'
                              WHEN n < items THEN 'Stored digest cannot be split for Telegram delivery.' END AS problem
  FROM (SELECT digest_id, count(*) AS items, count(DISTINCT news_item_id) AS news FROM digest_item GROUP BY 1) i
  JOIN (SELECT digest_id AS run, digest_title FROM digest) d ON d.run = CAST(split_part(i.digest_id, '-', 1) AS BIGINT)
  LEFT JOIN (SELECT digest_id, count(*) AS n,
                    string_agg(block, chr(10) || chr(10) || chr(10) ORDER BY position) AS body
             FROM blocks GROUP BY 1) b USING (digest_id)"""


def query(body: str, *names: str, recursive: bool = False) -> str:
    """``body`` with the named tables in front of it."""
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in names)
    if not parts:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{body}"
