"""Fixed values of the data model: closed enums, transition tables, contracts, weights and texts."""

from __future__ import annotations

# --- Fixed values: closed enums -------------------------------------------------------------------
TRIGGER_TYPES = ("scheduled", "manual", "dry_run")
RUN_STATUSES = ("running", "success", "partial_success", "no_content", "failed", "skipped_locked")
FETCH_STATUSES = ("not_modified", "success", "failed")
NEWS_STATUSES = ("collected", "candidate", "used", "ignored")
DIGEST_STATUSES = ("generated", "sending", "sent", "failed")
DELIVERY_STATUSES = ("pending", "sent", "failed")
IGNORE_REASONS = (
    "too_old", "missing_title", "missing_content", "invalid_url", "irrelevant", "duplicate_content",
)
DIGEST_TAGS = (
    "AI_MODELS", "AUTOMATION", "DEVELOPER_TOOLS", "PRODUCT", "SECURITY", "RESEARCH", "BUSINESS", "OTHER",
)
ERROR_CODES = (
    "FEED_TIMEOUT", "FEED_CONNECTION_FAILED", "UNSAFE_FEED_URL", "FEED_RESPONSE_TOO_LARGE", "FEED_PARSE_FAILED",
    "OPENAI_TIMEOUT", "OPENAI_RATE_LIMITED", "INVALID_STRUCTURED_OUTPUT", "OUTPUT_POST_VALIDATION_FAILED",
    "TELEGRAM_TIMEOUT", "TELEGRAM_RATE_LIMITED", "TELEGRAM_PERMANENT_FAILURE", "UNEXPECTED_PIPELINE_FAILURE",
)
RETRYABLE_DELIVERY_ERRORS = ("TELEGRAM_TIMEOUT", "TELEGRAM_RATE_LIMITED")
DIGEST_MODEL = "gpt-4o-mini"

# --- Fixed values: allowed status changes ---------------------------------------------------------
TRANSITIONS = {
    "pipeline run": (
        ("running", "success"), ("running", "partial_success"), ("running", "no_content"), ("running", "failed"),
    ),
    "news item": (
        ("collected", "candidate"), ("collected", "ignored"), ("candidate", "used"), ("candidate", "collected"),
    ),
    "digest": (
        ("generated", "sending"), ("sending", "sent"), ("sending", "failed"), ("failed", "sending"),
    ),
}

# --- Fixed values: invoice contract ---------------------------------------------------------------
INVOICE_REQUIRED = (
    "invoice_number", "vendor_name", "invoice_date", "due_date", "currency", "subtotal", "tax_amount", "total_amount",
)
INVOICE_AMOUNTS = ("subtotal", "tax_amount", "total_amount")
INVOICE_DATES = ("invoice_date", "due_date")
INVOICE_MIN_CONFIDENCE = 0.85
INVOICE_TOTAL_TOLERANCE = 0.02
INVOICE_AUDIT_COLUMNS = (
    "processed_at", "request_id", "file_hash", "file_name", "source", "status", "review_reasons", "document_type",
    "invoice_number", "vendor_name", "invoice_date", "due_date", "currency", "subtotal", "tax_amount", "total_amount",
    "confidence", "model",
)
PDF_MIME_TYPES = ("application/pdf", "application/x-pdf", "application/octet-stream", "")
PDF_MAX_BYTES = 10 * 1024 * 1024
PDF_HEADER_BYTES = 1024

# --- Fixed values: lead contract ------------------------------------------------------------------
LEAD_MESSAGE_MAX = 4000
LEAD_MESSAGE_USEFUL = 80
LEAD_MIN_CONFIDENCE = 0.65
LEAD_POINTS = {
    "budget_category": {"20k_plus": 30, "10k_20k": 24, "5k_10k": 16, "under_5k": 6},
    "urgency": {"immediate": 25, "within_month": 20, "this_quarter": 10, "exploring": 2},
    "decision_maker_signal": {"strong": 20, "medium": 10, "weak": 3},
    "requested_service": {
        "workflow_automation": 15, "ai_integration": 15, "crm_integration": 15, "data_pipeline": 15,
    },
}
LEAD_COMPANY_POINTS = 5
LEAD_MESSAGE_POINTS = 5
LEAD_HOT_FROM = 75
LEAD_WARM_FROM = 45
LEAD_ENUMS = {
    "intent": ("new_project", "consultation", "partnership", "support", "other"),
    "requested_service": (
        "workflow_automation", "ai_integration", "crm_integration", "data_pipeline", "other", "unclear",
    ),
    "urgency": ("immediate", "within_month", "this_quarter", "exploring", "unclear"),
    "budget_category": ("under_5k", "5k_10k", "10k_20k", "20k_plus", "unknown"),
    "decision_maker_signal": ("strong", "medium", "weak", "unknown"),
}
LEAD_MISSING_INFORMATION = ("company", "requested_service", "budget", "timeline", "business_goal")
LEAD_AUDIT_COLUMNS = (
    "received_at", "request_id", "idempotency_key", "email_masked", "company", "source", "intent",
    "requested_service", "urgency", "budget_category", "score", "tier", "score_breakdown", "crm_status",
    "hubspot_contact_id", "action", "status", "error_code", "error_message",
)
#: Words that give a fixture's class away when they occur in an idempotency key.
LABEL_WORDS = ("hot", "warm", "cold", "review", "invalid", "consent", "injection")
#: Words that give a fixture's purpose away when they occur in its source.
SOURCE_WORDS = ("injection", "prompt", "security")

# --- Fixed values: news selection and digests -----------------------------------------------------
MAX_ITEMS_PER_SOURCE = 3
MAX_CANDIDATES = 25
MAX_NEW_ITEMS_PER_RUN = 100
MAX_ENTRIES_PER_SOURCE = 50
ARTICLE_TEXT_MAX = 12_000
KEYWORD_WEIGHT, FRESHNESS_WEIGHT, SOURCE_WEIGHT = 0.45, 0.30, 0.25
DIGEST_MAX_ITEMS = 7
MESSAGE_LIMIT = 4096
EXCERPT_MAX_CHARS = 1500
TITLE_EMOJI, TAG_EMOJI, LINK_EMOJI = "🗞", "🏷", "↗"
ITEM_SEPARATOR = "\n\n\n"
READ_ON = "Read on "
FOOTER_STORIES = " stories · AI-generated digest"
FOOTER_VERIFY = "Always verify details at the original source."

# --- Fixed values: URL rules ----------------------------------------------------------------------
TRACKING_PARAMETERS = ("gclid", "fbclid", "mc_cid", "mc_eid", "igshid", "_ga")
FEED_CONTENT_TYPES = (
    "application/rss+xml", "application/atom+xml", "application/xml", "text/xml", "application/xhtml+xml",
)
FEED_XML_PREFIXES = ("<?xml", "<rss", "<feed", "<RDF")

# --- Fixed values: log redaction ------------------------------------------------------------------
SECRET_KEY_FRAGMENTS = (
    "token", "password", "secret", "api_key", "apikey", "authorization", "dsn", "database_url", "chat_id",
    "bot_token", "openai_api_key", "admin_api_key",
)
CONTENT_KEYS = (
    "title", "summary", "body", "prompt", "articles_json", "system", "rendered_text", "feed_body", "raw_summary",
    "sanitized_summary",
)

# --- Fixed values: secret shapes ------------------------------------------------------------------
SECRET_PATTERNS = {
    "OpenAI key": r"sk-[A-Za-z0-9_-]{20,}",
    "Bearer token": r"(?i)Bearer\s+[A-Za-z0-9._-]{20,}",
    "Google private key": r"BEGIN PRIVATE KEY",
    "Telegram bot token": r"\b\d{8,12}:[A-Za-z0-9_-]{30,}\b",
}
#: A lower-case text that every match of the pattern contains, ignoring case.
SECRET_NEEDLES = {
    "OpenAI key": "sk-",
    "Bearer token": "bearer",
    "Google private key": "begin private key",
    "Telegram bot token": ":",
}

# --- Fixed values: messages ------------------------------------------------------------------------
#: Head of the warning about failing sources; their keys follow.
NOISY_FEEDS = "One or more feeds exceeded the consecutive failure threshold: "

#: A stored digest that cannot be rendered because an article or a source is gone.
DIGEST_UNUSABLE = "Stored digest cannot be split for Telegram delivery."

#: Why a delivery failed: no trials left, or an error that is not retried.
DELIVERY_EXHAUSTED = "Telegram delivery retries exhausted."
DELIVERY_REJECTED = "Delivery was rejected."
