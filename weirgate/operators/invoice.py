"""Review rules, audit rows and messages for invoices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirgate import constants as C
from weirgate.functions.numbers import fixed, plain_number
from weirgate.functions.text import clean_text, escape_html3, or_default, short_hash


def _tagged(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ":"), value)


def invoice_review_reasons() -> Column:
    """Ordered reasons why an extraction needs review (B3, G2); an empty array means none.

    Works on the extraction columns. An empty text counts as missing *and* breaks the date or currency shape;
    a null confidence counts as low and prints as ``null``.
    """
    missing = [
        F.when(F.col(name).isNull() | (F.col(name).cast("string") == ""), F.lit(f"missing:{name}"))
        for name in C.INVOICE_REQUIRED
    ]
    reported = F.transform(F.coalesce("missing_fields", F.array().cast("array<string>")),
                           lambda name: F.concat(F.lit("missing:"), name))
    kind, confidence = F.col("document_type"), F.col("confidence")
    low = confidence.isNull() | (confidence < C.INVOICE_MIN_CONFIDENCE)
    later = [
        F.when(~F.coalesce(kind == "invoice", F.lit(False)),
               _tagged("document_type", F.coalesce(kind, F.lit("null")))),
        F.when(low, _tagged("low_confidence", plain_number(confidence))),
    ]
    later += [
        F.when(~F.rlike(F.col(name), F.lit(r"\A\d{4}-\d{2}-\d{2}\z")), F.lit(f"invalid_date:{name}"))
        for name in C.INVOICE_DATES
    ]
    later.append(F.when(~F.rlike(F.col("currency"), F.lit(r"\A[A-Z]{3}\z")), F.lit("invalid_currency")))
    for name in C.INVOICE_AMOUNTS:
        amount = F.col(name)
        odd = F.isnan(amount) | (F.abs(amount) == F.lit(float("inf"))) | (amount < 0)
        later.append(F.when(odd, F.lit(f"invalid_amount:{name}")))
    gap = F.abs(F.col("subtotal") + F.col("tax_amount") - F.col("total_amount"))
    later.append(F.when(~F.isnan(gap) & (gap > C.INVOICE_TOTAL_TOLERANCE), _tagged("totals_mismatch", fixed(gap, 2, ties="up"))))
    return F.concat(
        F.array_union(F.array_compact(F.array(*missing)), reported), F.array_compact(F.array(*later)))


def invoice_status(reasons: str = "review_reasons") -> Column:
    """``processed`` without reasons, else ``needs_review``."""
    return F.when(F.size(reasons) == 0, "processed").otherwise("needs_review")


def review_invoices(extractions: DataFrame) -> DataFrame:
    """Add ``review_reasons`` and ``status``; printed values are never repaired."""
    return extractions.withColumn("review_reasons", invoice_review_reasons()).withColumn("status", invoice_status())


def invoice_audit_rows(reviewed: DataFrame) -> DataFrame:
    """The 18 audit columns as text (A9): nulls are empty, reasons joined by ``; ``."""
    empty = F.lit("")
    text = {name: F.coalesce(F.col(name).cast("string"), empty) for name in C.INVOICE_AUDIT_COLUMNS
            if name not in ("review_reasons", "confidence", *C.INVOICE_AMOUNTS)}
    text["review_reasons"] = F.array_join("review_reasons", "; ")
    text["confidence"] = plain_number(F.col("confidence"))
    for name in C.INVOICE_AMOUNTS:
        text[name] = F.when(F.col(name).isNull(), empty).otherwise(plain_number(F.col(name)))
    return reviewed.select(*[text[name].alias(name) for name in C.INVOICE_AUDIT_COLUMNS])


def _lines(*parts: Column | str) -> Column:
    return F.concat_ws("\n", *[F.lit(part) if isinstance(part, str) else part for part in parts])


def _field(label: str, value: Column, code: bool = False) -> Column:
    opening, closing = ("<code>", "</code>") if code else ("", "")
    return F.concat(F.lit(f"<b>{label}:</b> {opening}"), value, F.lit(closing))


def processed_message() -> Column:
    """Message about a processed invoice (K4)."""
    total = F.concat(escape_html3(F.when(F.col("total_amount").isNotNull(), plain_number(F.col("total_amount")))),
                     F.lit(" "), escape_html3("currency"))
    return _lines(
        "✅ <b>Invoice processed</b>", _field("File", escape_html3("file_name"), code=True),
        _field("Vendor", escape_html3("vendor_name")), _field("Invoice", escape_html3("invoice_number"), code=True),
        _field("Total", total),
    )


def review_message() -> Column:
    """Message about an invoice that needs review (K4)."""
    return _lines(
        "⚠️ <b>Invoice needs review</b>", _field("File", escape_html3("file_name"), code=True),
        _field("Vendor", escape_html3(or_default("vendor_name", "unknown"))),
        _field("Reasons", escape_html3(F.array_join("review_reasons", ", ")), code=True),
    )


def duplicate_message() -> Column:
    """Message about a skipped duplicate (K4)."""
    return _lines(
        "⏭️ <b>Duplicate invoice skipped</b>",
        _field("File", escape_html3(or_default("file_name", "unknown")), code=True),
        _field("Hash", escape_html3(short_hash("file_hash")), code=True),
        _field("Previous status", escape_html3(or_default("duplicate_status", "unknown"))),
        _field("Processed at", escape_html3(or_default("duplicate_processed_at", "unknown"))),
    )


def rejection_message() -> Column:
    """Plain message about a rejected file (K4)."""
    return _lines(
        "🚫 Invoice rejected",
        F.concat(F.lit("Source: "), F.coalesce(F.col("source"), F.lit("unknown"))),
        F.concat(F.lit("File: "), F.coalesce(F.col("file_name"), F.lit("not supplied"))),
        F.concat(F.lit("Reason: "), F.coalesce(F.col("rejection_reason"), F.lit(""))),
    )


def render_invoice_message() -> Column:
    """The message that fits the row's outcome (K4): rejected, duplicate, processed or review."""
    return (
        F.when(F.col("rejection_reason").isNotNull(), rejection_message())
        .when(F.col("is_duplicate"), duplicate_message())
        .when(F.col("status") == "processed", processed_message())
        .otherwise(review_message())
    )


def invoice_error_message() -> Column:
    """Plain alert about a failed invoice run (K5). Needs the redacted ``error_message``."""
    parts = [("Workflow", "workflow_name", "unknown"), ("Execution", "execution_id", "unknown"),
             ("Last node", "failed_node", "unknown"), ("Error", "error_message", "Unknown error"),
             ("Time", "failed_at", "unknown")]
    url = F.when(F.coalesce(F.col("execution_url"), F.lit("")) != "",
                 F.concat(F.lit("Open execution: "), F.col("execution_url"))).otherwise("")
    return _lines(
        "🚨 Invoice workflow failed",
        *[F.concat(F.lit(f"{label}: "), F.coalesce(F.col(name).cast("string"), F.lit(default)))
          for label, name, default in parts],
        url,
    )


def lead_error_message() -> Column:
    """HTML alert about a failed lead run (K5). Needs the redacted ``error_message``."""

    def shown(name: str, default: str) -> Column:
        return escape_html3(clean_text(or_default(name, default)))

    return _lines(
        "🚨 <b>LEAD WORKFLOW ERROR</b>", "", "⚙️ <b>Workflow</b>", shown("workflow_name", "unknown"),
        F.concat(F.lit("Execution: <code>"), shown("execution_id", "unavailable"), F.lit("</code>")), "",
        "📍 <b>Failure</b>", F.concat(F.lit("Node: "), shown("failed_node", "unknown")),
        F.concat(F.lit("Time: "), shown("failed_at", "unknown")), "", "🧾 <b>Error</b>",
        shown("error_message", "Unknown workflow error"),
    )
