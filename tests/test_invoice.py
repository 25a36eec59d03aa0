"""Gates, duplicates, review rules and messages for invoices."""

import pytest
from pyspark.sql import functions as F

from weirgate import constants as C, schemas
from weirgate.operators import intake, invoice
from weirgate.sources import responses, sinks

GOOD = ("invoice", "ACME-2026-0042", "ACME", "2026-08-15", "2026-08-29", "EUR", 1000.0, 210.0, 1210.0, 0.97, [], [])


def changed(**fields):
    names = [field.name for field in schemas.INVOICE_EXTRACTION.fields]
    return tuple({**dict(zip(names, GOOD)), **fields}.values())


REVIEW_CASES = [
    (changed(), []),
    (changed(invoice_number=None, subtotal=480.0, tax_amount=100.8, total_amount=580.8), ["missing:invoice_number"]),
    (changed(subtotal=700.0, tax_amount=147.0, total_amount=900.0), ["totals_mismatch:53.00"]),
    (changed(document_type="not_invoice"), ["document_type:not_invoice"]),
    (changed(confidence=0.85), []),
    (changed(confidence=0.5), ["low_confidence:0.5"]),
    (changed(confidence=None), ["low_confidence:null"]),
    (changed(invoice_date=""), ["missing:invoice_date", "invalid_date:invoice_date"]),
    (changed(invoice_date="2026-01-01\n"), ["invalid_date:invoice_date"]),
    (changed(currency="eur"), ["invalid_currency"]),
    (changed(tax_amount=-1.0, total_amount=999.0), ["invalid_amount:tax_amount"]),
    (changed(total_amount=1210.02), []),
    (changed(missing_fields=["due_date", "due_date"], due_date=None), ["missing:due_date"]),
    (changed(missing_fields=["currency"]), ["missing:currency"]),
]


def test_review_reasons(spark):
    rows = [case for case, _ in REVIEW_CASES]
    frame = spark.createDataFrame(rows, schemas.INVOICE_EXTRACTION).coalesce(1).withColumn(
        "n", F.monotonically_increasing_id())
    found = [(row.review_reasons, row.status) for row in invoice.review_invoices(frame).orderBy("n").collect()]
    assert found == [(reasons, "needs_review" if reasons else "processed") for _, reasons in REVIEW_CASES]


GATE_CASES = [
    ("a.pdf", "application/pdf", b"%PDF-1.7 x", None, None),
    ("a.PDF", "APPLICATION/X-PDF", b" " * 1019 + b"%PDF-", None, None),
    ("a.pdf", None, b"%PDF-", None, None),
    ("a.pdf", "", b"x" * 1020 + b"%PDF-", None, "The uploaded file does not contain a valid PDF signature."),
    ("fake.pdf", "application/pdf", b"plain text", None, "The uploaded file does not contain a valid PDF signature."),
    ("a.txt", "text/plain", b"%PDF-", None, 'Unsupported file extension in "a.txt". Only PDF is accepted.'),
    ("a.pdf", "Text/Plain", b"%PDF-", None, "Unsupported file type: text/plain. Only PDF is accepted."),
    ("a.pdf", "application/pdf", b"", None, "The uploaded file is empty."),
    ("a.pdf", "application/pdf", b"%PDF-" + b"x" * 100, None,
     "File is too large (105 bytes). Maximum is 100 bytes."),
    (None, None, None, None, "No binary PDF data found."),
    (None, None, None, "Expected exactly one PDF attachment, found 2.", "Expected exactly one PDF attachment, found 2."),
]


def test_gate(spark):
    gate = [(i, *case[:4]) for i, case in enumerate(GATE_CASES)]
    frame = spark.createDataFrame(gate, "n int, file_name string, mime_type string, content binary, rejection_reason string")
    small = intake.gate_documents(frame, 100).orderBy("n").collect()
    large = intake.gate_documents(frame).orderBy("n").collect()
    for row, loose, case in zip(small, large, GATE_CASES):
        checked = loose if case[2] and len(case[2]) > 1000 else row
        assert checked.rejection_reason == case[4]
        assert checked.valid == (case[4] is None)
        assert (checked.file_hash is not None) == checked.valid
    assert large[1].mime_type == "application/pdf"


def test_single_pdf(spark):
    rows = [("m1", 1, "a.pdf", "application/pdf"), ("m1", 2, "b.png", "image/png"), ("m2", 3, "c.PDF", None),
            ("m2", 4, "d", "application/pdf"), ("m3", 5, "e.txt", "text/plain")]
    frame = spark.createDataFrame(rows, "message_id string, attachment_id int, file_name string, mime_type string")
    found = {row.message_id: (row.valid, row.attachment_id, row.rejection_reason)
             for row in intake.require_single_pdf(frame).collect()}
    assert found == {"m1": (True, 1, None),
                     "m2": (False, None, "Expected exactly one PDF attachment, found 2."),
                     "m3": (False, None, "Expected exactly one PDF attachment, found 0.")}


def test_first_match_decides_about_duplicates(spark):
    new = spark.createDataFrame([("h1",), ("h2",), (None,)], "file_hash string")
    audit = spark.createDataFrame([("h1", "2026-01-02", "processed"), ("h1", "2026-01-01", "needs_review"),
                                   (None, "2026-01-01", "processed")], "file_hash string, processed_at string, status string")
    found = {row.file_hash: (row.is_duplicate, row.duplicate_status, row.duplicate_processed_at)
             for row in intake.mark_duplicates(new, audit).collect()}
    assert found == {"h1": (True, "needs_review", "2026-01-01"), "h2": (False, None, None), None: (False, None, None)}


def test_audit_row_has_the_contract_columns(spark, tmp_path):
    frame = spark.createDataFrame([changed(invoice_number=None)], schemas.INVOICE_EXTRACTION)
    rows = invoice.review_invoices(frame).withColumns({name: F.lit(name) for name in (
        "processed_at", "request_id", "file_hash", "file_name", "source", "model")})
    audit = invoice.invoice_audit_rows(rows)
    assert tuple(audit.columns) == C.INVOICE_AUDIT_COLUMNS
    sinks.append_rows(audit, str(tmp_path / "audit"))
    sinks.append_rows(audit, str(tmp_path / "audit"))
    stored = spark.read.parquet(str(tmp_path / "audit")).collect()
    assert len(stored) == 2
    assert stored[0].invoice_number == "" and stored[0].total_amount == "1210"
    assert stored[0].review_reasons == "missing:invoice_number"


def test_messages(spark):
    frame = spark.createDataFrame([changed(vendor_name="A<B & C")], schemas.INVOICE_EXTRACTION).withColumns({
        "file_name": F.lit("x.pdf"), "file_hash": F.lit("ab" * 32), "source": F.lit("webhook"),
        "duplicate_status": F.lit(None).cast("string"), "duplicate_processed_at": F.lit("2026")})
    row = invoice.review_invoices(frame).select(
        invoice.processed_message().alias("ok"), invoice.duplicate_message().alias("dup")).first()
    assert row.ok == ("✅ <b>Invoice processed</b>\n<b>File:</b> <code>x.pdf</code>\n<b>Vendor:</b> A&lt;B &amp; C\n"
                      "<b>Invoice:</b> <code>ACME-2026-0042</code>\n<b>Total:</b> 1210 EUR")
    assert row.dup == ("⏭️ <b>Duplicate invoice skipped</b>\n<b>File:</b> <code>x.pdf</code>\n"
                       "<b>Hash:</b> <code>abababababab…</code>\n<b>Previous status:</b> unknown\n"
                       "<b>Processed at:</b> 2026")


def test_response_outcomes(spark):
    rows = [("boom", "completed", "{}", "Invoice extraction failed: boom"),
            (None, "incomplete", "{}", "Invoice extraction failed: OpenAI response status: incomplete"),
            (None, None, None, "Invoice extraction failed: OpenAI returned no structured output."),
            (None, "completed", "{}", None)]
    frame = spark.createDataFrame([(i, *row[:3]) for i, row in enumerate(rows)],
                                  "n int, error_message string, response_status string, output_text string")
    found = responses.classify_response(frame).orderBy("n").collect()
    assert [row.failure_message for row in found] == [row[3] for row in rows]
    assert [row.response_failed for row in found] == [True, True, True, False]


DIGEST_ITEM = ('{"candidate_id":"%s","summary":"' + "s" * 80 + '","tag":"%s","relevance_score":%s,'
               '"selection_reason":"r"}')


@pytest.mark.parametrize("text,valid", [
    ('{"digest_title":"t","items":[' + DIGEST_ITEM % ("c_01", "PRODUCT", "0.9") + "]}", True),
    ('{"digest_title":"t","items":[]}', False),
    ('{"digest_title":"","items":[' + DIGEST_ITEM % ("c_01", "PRODUCT", "0.9") + "]}", False),
    ('{"digest_title":"t","items":[' + DIGEST_ITEM % ("c_1", "PRODUCT", "0.9") + "]}", False),
    ('{"digest_title":"t","items":[' + DIGEST_ITEM % ("c_01", "NEWS", "0.9") + "]}", False),
    ('{"digest_title":"t","items":[' + DIGEST_ITEM % ("c_01", "PRODUCT", "1.1") + "]}", False),
    ('{"digest_title":"t","items":[' + ",".join([DIGEST_ITEM % ("c_01", "PRODUCT", "0.9")] * 2) + "]}", False),
    ('{"digest_title":"t","extra":1,"items":[' + DIGEST_ITEM % ("c_01", "PRODUCT", "0.9") + "]}", False),
    ('{"items":[' + DIGEST_ITEM % ("c_01", "PRODUCT", "0.9") + "]}", False),
    ("not json", False),
])
def test_digest_schema(spark, text, valid):
    frame = spark.createDataFrame([(text,)], "output_text string")
    row = responses.read_model_responses(frame, schemas.DIGEST_OUTPUT,
                                         rules=responses.digest_output_rules(F.col("output"))).first()
    assert (row.schema_error is None) == valid
    assert (row.output is not None) == valid


def test_messages_and_versions_are_tables(spark, tmp_path):
    messages = spark.createDataFrame([("chat", "r1", "hello", 1)], "channel string, request_id string, text string, x int")
    sinks.write_messages(messages, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["channel", "request_id", "text"]
    for version in (1, 2):
        sinks.write_version(messages.limit(version - 1), str(tmp_path / "t"), version)
    assert [sinks.read_version(spark, str(tmp_path / "t"), version).count() for version in (1, 2)] == [0, 1]
