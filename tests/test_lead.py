"""Lead checks, scores, routes and contacts."""

import json

from pyspark.sql import functions as F

from weirgate import constants as C, schemas
from weirgate.operators import intake, lead
from weirgate.sources import responses
from weirgate.sources.leads import read_lead_requests

LONG = "We have a sufficiently detailed project enquiry that contains more than eighty characters for scoring."
BASE = dict(company="Example Company", message=LONG, estimated_budget=0.0, intent="new_project", confidence=0.9,
            extraction_failed=False)
SCORE_CASES = [
    (dict(requested_service="workflow_automation", urgency="immediate", budget_category="20k_plus",
          decision_maker_signal="strong", confidence=0.95), 100, "hot"),
    (dict(requested_service="crm_integration", urgency="this_quarter", budget_category="5k_10k",
          decision_maker_signal="medium"), 61, "warm"),
    (dict(requested_service="other", urgency="exploring", budget_category="unknown", decision_maker_signal="unknown",
          company="", message="A short but valid generic enquiry."), 2, "cold"),
    (dict(requested_service="workflow_automation", urgency="exploring", budget_category="unknown",
          decision_maker_signal="unknown", company=""), 22, "cold"),
    (dict(requested_service="unclear", urgency="unclear", budget_category="unknown", decision_maker_signal="unknown",
          confidence=0.4), 10, "needs_review"),
    (dict(requested_service=None, urgency=None, budget_category=None, decision_maker_signal=None, confidence=None,
          extraction_failed=True), 10, "needs_review"),
    (dict(requested_service="ai_integration", urgency="within_month", budget_category="unknown",
          decision_maker_signal="medium", estimated_budget=25000.0), 85, "hot"),
]
SCHEMA = ("n int, company string, message string, estimated_budget double, intent string, requested_service string, "
          "urgency string, budget_category string, decision_maker_signal string, confidence double, extraction_failed boolean")


def scored(spark):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    rows = [tuple({**BASE, **case, "n": i}[name] for name in names) for i, (case, _, _) in enumerate(SCORE_CASES)]
    return lead.lead_tier(lead.lead_score(spark.createDataFrame(rows, SCHEMA)))


def test_score_and_tier(spark):
    found = scored(spark).orderBy("n").collect()
    assert [(row.score, row.tier) for row in found] == [(score, tier) for _, score, tier in SCORE_CASES]
    assert found[4].review_reasons == ["low_confidence", "unclear_service", "unclear_urgency"]
    assert found[5].review_reasons == ["ai_extraction_failed"]
    assert found[6].budget_category == "20k_plus" and found[6].score_breakdown.budget == 30


def test_budget_bounds(spark):
    values = [0.0, -5.0, 1.0, 4999.99, 5000.0, 10000.0, 20000.0, None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, b double")
    found = frame.select("n", lead.lead_budget_category(F.col("b"), F.lit("unknown")).alias("c")).orderBy("n").collect()
    assert [row.c for row in found] == ["unknown", "unknown", "under_5k", "under_5k", "5k_10k", "10k_20k", "20k_plus",
                                        "unknown"]


def test_validation_and_consent(spark, tmp_path):
    good = dict(name="Maya Chen", email=" Maya.Chen@Example.com ", message=LONG, source="website",
                consent_to_contact=True, idempotency_key="k1")
    cases = [
        (good, None), ({**good, "email": "no-at"}, "INVALID_INPUT"), ({**good, "message": "  "}, "INVALID_INPUT"),
        ({**good, "message": "A" * 4000}, None), ({**good, "message": "A" * 4001}, "INVALID_INPUT"),
        ({**good, "message": "A" * 4000 + "\n "}, None),
        ({**good, "consent_to_contact": False}, "CONSENT_REQUIRED"),
        ({**good, "idempotency_key": ""}, "INVALID_INPUT"), ({**good, "idempotency_key": "", "header_key": "h"}, None),
        ({**good, "name": None, "consent_to_contact": False}, "INVALID_INPUT"),
    ]
    path = tmp_path / "requests"
    path.mkdir()
    (path / "a.json").write_text("\n".join(json.dumps({**case, "phone": str(i)}) for i, (case, _) in enumerate(cases)))
    rows = lead.validate_lead(read_lead_requests(spark, str(path)))
    found = {int(row.phone): row for row in rows.collect()}
    assert [found[i].error_code for i in range(len(cases))] == [code for _, code in cases]
    assert found[0].email == "maya.chen@example.com" and found[0].http_code is None
    assert found[1].http_code == 400 and found[6].http_code == 422
    kept, refused = lead.gate_consent(read_lead_requests(spark, str(path)))
    assert (kept.count(), refused.count()) == (8, 2)


def routed(spark):
    return lead.lead_route(scored(spark).withColumns({
        "known": F.col("n") == 1, "crm_failed": F.col("n") == 3, "request_id": F.col("n").cast("string"),
        "email": F.lit("maya@example.com"), "name": F.lit("Maya Chen"), "phone": F.lit("+1 202"),
        "source": F.lit("website"), "summary": F.lit("s"), "idempotency_key": F.col("n").cast("string"),
        "received_at": F.timestamp_seconds(F.col("n")), "hubspot_contact_id": F.lit("c"),
        "error_message": F.lit(None).cast("string")}))


def test_routes(spark):
    found = routed(spark).orderBy("n").collect()
    assert [(row.action, row.status, row.http_code) for row in found] == [
        ("alert+draft", "completed", 202), ("none", "duplicate", 200), ("store", "completed", 202),
        ("technical_alert", "failed", 503), ("review_alert", "needs_review", 202),
        ("review_alert", "needs_review", 202), ("alert+draft", "completed", 202)]
    assert found[3].error_code == "CRM_UPSERT_FAILED"


def test_audit_rows_hide_the_person(spark):
    audit = lead.lead_audit_rows(routed(spark))
    assert tuple(audit.columns) == C.LEAD_AUDIT_COLUMNS
    rows = audit.collect()
    assert len(rows) == 6 and {row.email_masked for row in rows} == {"ma***@example.com"}
    assert json.loads(rows[0].score_breakdown)["budget"] == 30
    assert not {"email", "phone", "message"} & set(lead.lead_model_input(
        routed(spark)).drop("message").columns)
    assert not {"email", "phone"} & set(lead.lead_alert_view(routed(spark)).columns)


def test_drafts(spark):
    drafts = lead.follow_up_drafts(routed(spark)).collect()
    assert sorted(row.request_id for row in drafts) == ["0", "6"]
    assert all(row.sent is False and row.body.startswith("Hello Maya,") for row in drafts)


def test_idempotency_split(spark):
    new = spark.createDataFrame([("a",), ("b",), (None,)], "idempotency_key string")
    audit = spark.createDataFrame([("a",), ("a",), (None,)], "idempotency_key string")
    fresh, repeated = intake.split_by_idempotency(new, audit)
    assert sorted(str(row[0]) for row in fresh.collect()) == ["None", "b"]
    assert [tuple(row) for row in repeated.collect()] == [("a", "duplicate")]
    assert {row.idempotency_key: row.known for row in intake.mark_known_keys(new, audit).collect()} == {
        "a": True, "b": False, None: False}


def test_contacts_keep_their_record(spark):
    current = spark.createDataFrame(
        [("c1", "maya@example.com", "Maya", "Chen", "Old", "1"), ("c2", "kept@example.com", "K", "T", None, None)],
        "contact_id string, email string, first_name string, last_name string, company string, phone string"
    ).withColumn("created_at", F.timestamp_seconds(F.lit(1)))
    leads = spark.createDataFrame(
        [("r1", " Maya@Example.com", "Maya Chen", "New", "", 10), ("r2", "maya@example.com", "Maya C Lee", "", None, 20),
         ("r3", "new@example.com", "Neo", "N", "9", 30)],
        "request_id string, email string, name string, company string, phone string, t int"
    ).withColumn("received_at", F.timestamp_seconds("t"))
    found = {row.email: row for row in lead.upsert_contacts(current, leads).collect()}
    maya = found["maya@example.com"]
    assert (maya.contact_id, maya.first_name, maya.last_name, maya.company, maya.phone, maya.change) == (
        "c1", "Maya", "C Lee", "New", "1", "updated")
    assert maya.created_at.timestamp() == 1
    assert found["kept@example.com"].change == "kept" and found["new@example.com"].change == "created"
    assert len(found) == 3


def test_signal_schema(spark):
    good = {"intent": "support", "requested_service": "other", "urgency": "exploring", "budget_category": "unknown",
            "decision_maker_signal": "weak", "summary": "s", "missing_information": ["budget"], "confidence": 0.5}
    cases = [(good, True), ({**good, "intent": "x"}, False), ({**good, "missing_information": ["budget"] * 2}, False),
             ({**good, "confidence": 1.5}, False), ({**good, "summary": ""}, False), ({**good, "z": 1}, False)]
    frame = spark.createDataFrame([(i, json.dumps(case)) for i, (case, _) in enumerate(cases)], "n int, output_text string")
    found = responses.read_model_responses(frame, schemas.LEAD_SIGNALS, rules=responses.lead_output_rules(F.col("output")))
    assert [row.schema_error is None for row in found.orderBy("n").collect()] == [valid for _, valid in cases]


def test_accuracy(spark):
    fields = "fixture string, intent string, urgency string"
    expected = spark.createDataFrame([("a", "support", "exploring"), ("b", "other", None)], fields)
    actual = spark.createDataFrame([("a", "support", "immediate"), ("b", "other", None), ("c", "x", "y")], fields)
    found = {row.field: (row.cases, row.matches, row.accuracy)
             for row in lead.score_extraction(expected, actual, fields=("intent", "urgency")).collect()}
    assert found == {"intent": (2, 2, 1.0), "urgency": (2, 1, 0.5)}
