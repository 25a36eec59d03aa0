"""Explicit schemas of records outside the store. No schema is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _B, _I = T.StringType(), T.DoubleType(), T.BooleanType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


INVOICE_EXTRACTION = _struct(
    document_type=_S, invoice_number=_S, vendor_name=_S, invoice_date=_S, due_date=_S, currency=_S,
    subtotal=_D, tax_amount=_D, total_amount=_D, confidence=_D,
    missing_fields=T.ArrayType(_S), notes=T.ArrayType(_S),
)

LEAD_REQUEST = _struct(
    name=_S, email=_S, company=_S, phone=_S, message=_S, estimated_budget=_D, source=_S,
    consent_to_contact=_B, idempotency_key=_S,
)

LEAD_SIGNALS = _struct(
    intent=_S, requested_service=_S, urgency=_S, budget_category=_S, decision_maker_signal=_S, summary=_S,
    missing_information=T.ArrayType(_S), confidence=_D,
)

DIGEST_OUTPUT_ITEM = _struct(
    candidate_id=_S, summary=_S, tag=_S, relevance_score=_D, selection_reason=_S,
)
DIGEST_OUTPUT = _struct(digest_title=_S, items=T.ArrayType(DIGEST_OUTPUT_ITEM))

FEED_SOURCE = _struct(
    source_key=_S, name=_S, feed_url=_S, allowed_host=_S, category=_S, language=_S, enabled=_B,
    priority=T.DecimalType(4, 2), max_items_per_run=_I, request_timeout_seconds=_I,
)

_TEXT = _struct(_VALUE=_S)
_FEED_ITEM = _struct(
    guid=_TEXT, id=_TEXT, title=_TEXT,
    link=T.ArrayType(_struct(_VALUE=_S, _href=_S, _rel=_S)),
    description=_TEXT, summary=_TEXT, content=T.ArrayType(_TEXT), encoded=_TEXT,
    author=_struct(_VALUE=_S, name=_S), creator=_S,
    pubDate=_S, published=_S, updated=_S, date=_S,
)
#: One shape for RSS (channel/item), Atom (entry) and RDF (item beside the channel).
FEED_BODY = T.StructType([
    T.StructField("channel", _struct(item=T.ArrayType(_FEED_ITEM))),
    T.StructField("item", T.ArrayType(_FEED_ITEM)),
    T.StructField("entry", T.ArrayType(_FEED_ITEM)),
    T.StructField("_corrupt", _S),
])
FEED_ITEM = T.StructType(_FEED_ITEM.fields + [T.StructField("_corrupt", _S)])
