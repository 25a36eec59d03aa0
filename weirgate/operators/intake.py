"""Gates, unions and duplicate lookups at the door."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirgate import constants as C
from weirgate.functions.hashing import file_hash
from weirgate.functions.text import or_default
from weirgate.operators.keys import one_per_key


def gate_documents(files: DataFrame, max_bytes: int = C.PDF_MAX_BYTES) -> DataFrame:
    """First broken rule per file (B1): adds ``valid, rejection_reason, file_hash`` and normalises ``mime_type``.

    Needs ``file_name, mime_type, content``; an upstream ``rejection_reason`` is kept when there is no content.
    The hash is computed for accepted files only.
    """
    name = F.coalesce(F.col("file_name"), F.lit("unknown"))
    mime = F.lower(F.coalesce(F.col("mime_type"), F.lit("")))
    size = F.col("file_size_bytes") if "file_size_bytes" in files.columns else F.length("content")
    head = F.decode(F.substring(F.col("content"), 1, C.PDF_HEADER_BYTES), "ISO-8859-1")
    upstream = F.col("rejection_reason") if "rejection_reason" in files.columns else F.lit(None).cast("string")
    reason = (
        F.when(size.isNull(), F.coalesce(upstream, F.lit("No binary PDF data found.")))
        .when(size == 0, "The uploaded file is empty.")
        .when(size > max_bytes, F.concat(
            F.lit("File is too large ("), size.cast("string"), F.lit(f" bytes). Maximum is {max_bytes} bytes.")))
        .when(~F.lower(name).endswith(".pdf"), F.concat(
            F.lit('Unsupported file extension in "'), name, F.lit('". Only PDF is accepted.')))
        .when(~mime.isin(*C.PDF_MIME_TYPES), F.concat(
            F.lit("Unsupported file type: "), mime, F.lit(". Only PDF is accepted.")))
        .when(~F.contains(head, F.lit("%PDF-")), "The uploaded file does not contain a valid PDF signature.")
    )
    gated = files.withColumn("rejection_reason", reason)
    valid = F.col("rejection_reason").isNull()
    return (
        gated.withColumn("valid", valid)
        .withColumn("mime_type", F.when(valid, "application/pdf").otherwise(or_default(mime, "unknown")))
        .withColumn("file_name", name)
        .withColumn("file_hash", F.when(valid, file_hash(F.col("content"))))
    )


def is_pdf_attachment() -> Column:
    """PDF by type or by name."""
    return (F.coalesce(F.col("mime_type") == "application/pdf", F.lit(False))
            | F.lower(F.coalesce(F.col("file_name"), F.lit(""))).endswith(".pdf"))


def require_single_pdf(attachments: DataFrame, message: str = "message_id",
                       attachment: str = "attachment_id") -> DataFrame:
    """One row per message (B2): its only PDF attachment, or the reason why it is rejected.

    Counts and the candidate are combined before the shuffle, so a message with very many attachments is no problem.
    """
    pdf = is_pdf_attachment()
    counted = attachments.groupBy(message).agg(
        F.count_if(pdf).alias("pdf_count"),
        F.min(F.when(pdf, F.col(attachment))).alias(attachment),
    )
    single = F.col("pdf_count") == 1
    return counted.select(
        message, "pdf_count", F.when(single, F.col(attachment)).alias(attachment), single.alias("valid"),
        F.when(~single, F.concat(
            F.lit("Expected exactly one PDF attachment, found "), F.col("pdf_count").cast("string"), F.lit("."))
        ).alias("rejection_reason"),
    )


def union_intake(web: DataFrame, mailbox: DataFrame) -> DataFrame:
    """Both intake branches as one table with a ``source`` tag (G1)."""
    return web.withColumn("source", F.lit("webhook")).unionByName(
        mailbox.withColumn("source", F.lit("gmail")), allowMissingColumns=True)


def merge_branches(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Join two branches of the same records on their key (C3); row order is no key in Spark."""
    return left.join(right, key, "left")


def mark_duplicates(new: DataFrame, audit: DataFrame, key: str = "file_hash", order: str = "processed_at",
                    status: str = "status") -> DataFrame:
    """Flag rows whose key is in the audit table (C1) with the status and time of its first row.

    The audit table is reduced to one row per key before the join, so the join adds no rows; a hot key on the other
    side is split by the adaptive skew join.
    """
    first = one_per_key(audit, [key], F.min(F.struct(F.col(order).alias("at"), F.col(status).alias("status")))
                        .alias("_first"))
    joined = new.join(first, key, "left")
    return (
        joined.withColumn("is_duplicate", F.col("_first").isNotNull())
        .withColumn("duplicate_status", F.col("_first.status"))
        .withColumn("duplicate_processed_at", F.col("_first.at"))
        .drop("_first")
    )


def split_by_idempotency(new: DataFrame, audit: DataFrame,
                         key: str = "idempotency_key") -> tuple[DataFrame, DataFrame]:
    """Requests to process and requests already answered."""
    known = one_per_key(audit.where(F.col(key).isNotNull()), [key])
    fresh = new.join(known, key, "left_anti")
    repeated = new.join(known, key, "left_semi").withColumn("outcome", F.lit("duplicate"))
    return fresh, repeated


def mark_known_keys(new: DataFrame, audit: DataFrame, key: str = "idempotency_key") -> DataFrame:
    """The same split in one pass: adds ``known`` instead of producing two tables."""
    keys = one_per_key(audit.where(F.col(key).isNotNull()), [key]).withColumn("_known", F.lit(True))
    return new.join(keys, key, "left").withColumn("known", F.coalesce("_known", F.lit(False))).drop("_known")


def tag_by_idempotency(new: DataFrame, audit: DataFrame, key: str = "idempotency_key") -> DataFrame:
    """Both sides of the split as one table with ``outcome`` (C2): ``new`` or ``duplicate``. The requests are built once."""
    return mark_known_keys(new, audit, key).withColumn(
        "outcome", F.when(F.col("known"), "duplicate").otherwise("new")).drop("known")


def difference(left: DataFrame, right: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right`` (G3, C10). ``right`` is reduced to its keys, so hot keys on either side
    are split."""
    keys = [key] if isinstance(key, str) else key
    return left.join(one_per_key(right, keys), keys, "left_anti")
