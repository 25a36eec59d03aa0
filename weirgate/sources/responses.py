"""Model responses that landed as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirgate import constants as C
from weirgate.functions.text import or_default


def classify_response(responses: DataFrame) -> DataFrame:
    """Add ``response_failed`` and ``failure_message``.

    Needs ``error_message, response_status, output_text``. A failed response carries the first reason that applies.
    """
    error = F.nullif(F.col("error_message"), F.lit(""))
    status = F.nullif(F.col("response_status"), F.lit(""))
    no_text = F.nullif(F.col("output_text"), F.lit("")).isNull()
    failed = error.isNotNull() | F.coalesce(status != "completed", F.lit(False)) | no_text
    detail = F.coalesce(
        error, F.concat(F.lit("OpenAI response status: "), status), F.lit("OpenAI returned no structured output."))
    return responses.withColumn("response_failed", failed).withColumn(
        "failure_message", F.when(failed, F.concat(F.lit("Invoice extraction failed: "), detail)))


def _unknown_keys(text: Column, schema: T.StructType) -> Column:
    known = F.array(*[F.lit(name) for name in schema.fieldNames()])
    return F.size(F.array_except(F.json_object_keys(text), known)) > 0


def _missing_keys(text: Column, schema: T.StructType) -> Column:
    known = F.array(*[F.lit(name) for name in schema.fieldNames()])
    return F.size(F.array_except(known, F.json_object_keys(text))) > 0


def strictly(value: Column, kind: T.DataType) -> Column:
    """Whether a JSON value (a variant) has exactly this type: closed objects at every level, no text for numbers or
    numbers for text. Null fits every type."""
    told = F.schema_of_variant(value)
    if isinstance(kind, T.StructType):
        fields = F.try_variant_get(value, "$", "map<string,variant>")
        names = F.array(*[F.lit(name) for name in kind.fieldNames()])
        fits = (F.size(fields) == len(kind)) & (F.size(F.array_except(names, F.map_keys(fields))) == 0)
        for field in kind:
            fits = fits & strictly(F.try_element_at(fields, F.lit(field.name)), field.dataType)
    elif isinstance(kind, T.ArrayType):
        fits = F.forall(F.try_variant_get(value, "$", "array<variant>"), lambda item: strictly(item, kind.elementType))
    elif isinstance(kind, T.BooleanType):
        fits = told == "BOOLEAN"
    elif isinstance(kind, (T.LongType, T.IntegerType)):
        fits = told == "BIGINT"
    elif isinstance(kind, T.NumericType):
        fits = F.rlike(told, F.lit(r"\A(BIGINT|DOUBLE|FLOAT|DECIMAL)"))
    else:
        fits = told == "STRING"
    return value.isNull() | (told == "VOID") | F.coalesce(fits, F.lit(False))


def read_model_responses(responses: DataFrame, schema: T.StructType, text: str = "output_text",
                         rules: Column | None = None) -> DataFrame:
    """Bind JSON texts to a closed schema.

    Adds ``output`` (null when invalid) and ``schema_error`` = ``INVALID_STRUCTURED_OUTPUT`` for malformed JSON, a
    wrong type, an unknown or absent key at any level, or a breach of ``rules`` (a condition over ``output``).
    """
    bound = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    value = F.from_json(F.col(text), bound, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = responses.withColumn("output", value)
    invalid = (
        F.col("output").isNull() | F.col("output._corrupt").isNotNull()
        | F.coalesce(_unknown_keys(F.col(text), schema) | _missing_keys(F.col(text), schema), F.lit(True))
    )
    invalid = invalid | ~strictly(F.try_parse_json(F.col(text)), schema)
    if rules is not None:
        invalid = invalid | ~F.coalesce(rules, F.lit(False))
    rows = rows.withColumn("_invalid", invalid)
    return (
        rows.withColumn("schema_error", F.when(F.col("_invalid"), "INVALID_STRUCTURED_OUTPUT"))
        .withColumn("output", F.when(~F.col("_invalid"), F.col("output").dropFields("_corrupt")))
        .drop("_invalid")
    )


def digest_output_rules(output: Column) -> Column:
    """Ranges of a digest output: title length, 1..7 items, unique ids, and the range of every item field."""
    items = output["items"]
    ids = F.transform(items, lambda item: item["candidate_id"])
    good = F.forall(
        items,
        lambda item: F.coalesce(
            F.rlike(item["candidate_id"], F.lit(r"\Ac_\d{2}\z"))
            & F.length(item["summary"]).between(80, 280)
            & item["tag"].isin(*C.DIGEST_TAGS)
            & item["relevance_score"].between(0.0, 1.0)
            & F.length(item["selection_reason"]).between(1, 300),
            F.lit(False),
        ),
    )
    return (
        F.length(output["digest_title"]).between(1, 200)
        & F.size(items).between(1, C.DIGEST_MAX_ITEMS) & good
        & (F.size(F.array_distinct(ids)) == F.size(ids))
    )


def invoice_output_rules(output: Column) -> Column:
    """Ranges of an invoice extraction."""
    known = F.array(*[F.lit(name) for name in C.INVOICE_REQUIRED])
    return (
        output["document_type"].isin("invoice", "not_invoice", "uncertain")
        & output["confidence"].between(0.0, 1.0)
        & (F.size(F.array_except(output["missing_fields"], known)) == 0)
        & output["notes"].isNotNull()
    )


def lead_output_rules(output: Column) -> Column:
    """Ranges of lead signals."""
    known = F.array(*[F.lit(name) for name in C.LEAD_MISSING_INFORMATION])
    missing = output["missing_information"]
    good = (
        F.length(output["summary"]).between(1, 400) & output["confidence"].between(0.0, 1.0)
        & (F.size(F.array_except(missing, known)) == 0)
        & (F.size(F.array_distinct(missing)) == F.size(missing))
    )
    for field, values in C.LEAD_ENUMS.items():
        good = good & output[field].isin(*values)
    return good


def model_or_default(column: str = "model") -> Column:
    """Model name with its default."""
    return or_default(column, C.DIGEST_MODEL)
