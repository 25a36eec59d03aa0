"""Lead request payloads (A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirgate import schemas
from weirgate.functions.text import strip


def read_lead_requests(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """JSON payloads with a fixed schema; unreadable rows keep their text in ``_corrupt_record``."""
    extra = [T.StructField(name, T.StringType()) for name in ("header_key", "_corrupt_record")]
    schema = T.StructType(schemas.LEAD_REQUEST.fields + extra)
    reader = spark.readStream if stream else spark.read
    return with_idempotency_key(
        reader.schema(schema).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    )


def with_idempotency_key(requests: DataFrame) -> DataFrame:
    """Key from the request header, else from the body; blank counts as absent."""
    present = [F.nullif(strip(name), F.lit("")) for name in ("header_key", "idempotency_key")]
    return requests.withColumn("idempotency_key", F.coalesce(*present))
