"""Redaction of structured log events."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weirgate import constants as C
from weirgate.functions.text import strip


def is_secret_key(key: Column) -> Column:
    """True when a key names a secret, with ``-`` and ``_`` treated alike."""
    name = F.replace(F.lower(key), F.lit("-"), F.lit("_"))
    found = F.lit(False)
    for fragment in C.SECRET_KEY_FRAGMENTS:
        found = found | F.contains(name, F.lit(fragment))
    return found


def sanitize_log_text(value: Column) -> Column:
    """One blank for each run of control characters, trimmed."""
    return strip(F.regexp_replace(value, r"[\x00-\x1f\x7f]+", " "))


def redact_event(event: Column) -> Column:
    """Hide secrets and content in a ``map<string,string>``; clean all other values."""
    return F.transform_values(
        event,
        lambda key, value: F.when(is_secret_key(key) | F.lower(key).isin(*C.CONTENT_KEYS), F.lit("***"))
        .otherwise(sanitize_log_text(value)),
    )
