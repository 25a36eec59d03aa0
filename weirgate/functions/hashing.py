"""SHA-256 keys (H6)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def url_hash(canonical_url: Column) -> Column:
    """Key of a canonical URL."""
    return F.sha2(canonical_url, 256)


def content_hash(normalized_title: Column, summary: Column) -> Column:
    """Exact-match key of a title and its summary."""
    return F.sha2(F.concat(normalized_title, F.lit("\n"), summary), 256)


def file_hash(content: Column) -> Column:
    """Key of a file's bytes."""
    return F.sha2(content, 256)


def body_validator(body: Column) -> Column:
    """Quoted validator of a landed feed body: first 16 hex digits of its hash."""
    return F.concat(F.lit('"'), F.substring(F.sha2(body, 256), 1, 16), F.lit('"'))
