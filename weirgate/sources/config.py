"""Versioned configuration files: feed sources (A5) and the topic profile.

Both are small hand-written files, read once by the driver and turned into rows or literals. With a session, paths of any store that
Spark can read will do.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

from weirgate import schemas

#: Fixed defaults and ceilings of the source list.
DEFAULT_MAX_ITEMS, MAX_ITEMS_CEILING = 20, 50
DEFAULT_TIMEOUT_SECONDS, TIMEOUT_CEILING = 15, 60


@dataclass(frozen=True)
class TopicProfile:
    """Keywords and length floors used by the news pre-filter."""

    include_keywords: tuple[str, ...]
    exclude_keywords: tuple[str, ...] = ()
    min_title_length: int = 12
    min_summary_length: int = 40
    name: str = "profile"

    def __post_init__(self) -> None:
        for field in ("include_keywords", "exclude_keywords"):
            words = tuple(word.strip().lower() for word in getattr(self, field) if word.strip())
            object.__setattr__(self, field, words)
        if not self.include_keywords:
            raise ValueError("a topic profile needs at least one include keyword")
        if not (1 <= self.min_title_length <= 500 and 1 <= self.min_summary_length <= 12_000):
            raise ValueError("length floors are out of range")


def _text(path: str, spark: SparkSession | None) -> str:
    """The file's text; with a session, also that of a folder with one file."""
    if spark is None or Path(path).is_file():
        return Path(path).read_text(encoding="utf-8")
    return spark.read.text(path, wholetext=True).first()[0]


def _load(path: str, known: set[str], spark: SparkSession | None = None) -> dict:
    data = yaml.safe_load(_text(path, spark))
    if not isinstance(data, dict) or data.get("version") != 1 or set(data) - known:
        raise ValueError(f"{path}: not a version 1 configuration")
    return data


def load_topic_profile(path: str, spark: SparkSession | None = None) -> TopicProfile:
    """Read a topic profile; unknown keys are an error."""
    fields = {"name", "include_keywords", "exclude_keywords", "min_title_length", "min_summary_length"}
    data = _load(path, fields | {"version"}, spark)
    lists = {key: tuple(data.get(key) or ()) for key in ("include_keywords", "exclude_keywords")}
    rest = {key: data[key] for key in fields - set(lists) if key in data}
    return TopicProfile(**lists, **rest)


def load_source_config(spark: SparkSession, path: str) -> DataFrame:
    """Configured sources with defaults applied, keys normalised and unique."""
    data = _load(path, {"version", "defaults", "sources"}, spark)
    defaults = data.get("defaults") or {}
    rows, seen = [], set()
    for source in data["sources"]:
        unknown = set(source) - {
            "key", "name", "url", "allowed_host", "category", "language", "enabled", "priority",
            "max_items_per_run", "request_timeout_seconds",
        }
        key = source["key"].strip().lower()
        priority = Decimal(str(source.get("priority", "5.00")))
        items = source.get("max_items_per_run", defaults.get("max_items_per_run", DEFAULT_MAX_ITEMS))
        timeout = source.get(
            "request_timeout_seconds", defaults.get("request_timeout_seconds", DEFAULT_TIMEOUT_SECONDS))
        if unknown or key in seen or not 0 <= priority <= 10:
            raise ValueError(f"{path}: source {key!r} breaks the source contract")
        if not (1 <= items <= MAX_ITEMS_CEILING and 1 <= timeout <= TIMEOUT_CEILING):
            raise ValueError(f"{path}: limits of source {key!r} are out of range")
        seen.add(key)
        rows.append((
            key, source["name"].strip(), source["url"], source["allowed_host"].strip().lower().rstrip("."),
            source["category"].strip(), source.get("language", "en").strip().lower(),
            source.get("enabled", defaults.get("enabled", True)), priority.quantize(Decimal("0.01")), items, timeout,
        ))
    if not rows:
        raise ValueError(f"{path}: no sources")
    return spark.createDataFrame(rows, schemas.FEED_SOURCE)
