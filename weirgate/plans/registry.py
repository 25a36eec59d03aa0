"""Queries of the library over the given tables, each with the SQL that checks it where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    """A query and its check; ``sql`` is None where only the rows can be looked at."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def all_queries() -> dict[str, Query]:
    """Every registered query by name."""
    from weirgate.plans import digests, invoices, leads, lifecycle, loaders, news, operations, streams

    found: dict[str, Query] = {}
    for module in (news, invoices, leads, digests, operations, lifecycle, loaders, streams):
        for name, entry in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = entry
    return found
