"""One row per key, ready to be looked up by a side with hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def one_per_key(rows: DataFrame, keys: list[str | Column], *aggregates: Column) -> DataFrame:
    """Reduce ``rows`` to one row per key for a join on these keys; without aggregates, the distinct keys.

    A plain group would leave its result partitioned by the key and sit in the same stage as the join, and the adaptive
    skew join splits a hot partition only where both inputs come straight from a shuffle. Grouping by the key and its
    hash gives the same groups in another partitioning, so the join shuffles the small reduced side once more and the
    hot partitions of the other side can be split. Small tables are broadcast as usual.
    """
    columns = [F.col(key) if isinstance(key, str) else key for key in keys]
    spread = F.xxhash64(*columns).alias("_spread")
    if not aggregates:
        return rows.select(*columns, spread).distinct().drop("_spread")
    return rows.groupBy(*columns, spread).agg(*aggregates).drop("_spread")
