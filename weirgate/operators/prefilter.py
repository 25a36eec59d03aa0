"""A Bloom filter of a small batch's keys, applied to a large stored side before that side is shuffled.

A join of a small batch with a large table shuffles the table whole, though few of its rows have a key of the batch. ``only_likely``
builds a filter of the batch's keys and keeps the rows of the table whose key it may hold: all that can join, and about one other in
a hundred. What follows is the same join as before. The filter is sized by the number of keys. It is built by tasks, each for
the keys of one slice, as an array of 64-bit words; slices are broadcast and tested with built-in expressions, so the large side never
leaves the JVM. Beyond ``MOST_KEYS`` keys the batch is no small one: the table is returned as it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weirgate.functions.bloom import PROBES, bits_for
from weirgate.session import cut_lineage

#: 40 MB of filter, in slices of 1.25 MB.
MOST_KEYS, SLICE_KEYS = 32_000_000, 1_000_000


def _hash(keys: list[str | Column]) -> Column:
    """A hash of the key; null where a part of it is null, which joins with nothing."""
    columns = [F.col(key) if isinstance(key, str) else key for key in keys]
    some = columns[0].isNotNull()
    for column in columns[1:]:
        some = some & column.isNotNull()
    return F.when(some, F.xxhash64(*columns))


def _places(hash_: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(hash_, F.lit(probe)), F.lit(bits)) for probe in range(PROBES)]


def key_filter(batch: DataFrame, keys: list[str | Column]) -> tuple[int, int, DataFrame] | None:
    """Slices, bits of each and the filter of the distinct ``keys`` of a batch as ``_slice, words``; None for too many keys."""
    hashed = batch.select(_hash(keys).alias("_hash")).where("_hash is not null").distinct()
    count = hashed.count()
    if count > MOST_KEYS:
        return None
    slices = max(-(-count // SLICE_KEYS), 1)
    bits = bits_for(-(-count // slices))

    def packed(table: pa.Table) -> pa.Table:
        held = np.zeros(bits, np.uint8)
        held[table.column("place").to_numpy()] = 1
        words = np.packbits(held, bitorder="little").view(np.int64)
        return pa.table({"_slice": table.column("_slice").slice(0, 1), "words": pa.array([words], pa.list_(pa.int64()))})

    placed = hashed.select(F.pmod("_hash", F.lit(slices)).cast("int").alias("_slice"),
                           F.explode(F.array(*_places(F.col("_hash"), bits))).alias("place"))
    return slices, bits, cut_lineage(placed.groupBy("_slice").applyInArrow(packed, "_slice int, words array<bigint>"))


def only_likely(stored: DataFrame, batch: DataFrame, *keys: tuple[list[str | Column], list[str | Column]]) -> DataFrame:
    """The rows of ``stored`` that may have a key in common with ``batch``.

    Each of ``keys`` is a pair: the columns in ``stored`` and those in ``batch`` (of the same types); a row stays if any pair may match.
    """
    rows, kept = stored, None
    for number, (theirs, ours) in enumerate(keys):
        found = key_filter(batch, ours)
        if found is None:
            return stored
        slices, bits, filters = found
        hash_, slice_, words = (f"_{name}_{number}" for name in ("hash", "slice", "words"))
        rows = rows.withColumn(hash_, _hash(theirs)).withColumn(slice_, F.pmod(F.col(hash_), F.lit(slices)).cast("int")).join(
            F.broadcast(filters.withColumnsRenamed({"_slice": slice_, "words": words})), slice_, "left")
        likely = F.col(words).isNotNull()
        for place in _places(F.col(hash_), bits):
            word = F.get(F.col(words), F.floor(place / 64).cast("int"))
            likely = likely & (F.call_function("shiftright", word, (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
        kept = likely if kept is None else kept | likely
    return rows.where(F.coalesce(kept, F.lit(False))).select(*[F.col(f"`{name}`") for name in stored.columns])
