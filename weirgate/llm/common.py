"""What the operators share on the Spark side."""

from __future__ import annotations

import contextlib
import ctypes
import inspect
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Stands for a null id inside the operators: the smallest long, given back as null.
NO_ID = -(1 << 63)
#: Bytes of text that a task works on at a time.
PIECE = 1 << 20
#: The same for work on every word or shingle, whose arrays weigh tens of times the text.
SMALL_PIECE = 1 << 18


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the id (``d``, null as ``NO_ID``) and the text (null as empty), whatever else the table holds."""
    return docs.select(F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID)).alias("d"),
                       F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))


def real_id(column: str = "d") -> Column:
    """The id as it was given."""
    return F.when(F.col(column) != NO_ID, F.col(column))


def pieces(batches: Iterator[pa.RecordBatch], column: str | int = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(column)
        wide = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
        offsets = np.frombuffer(values.buffers()[1], np.int64 if wide else np.int32)
        offsets = offsets[values.offset:values.offset + len(values) + 1].astype(np.int64)
        first = 0
        while first < batch.num_rows:
            stop = max(int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1, first + 1)
            yield batch.slice(first, stop - first)
            first = stop
    give_back()


def give_back() -> None:
    """Hand freed memory back to the system: a worker stays for other tasks, and what it once needed would stay with it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps what it has
        ctypes.CDLL(None).malloc_trim(0)


def by_groups(work: Callable, every: int = 64, size: int = SMALL_PIECE) -> Callable:
    """A function of groups (of one side or two) that hands memory back from time to time: after so many groups, or so many bytes of
    them. A task may have few groups, and what they took would stay in its worker."""
    calls, seen = [0], [0]

    def done(made: pa.Table, given: int) -> pa.Table:
        calls[0] += 1
        seen[0] += given
        if calls[0] % every == 0 or seen[0] >= size:
            seen[0] = 0
            give_back()
        return made

    if len(inspect.signature(work).parameters) == 1:
        return lambda table: done(work(table), table.nbytes)
    return lambda left, right: done(work(left, right), left.nbytes + right.nbytes)


def mapped(frame: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
           column: str = "text", limit: int = PIECE, after: Callable[[], None] | None = None) -> DataFrame:
    """``frame`` through ``work``, which sees slices of bounded size. ``after`` is called at a task's end, before memory is
    handed back: Spark takes its idle workers in turn, so each of them keeps what any task has left."""

    def run(batches):
        for piece in pieces(batches, column, limit):
            made = work(piece)
            if made is not None and made.num_rows:
                yield made
        if after is not None:
            after()
            give_back()

    return frame.mapInArrow(run, schema)


def free_name(taken: list[str], name: str) -> str:
    """``name``, or the first of its numbered forms that is not taken; upper and lower case are one."""
    held = {one.lower() for one in taken}
    return next(one for one in itertools.chain([name], (f"{name}_{k}" for k in itertools.count(1))) if one.lower() not in held)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([value if isinstance(value, pa.Array) else pa.array(value)
                                       for value in columns.values()], names=list(columns))
