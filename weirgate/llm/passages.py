"""What the two passage operators share: documents in groups, and the runs of windows that occur more than once.

Documents are dealt into groups of a few hundred by their id and text, and all steps that need texts work on whole groups, so one
shuffle of the texts serves every step. To find anchors that occur more than once, each group sends its distinct anchors
once (packed by bucket) and gets back those that others have, too. Only runs with such an anchor become rows, one for each
distinct run and group: a passage that a third of all documents share costs a row per group, not per document.

Coordinates are (id, start, version), in this order, where the version ``v`` is a hash of the text: rows that share an id (or have
none) but not the text are documents of their own, dealt into groups by both, so a hot id is spread. Rows with equal id and text
are in one group, and their equal coordinates count once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirgate.llm.common import batch, id_and_text
from weirgate.llm.kernels import SECOND, anchored_runs, flat, range_hashes, signed
from weirgate.session import cut_lineage

#: Documents in a group, on average.
GROUP_ROWS = 384

#: From texts to symbols (of any unsigned kind) and the bounds of each text's symbols.
Symbols = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]

_RUNS = "g long, d long, v long, start int, edges int, anchor long, path long, n int"


@dataclass(frozen=True)
class Windows:
    """Windows of ``width`` symbols, found by their anchor of ``gram`` symbols."""

    symbols: Symbols
    width: int
    gram: int

    def runs(self, texts: pa.Array) -> dict[str, np.ndarray]:
        """All runs of the texts with their symbols; ``first`` is a run's start in its document."""
        symbols, bounds = self.symbols(texts)
        runs = anchored_runs(symbols, bounds, self.width, self.gram)
        runs["symbols"], runs["bounds"] = symbols, bounds
        runs["first"] = runs["start"] - bounds[runs["doc"]]
        return runs

    def paths(self, runs: dict[str, np.ndarray], some: np.ndarray) -> np.ndarray:
        """A second, independent hash of the whole content of some runs."""
        start = runs["start"][some]
        return range_hashes(runs["symbols"], start, start + runs["count"][some] + self.width - 1, SECOND)


def group_count(docs: DataFrame) -> int:
    return max(docs.count() // GROUP_ROWS, 1)


def grouped(docs: DataFrame, id_column: str, text_column: str, groups: int) -> DataFrame:
    """Ids and texts with their version ``v`` and group ``g``."""
    return (id_and_text(docs, id_column, text_column).withColumn("v", F.xxhash64("text"))
            .withColumn("g", F.pmod(F.xxhash64("d", "v"), F.lit(groups))))


def text_of(table: pa.Table) -> pa.Array:
    column = table.column("text")
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def ids_of(table: pa.Table) -> np.ndarray:
    return table.column("d").to_numpy()


def versions_of(table: pa.Table) -> np.ndarray:
    return table.column("v").to_numpy()


def as_table(*batches: pa.RecordBatch) -> pa.Table:
    return pa.Table.from_batches(list(batches))


def distinct_runs(d: np.ndarray, v: np.ndarray, first: np.ndarray, anchor: np.ndarray, path: np.ndarray):
    """The earliest of equal runs and how many coordinates each has; for every run, whether it is a later one, and
    whether it has another place."""
    order = np.lexsort((v, first, d, path, anchor))
    if not len(order):
        return order, order, np.zeros(0, bool), np.zeros(0, bool)
    a, p, k, s, own_v = anchor[order], path[order], d[order], first[order], v[order]
    head = np.ones(len(order), bool)
    head[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1])
    place = head.copy()
    place[1:] |= (k[1:] != k[:-1]) | (s[1:] != s[:-1]) | (own_v[1:] != own_v[:-1])
    heads = np.flatnonzero(head)
    counts = np.add.reduceat(place.astype(np.int64), heads)
    own = np.cumsum(head) - 1
    later = np.zeros(len(order), bool)
    later[order] = (k != k[heads][own]) | (s != s[heads][own]) | (own_v != own_v[heads][own])
    several = np.zeros(len(order), bool)
    several[order] = (counts > 1)[own]
    return order[heads], counts, later, several


#: Groups for each bucket of anchors: a bucket then holds some millions of anchors, in one task.
BUCKET_GROUPS = 32


def repeated_runs(texts: DataFrame, windows: Windows, groups: int) -> DataFrame:
    """Distinct runs of each group whose anchor occurs more than once: ``g, d, v, start, edges, anchor, path, n``.

    ``d, start, v`` is the earliest place in the group, ``n`` the number of places in the group, ``edges`` the number of
    windows in the run. The rows are written once: what follows reads them several times.
    """
    spark = texts.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-groups // BUCKET_GROUPS))

    def offered(table: pa.Table) -> pa.Table:
        runs = windows.runs(text_of(table))
        anchors, first, counts = np.unique(runs["anchor"], return_index=True, return_counts=True)
        del first
        anchors = np.repeat(anchors, np.minimum(counts, 2))  # twice where the group alone repeats it
        bucket = (anchors >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        heads = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
        ends = np.append(heads[1:], len(anchors))
        return as_table(batch(
            bucket=bucket[heads].astype(np.int32), g=np.full(len(heads), table.column("g")[0].as_py(), np.int64),
            anchors=pa.array([anchors[a:b].tobytes() for a, b in zip(heads, ends)], pa.binary())))

    def answered(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(one, np.uint64) for one in table.column("anchors").to_pylist()]
        every = np.sort(np.concatenate(parts))
        repeated = np.unique(every[1:][every[1:] == every[:-1]])
        del every
        groups, sent = [], []
        for group, part in zip(table.column("g").to_pylist(), parts):
            place = np.searchsorted(repeated, part)
            place[place == len(repeated)] = 0
            hit = np.unique(part[repeated[place] == part]) if len(repeated) else part[:0]
            if len(hit):
                groups.append(group)
                sent.append(hit.tobytes())
        return as_table(batch(g=pa.array(groups, pa.int64()), anchors=pa.array(sent, pa.binary())))

    def found(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return as_table(_no_runs())
        runs = windows.runs(text_of(left))
        sent = right.column("anchors").to_pylist() if right.num_rows else []
        wanted = np.sort(np.concatenate([np.frombuffer(one, np.uint64) for one in sent])) if sent else None
        if wanted is None:
            return as_table(_no_runs())
        place = np.searchsorted(wanted, runs["anchor"])
        place[place == len(wanted)] = 0
        some = np.flatnonzero(wanted[place] == runs["anchor"])
        path = windows.paths(runs, some)
        d, v = ids_of(left)[runs["doc"][some]], versions_of(left)[runs["doc"][some]]
        best, counts, _, _ = distinct_runs(d, v, runs["first"][some], runs["anchor"][some], path)
        kept = some[best]
        return as_table(batch(
            g=np.full(len(kept), left.column("g")[0].as_py(), np.int64), d=d[best],
            v=v[best],
            start=runs["first"][kept].astype(np.int32), edges=runs["count"][kept].astype(np.int32),
            anchor=signed(runs["anchor"][kept]), path=signed(path[best]), n=counts.astype(np.int32)))

    offers = texts.groupBy("g").applyInArrow(offered, "bucket int, g long, anchors binary")
    answers = offers.groupBy("bucket").applyInArrow(answered, "g long, anchors binary")
    return cut_lineage(texts.groupBy("g").cogroup(answers.groupBy("g")).applyInArrow(found, _RUNS))


def _no_runs() -> pa.RecordBatch:
    return batch(g=pa.array([], pa.int64()), d=pa.array([], pa.int64()), v=pa.array([], pa.int64()), start=pa.array([], pa.int32()),
                 edges=pa.array([], pa.int32()), anchor=pa.array([], pa.int64()), path=pa.array([], pa.int64()),
                 n=pa.array([], pa.int32()))


def rows_at(table: pa.Table, d: np.ndarray, v: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For rows of ``table`` (with an id ``d``): the text each belongs to, once for every text with that id and, where
    versions are given, that version, as pairs (number of the text, number of the row)."""
    wanted = table.column("d").to_numpy()
    order = np.argsort(d, kind="stable")
    low, high = np.searchsorted(d[order], wanted, "left"), np.searchsorted(d[order], wanted, "right")
    count = high - low
    row = np.repeat(np.arange(len(wanted)), count)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    owner = order[low[row] + inner]
    if v is None:
        return owner, row
    same = table.column("v").to_numpy()[row] == v[owner]
    return owner[same], row[same]
