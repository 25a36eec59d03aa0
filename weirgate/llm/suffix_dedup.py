"""Removal of byte passages that occur elsewhere, by suffix arrays.

A byte goes if a string of ``width`` bytes covers it that also starts anywhere else. Windows are found as in ``passages``: runs
of windows with one anchor, of which those whose whole content occurs again are settled by their hashes. What is left are
the runs whose anchor stands in different surroundings: their texts are dealt into shards by anchor, so equal windows meet.
Each shard gets a suffix array (Larsson-Sadakane refinement) and common prefixes (Kasai), and windows that share ``width``
bytes with a neighbour are repeated. An anchor with more than ``SHARD_RUNS`` different surroundings is spread over several
shards by its surroundings' hash; these are merged afterwards: each sends the sorted fingerprints of its distinct windows, cut
into as many ranges as there are shards, and binary search finds those that another shard holds, too.

Matches never cross documents and strings are judged on the input. Null text is empty. Rows that share an id but not the
text are documents of their own, see ``passages``; rows with equal id and text count once. One row for each row given; extra columns are ignored. A cut inside a
character leaves single bytes of it, so the remaining text is given as bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirgate.llm.common import batch, documents, real_id
from weirgate.llm.kernels import FIRST, flat, merged, rolling_hashes
from weirgate.llm.passages import (
    Windows, as_table, distinct_runs, group_count, grouped, ids_of, repeated_runs, rows_at, text_of,
    versions_of,
)
from weirgate.llm.suffixes import found_in, repeated_windows

WIDTH = 400
GRAM = 64
SHARD_RUNS = 8_192

_SEGMENTS = "shard long, part int, parts int, g long, d long, v long, start int, edges int, whole boolean, bytes binary"
_SPANS = "g long, d long, v long, start int, edges int"
_PIECES = _SPANS + ", shard long, range int, part int, prints binary, run binary, place binary, runs binary"
_RESULT = "d long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
_RUN = np.dtype([("g", np.int64), ("d", np.int64), ("v", np.int64), ("start", np.int64)])


def _segments(windows: Windows):
    """The texts of runs."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("shard", "part", "parts", "g", "d", "v", "start", "edges", "whole")
        if not left.num_rows or not right.num_rows:
            empty = right.slice(0, 0)
            return empty.select(list(names)).append_column("bytes", pa.array([], pa.binary()))
        data, bounds = windows.symbols(text_of(left))
        owner, row = rows_at(right, ids_of(left), versions_of(left))
        first = bounds[owner] + right.column("start").to_numpy()[row]
        last = first + right.column("edges").to_numpy()[row] + windows.width - 1
        fits = last <= bounds[owner + 1]
        raw = memoryview(data.tobytes())
        chosen = right.select(list(names)).take(pa.array(row[fits]))
        cut = [bytes(raw[a:b]) for a, b in zip(first[fits].tolist(), last[fits].tolist())]
        return chosen.append_column("bytes", pa.array(cut, pa.binary()))

    return work


class _Shard:
    """Windows of a shard's runs and which of them are repeated inside it."""

    def __init__(self, table: pa.Table, width: int):
        column = table.column("bytes").combine_chunks()
        self.data, bounds = flat(column)
        self.g, self.d, self.v = (table.column(name).to_numpy() for name in ("g", "d", "v"))
        self.start, self.edges = table.column("start").to_numpy().astype(np.int64), table.column("edges").to_numpy()
        self.run = np.repeat(np.arange(len(self.edges)), self.edges)
        self.inner = np.arange(len(self.run)) - np.repeat(np.cumsum(self.edges) - self.edges, self.edges)
        self.at = bounds[self.run] + self.inner
        self.kind, _ = repeated_windows(self.data, self.at, width)
        self.whole = table.column("whole").to_numpy(zero_copy_only=False).astype(bool)[self.run]
        # A class is repeated if it has two coordinates, or a run of it is known to occur twice.
        place = self.start[self.run] + self.inner
        order = np.lexsort((place, self.v[self.run], self.d[self.run], self.kind))
        kind, d, v, place = self.kind[order], self.d[self.run][order], self.v[self.run][order], place[order]
        other = np.zeros(len(order), bool)
        other[1:] = (kind[1:] == kind[:-1]) & (
            (d[1:] != d[:-1]) | (v[1:] != v[:-1]) | (place[1:] != place[:-1]))
        several = np.zeros(len(self.data) + 1, bool)
        several[kind[other]] = True
        several[self.kind[self.whole]] = True
        self.repeated = several[self.kind]

    def spans(self, hit: np.ndarray) -> pa.RecordBatch:
        """Consecutive windows as spans."""
        index = np.flatnonzero(hit)
        fresh = np.ones(len(index), bool)
        fresh[1:] = (np.diff(index) != 1) | (self.run[index[1:]] != self.run[index[:-1]])
        heads = np.flatnonzero(fresh)
        run, inner = self.run[index[heads]], self.inner[index[heads]]
        count = np.diff(np.append(heads, len(index)))
        return batch(g=self.g[run], d=self.d[run], v=self.v[run], start=(self.start[run] + inner).astype(np.int32),
                     edges=count.astype(np.int32))


def _in_shard(width: int):
    def work(table: pa.Table) -> pa.Table:
        shard = _Shard(table, width)
        return as_table(shard.spans(shard.repeated & ~shard.whole))

    return work


def _pieces(width: int):
    """Spans repeated inside the shard (without ``prints``), and the distinct windows by range."""

    def work(table: pa.Table) -> pa.Table:
        shard = _Shard(table, width)
        parts = int(table.column("parts")[0].as_py())
        inside = shard.spans(shard.repeated & ~shard.whole)
        count = inside.num_rows
        name = [field.name for field in _schema(_PIECES)]
        blank = {"shard": pa.nulls(count, pa.int64()), "range": pa.nulls(count, pa.int32()),
                 "part": pa.nulls(count, pa.int32()), **{key: pa.nulls(count, pa.binary()) for key in name[8:]}}
        found = pa.table({**{key: inside.column(key) for key in name[:5]}, **blank})
        # One print for each distinct window; the place of those that are not repeated so far, -1 for the others.
        _, first = np.unique(shard.kind, return_index=True)
        prints = rolling_hashes(shard.data, width, FIRST)[shard.at[first]]
        order = np.argsort(prints)
        first, prints = first[order], prints[order]
        run = np.where(shard.repeated[first], -1, shard.run[first]).astype(np.int32)
        place = shard.inner[first].astype(np.int32)
        cuts = np.searchsorted(prints, np.array([(k << 64) // parts for k in range(parts)], np.uint64))
        cuts = np.append(cuts, len(prints))
        runs = np.empty(len(shard.d), _RUN)
        runs["g"], runs["d"], runs["v"], runs["start"] = shard.g, shard.d, shard.v, shard.start
        rows = {key: [] for key in ("range", "prints", "run", "place", "runs")}
        for number in range(parts):
            some = slice(cuts[number], cuts[number + 1])
            used, own = np.unique(run[some], return_inverse=True)
            own = own.astype(np.int32) - (1 if len(used) and used[0] < 0 else 0)
            rows["range"].append(number)
            rows["prints"].append(prints[some].tobytes())
            rows["run"].append(own.tobytes())
            rows["place"].append(place[some].tobytes())
            rows["runs"].append(runs[used[used >= 0]].tobytes())
        blank = {**{key: pa.nulls(parts, pa.int64()) for key in ("g", "d", "v")},
                 **{key: pa.nulls(parts, pa.int32()) for key in ("start", "edges")}}
        sent = pa.table({**blank, "shard": pa.array([table.column("shard")[0].as_py()] * parts, pa.int64()),
                         "range": pa.array(rows["range"], pa.int32()),
                         "part": pa.array([table.column("part")[0].as_py()] * parts, pa.int32()),
                         **{key: pa.array(rows[key], pa.binary()) for key in ("prints", "run", "place", "runs")}})
        return pa.concat_tables([found, sent])

    return work


def _schema(text: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (one.split() for one in text.split(", "))])


def _between_shards(table: pa.Table) -> pa.Table:
    """Windows of one range that another shard holds, too."""
    columns = {name: table.column(name).to_pylist() for name in ("prints", "run", "place", "runs")}
    prints = [np.frombuffer(one, np.uint64) for one in columns["prints"]]
    every = np.sort(np.concatenate(prints))
    common = np.unique(every[1:][every[1:] == every[:-1]])  # each shard sends a window once
    out = []
    for own, run, place, runs in zip(prints, columns["run"], columns["place"], columns["runs"]):
        run = np.frombuffer(run, np.int32)
        hit = found_in(common, own) & (run >= 0)
        where = np.frombuffer(runs, _RUN)[run[hit]]
        out.append(batch(g=where["g"].copy(), d=where["d"].copy(), v=where["v"].copy(),
                         start=(where["start"] + np.frombuffer(place, np.int32)[hit]).astype(np.int32),
                         edges=np.ones(int(hit.sum()), np.int32)))
    return as_table(*out)


def _removed(windows: Windows, with_text: bool):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _schema(_RESULT).empty_table()
        texts, d = text_of(left), ids_of(left)
        runs = windows.runs(texts)
        data, bounds = runs["symbols"], runs["bounds"]
        some = np.arange(len(runs["anchor"]))
        _, _, _, several = distinct_runs(d[runs["doc"]], versions_of(left)[runs["doc"]], runs["first"], runs["anchor"],
                                         windows.paths(runs, some))
        first = runs["start"][several]
        last = first + runs["count"][several] + windows.width - 1
        if right.num_rows:
            owner, row = rows_at(right, d, versions_of(left))
            begin = bounds[owner] + right.column("start").to_numpy()[row]
            end = np.minimum(begin + right.column("edges").to_numpy()[row] + windows.width - 1, bounds[owner + 1])
            first, last = np.concatenate((first, begin)), np.concatenate((last, end))
        # Spans of different documents must not become one.
        owner = np.searchsorted(bounds, first, "right") - 1
        first, last = merged(first + owner, last + owner)
        owner = np.searchsorted(bounds + np.arange(len(bounds)), first, "right") - 1
        first, last = first - owner, last - owner
        spans = np.bincount(owner, minlength=len(d))
        gone = np.bincount(owner, last - first, minlength=len(d)).astype(np.int64)
        raw = memoryview(data.tobytes())
        heads = np.searchsorted(owner, np.arange(len(d) + 1))
        kept = []
        for k in range(len(d)):
            place, parts = int(bounds[k]), []
            for a, b in zip(first[heads[k]:heads[k + 1]].tolist(), last[heads[k]:heads[k + 1]].tolist()):
                parts.append(raw[place:a])
                place = b
            parts.append(raw[place:int(bounds[k + 1])])
            kept.append(b"".join(parts))
        return as_table(batch(d=d, n_bytes=np.diff(bounds), n_removed=gone, n_spans=spans,
                              kept_sha256=pa.array([hashlib.sha256(one).hexdigest() for one in kept]),
                              kept=pa.array([one if with_text else None for one in kept], pa.binary())))

    return work


def remove_repeated_bytes(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, shard_runs: int = SHARD_RUNS,
                          with_text: bool = True, id_column: str = "doc_id", text_column: str = "text",
                          groups: int | None = None) -> DataFrame:
    """Each document without the bytes of ``width``-byte strings that also start elsewhere.

    Columns: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and ``kept`` (bytes; null unless ``with_text``).
    """
    windows = Windows(flat, width, gram)
    groups = groups or group_count(docs)
    texts = grouped(docs, id_column, text_column, groups)
    runs = repeated_runs(texts, windows, groups)
    paths = runs.groupBy("anchor", "path").agg(F.sum("n").alias("places"), F.min(F.struct("d", "start", "v")).alias("source"))
    kinds = paths.groupBy("anchor").agg(F.count(F.lit(1)).alias("paths")).filter("paths > 1")
    twice = runs.join(paths.filter("places > 1").select("anchor", "path"), ["anchor", "path"]).select(
        "g", "d", "v", "start", "edges")
    sources = runs.join(paths, ["anchor", "path"]).filter(F.struct("d", "start", "v") == F.col("source")).join(kinds, "anchor")
    parts = F.ceil(F.col("paths") / F.lit(shard_runs)).cast("int")
    own = sources.select(
        F.when(parts > 1, F.col("anchor")).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(groups))).alias("shard"),
        F.when(parts > 1, F.pmod(F.xxhash64("path"), parts)).otherwise(F.lit(0)).cast("int").alias("part"),
        parts.alias("parts"), "g", "d", "v", "start", "edges", F.expr("places > 1").alias("whole"))

    def cut(some: DataFrame) -> DataFrame:
        return texts.groupBy("g").cogroup(some.groupBy("g")).applyInArrow(_segments(windows), _SEGMENTS)

    single = cut(own.filter("parts = 1")).groupBy("shard").applyInArrow(_in_shard(width), _SPANS)
    spread = cut(own.filter("parts > 1")).groupBy("shard", "part").applyInArrow(_pieces(width), _PIECES)
    inside = spread.filter("prints is null").select("g", "d", "v", "start", "edges")
    between = (spread.filter("prints is not null").groupBy("shard", "range")
               .applyInArrow(_between_shards, _SPANS))
    spans = twice.unionByName(single).unionByName(inside).unionByName(between)
    done = texts.groupBy("g").cogroup(spans.groupBy("g")).applyInArrow(_removed(windows, with_text), _RESULT)
    return done.select(real_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(documents(spark, sf_dir), with_text=False).drop("kept")
