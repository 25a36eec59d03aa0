"""Removal of repeated word passages by a compacted De Bruijn graph.

Every window of ``width`` consecutive words is an edge of the graph (its nodes are the windows one word shorter). A
window's anchor, the short word gram of smallest hash in it, depends on its words alone, so equal edges have equal
anchors. Consecutive edges with one anchor form a path. Where the corpus runs through an anchor along one and the same
path, the path does not branch: it stays compact, and one row stands for all its edges. Only where an anchor has several
paths are these resolved into single edges, from the source occurrence of each path. Joins on the hashes of paths and
edges find the source coordinates, (document, start, version), and these decide: an occurrence that is not the source goes.

Scale: see ``passages``; the joins see rows of repeated paths only, one per group of documents, with map-side aggregates
before them, so hot passages stay small. Paths and edges are told apart by two 64-bit hashes of
different bases; words of any length are hashed block by block (see ``kernels.range_hashes``).

Null text has no words. A null id counts as the smallest id. Rows that share an id but not the text are documents of
their own: a window goes where an equal one has a smaller (id, start, version), see ``passages``. One row for each row given; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirgate.llm.common import batch, documents, real_id
from weirgate.llm.kernels import flat, kept_text, merged, range_hashes, rolling_hashes, signed, unsigned, words
from weirgate.llm.passages import (
    Windows, as_table, distinct_runs, group_count, grouped, ids_of, repeated_runs, rows_at, text_of,
    versions_of,
)

WIDTH = 20
GRAM = 8

_EDGES = "g long, d long, v long, start int, anchor long, edge long, later boolean"
_RESULT = "d long, n_words long, n_removed long, kept_sha256 string, n_spans long, kept_text string"


def word_symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(texts)
    starts, ends, bounds = words(data, offsets)
    return range_hashes(data, starts, ends), bounds


def _resolved(windows: Windows):
    """Single edges of the paths whose source is in the group."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            none = pa.array([], pa.int64())
            return as_table(batch(g=none, d=none, v=none, start=pa.array([], pa.int32()), anchor=none, edge=none,
                                  later=pa.array([], pa.bool_())))
        symbols, bounds = windows.symbols(text_of(left))
        d, v = ids_of(left), versions_of(left)
        owner, row = rows_at(right, d, v)
        edges = right.column("edges").to_numpy()[row].astype(np.int64)
        start = right.column("start").to_numpy()[row]
        first = bounds[owner] + start
        fits = first + edges + windows.width - 1 <= bounds[owner + 1]
        owner, row, edges, first = owner[fits], row[fits], edges[fits], first[fits]
        place = np.arange(int(edges.sum())) - np.repeat(np.cumsum(edges) - edges, edges) + np.repeat(first, edges)
        owner = np.repeat(owner, edges)
        anchor = np.repeat(right.column("anchor").to_numpy()[row], edges)
        edge = rolling_hashes(symbols, windows.width)[place] if len(place) else np.zeros(0, np.uint64)
        start = place - bounds[owner]
        _, _, later, _ = distinct_runs(d[owner], v[owner], start, unsigned(anchor), edge)
        return as_table(batch(g=np.full(len(place), left.column("g")[0].as_py(), np.int64), d=d[owner],
                              v=v[owner], start=start.astype(np.int32), anchor=anchor, edge=signed(edge), later=later))

    return work


def _removed(windows: Windows, with_text: bool):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            none = pa.array([], pa.int64())
            return as_table(batch(d=none, n_words=none, n_removed=none, kept_sha256=pa.array([], pa.string()),
                                  n_spans=none, kept_text=pa.array([], pa.string())))
        texts, d = text_of(left), ids_of(left)
        data, offsets = flat(texts)
        starts, ends, bounds = words(data, offsets)
        runs = windows.runs(texts)
        some = np.arange(len(runs["anchor"]))
        _, _, later, _ = distinct_runs(d[runs["doc"]], versions_of(left)[runs["doc"]], runs["first"], runs["anchor"],
                                       windows.paths(runs, some))
        first = runs["start"][later]
        last = first + runs["count"][later] + windows.width - 1
        if right.num_rows:
            owner, row = rows_at(right, d, versions_of(left))
            begin = bounds[owner] + right.column("start").to_numpy()[row]
            end = np.minimum(begin + right.column("edges").to_numpy()[row] + windows.width - 1, bounds[owner + 1])
            first, last = np.concatenate((first, begin)), np.concatenate((last, end))
        first, last = merged(first, last)
        marks = np.zeros(len(starts) + 1, np.int64)
        np.add.at(marks, first, 1)
        np.add.at(marks, last, -1)
        keep = np.cumsum(marks[:-1]) == 0
        out, places = kept_text(data, starts, ends, bounds, keep)
        kept = [out[a:max(b - 1, a)].tobytes() for a, b in zip(places[:-1], places[1:])]
        count = np.diff(bounds)
        left_over = np.diff(np.concatenate(([0], np.cumsum(keep)))[bounds])
        edge = keep.copy()
        edge[1:] = keep[1:] | ~keep[:-1]
        edge[bounds[:-1][count > 0]] = keep[bounds[:-1][count > 0]]
        spans = np.diff(np.concatenate(([0], np.cumsum(~edge)))[bounds])
        return as_table(batch(d=d, n_words=count, n_removed=count - left_over,
                              kept_sha256=pa.array([hashlib.sha256(one).hexdigest() for one in kept]), n_spans=spans,
                              kept_text=pa.array([one.decode() if with_text else None for one in kept], pa.string())))

    return work


def remove_repeated_passages(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, with_text: bool = True,
                             id_column: str = "doc_id", text_column: str = "text",
                             groups: int | None = None) -> DataFrame:
    """Each document without the words of ``width``-word windows that start earlier somewhere.

    Columns: ``doc_id, n_words, n_removed, kept_sha256, n_spans`` (maximal removed runs of words) and ``kept_text``
    (null unless ``with_text``). Windows are judged on the input, not on what is left.
    """
    windows = Windows(word_symbols, width, gram)
    groups = groups or group_count(docs)
    texts = grouped(docs, id_column, text_column, groups)
    paths = repeated_runs(texts, windows, groups).drop("n")
    place = F.struct("d", "start", "v")
    sources = paths.groupBy("anchor", "path").agg(F.min(place).alias("source"))
    branching = sources.groupBy("anchor").agg(F.count(F.lit(1)).alias("paths")).filter("paths > 1").select("anchor")
    known = paths.join(sources, ["anchor", "path"])
    copies = known.filter(place > F.col("source")).select("g", "d", "v", "start", "edges")
    own = known.filter(place == F.col("source")).join(branching, "anchor", "left_semi").select("g", "d", "v", "start", "edges", "anchor")
    edges = texts.groupBy("g").cogroup(own.groupBy("g")).applyInArrow(_resolved(windows), _EDGES)
    first = edges.groupBy("anchor", "edge").agg(F.min(place).alias("source"))
    single = edges.join(first, ["anchor", "edge"]).filter(F.col("later") | (place > F.col("source"))).select(
        "g", "d", "v", "start", F.lit(1).alias("edges"))
    spans = copies.unionByName(single)
    done = texts.groupBy("g").cogroup(spans.groupBy("g")).applyInArrow(_removed(windows, with_text), _RESULT)
    return done.select(real_id().alias("doc_id"), "n_words", "n_removed", "kept_sha256", "n_spans", "kept_text")


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeated_passages(documents(spark, sf_dir), with_text=False).drop("kept_text")
