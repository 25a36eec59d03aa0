"""Packed id matrices: best-fit-decreasing packing with a segment tree over the remaining capacities.

Each task tokenises its documents, gathers them to a shard of ``shard_tokens`` and packs the shard: nothing is shuffled,
and memory holds one shard. A document longer than a row is cut without loss: whole rows first, then the rest, which is
packed with the other documents. Every row of the result is one sequence of the matrix:

``sequence_id``; ``n_tokens`` (without padding); ``ids`` (little-endian, two bytes each where the vocabulary allows, else
four, padded with ``pad_id`` to ``length``); ``cu_seqlens`` (from 0, cumulative lengths of the segments); ``positions``
(two or four bytes each, counting from 0 in each segment and in the padding); ``doc_ids`` and ``starts`` of the segments
(each segment's document, and its place among that document's ids).

Null and empty texts are the end id alone. Repeated rows are packed once each; null ids stay null; extra columns are
ignored. A task that runs again after its executor is lost gives the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weirgate.llm.common import NO_ID, documents, id_and_text, pieces
from weirgate.llm.kernels import lists
from weirgate.llm.pretokens import encoder
from weirgate.llm.token_counts import tokenizer_file

LENGTH = 1024
SHARD_TOKENS = 2 << 20
END_ID = 50_256
SCHEMA = ("sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, doc_ids array<long>, "
          "starts array<long>")


class CapacityTree:
    """How many bins have each remaining capacity, in a segment tree: finds the smallest capacity that fits."""

    def __init__(self, length: int):
        self.half = 1 << int(length).bit_length()
        self.counts = [0] * (2 * self.half)

    def change(self, capacity: int, by: int) -> None:
        node = capacity + self.half
        while node:
            self.counts[node] += by
            node >>= 1

    def smallest(self, size: int) -> int:
        """The smallest capacity of at least ``size`` that a bin has, -1 if none has."""
        node = size + self.half
        if self.counts[node]:
            return size
        while node > 1:
            if not node & 1 and self.counts[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return -1
        while node < self.half:
            node = 2 * node if self.counts[2 * node] else 2 * node + 1
        return node - self.half


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Items by bin: the longest first, each into the bin it fills best."""
    tree, bins, open_ = CapacityTree(length), [], [[] for _ in range(length + 1)]
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        capacity = tree.smallest(size)
        if capacity < 0:
            number, capacity = len(bins), length
            bins.append([])
        else:
            number = open_[capacity].pop()
            tree.change(capacity, -1)
        bins[number].append(item)
        if capacity > size:
            open_[capacity - size].append(number)
            tree.change(capacity - size, 1)
    return bins


def _packed(ids: np.ndarray, docs: np.ndarray, bounds: np.ndarray, length: int, pad_id: int, width, first_id: int):
    """One shard as record batches."""
    sizes = np.diff(bounds)
    parts = np.maximum(-(-sizes // length), 1)
    owner = np.repeat(np.arange(len(sizes)), parts)
    start = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
    size = np.minimum(sizes[owner] - start, length)
    whole = np.flatnonzero(size == length)
    rest = np.flatnonzero(size < length)
    bins = [[k] for k in whole.tolist()] + [rest[one].tolist() for one in best_fit_decreasing(size[rest], length)]
    wide = np.dtype("<u2") if length <= 1 << 16 else np.dtype("<u4")
    for low in range(0, len(bins), 512):
        some = bins[low:low + 512]
        items = np.array([item for one in some for item in one])
        counts = np.array([len(one) for one in some])
        row = np.repeat(np.arange(len(some)), counts)
        ends = np.cumsum(size[items])
        begins = ends - size[items]
        heads = np.cumsum(counts) - counts
        place = begins - begins[heads][row]
        total = np.add.reduceat(size[items], heads)
        inner = np.arange(ends[-1]) - np.repeat(begins, size[items])
        target = np.repeat(row * length + place, size[items]) + inner
        matrix = np.full(len(some) * length, pad_id, width)
        matrix[target] = ids[np.repeat(bounds[owner[items]] + start[items], size[items]) + inner]
        positions = np.tile(np.arange(length), len(some)) - np.repeat(total, length)
        positions[target] = inner
        sums = np.zeros(len(items) + len(some), np.int64)  # a zero before each row's cumulative lengths
        sums[np.arange(len(items)) + row + 1] = place + size[items]
        bound = np.concatenate(([0], np.cumsum(counts)))
        given = docs[owner[items]]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(first_id + low, first_id + low + len(some))), pa.array(total.astype(np.int32)),
            _rows(matrix, len(some)), lists(sums, bound + np.arange(len(bound)), pa.int32()),
            _rows(positions.astype(wide), len(some)),
            pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(given, mask=given == NO_ID)),
            lists(start[items], bound, pa.int64()),
        ], names=["sequence_id", "n_tokens", "ids", "cu_seqlens", "positions", "doc_ids", "starts"])


def _rows(matrix: np.ndarray, count: int) -> pa.Array:
    raw = matrix.tobytes()
    step = len(raw) // count
    return pa.array([raw[k * step:(k + 1) * step] for k in range(count)], pa.binary())


def packed_ids(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, pad_id: int | None = None,
               shard_tokens: int = SHARD_TOKENS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All documents, each with ``end_id`` after it, as rows of an id matrix."""
    pad = end_id if pad_id is None else pad_id

    def run(batches):
        from pyspark import TaskContext

        made = encoder(path)
        width = np.dtype("<u2") if max(made.tokenizer.get_vocab_size(), end_id + 1, pad + 1) <= 1 << 16 else np.dtype("<u4")
        number = TaskContext.get().partitionId() << 33
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def shard():
            nonlocal number, held
            ids = np.concatenate([one[0] for one in held])
            owner = np.concatenate([one[1] for one in held])
            bounds = np.concatenate(([0], np.cumsum(np.concatenate([one[2] for one in held]))))
            held = []
            for rows in _packed(ids, owner, bounds, length, pad, width, number):
                number += rows.num_rows
                yield rows

        for piece in pieces(batches):
            ids, bounds = made.encode(piece.column("text"))
            sizes = np.diff(bounds) + 1
            out = np.full(int(sizes.sum()), end_id, np.int32)
            out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), np.diff(bounds))] = ids
            held.append((out, piece.column("d").to_numpy(), sizes))
            if sum(len(one[0]) for one in held) >= shard_tokens:
                yield from shard()
        if held:
            yield from shard()

    return id_and_text(docs, id_column, text_column).mapInArrow(run, SCHEMA)


def op3_binary_output(spark, sf_dir: str) -> DataFrame:
    return packed_ids(documents(spark, sf_dir), tokenizer_file())
