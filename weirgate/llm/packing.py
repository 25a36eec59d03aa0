"""Best-fit packing of token sequences by a configuration linear program over the histogram of lengths.

A configuration is a multiset of lengths that fit into one sequence. The program asks for as few configurations as cover
the histogram; its size depends on ``length`` only, never on the number of documents. It is solved by multiplicative
weights: each round prices the lengths by how little they are covered so far, finds the best configuration for these
prices by a knapsack dynamic program, and raises it. The fractional solution is rounded down; the rest, which is small
after a few repeats, goes best-fit decreasing on the histogram.

Spark then deals the pieces into the places: a piece's rank among those of its length comes from counts by (length,
bucket) and a row number inside a bucket of bounded size, and a table of rank ranges (bounded by ``length`` as well) gives
its sequence and offset. The number of sequences is at least the tokens over ``length``, rounded up.

Only documents of more than ``length`` tokens are cut; the first piece takes what is over. Null and empty texts are the
end id alone. Repeated rows are packed each, null ids stay null, extra columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from weirgate.llm.common import PIECE, batch, documents, id_and_text, mapped, real_id
from weirgate.llm.pretokens import encoder, forget_encoder
from weirgate.llm.token_counts import tokenizer_file
from weirgate.session import cut_lineage

LENGTH = 1024
END_ID = 2
ROUNDS = 400
#: How much dearer a length becomes, at most, when its cover is behind; and how many lengths a round serves.
SLACK = 0.01
TOGETHER = 96
#: Rounds by which the cover of a length may run ahead.
SPREAD = 8
BUCKET_ROWS = 50_000
#: Bytes of text that are cut and encoded at a time where memory is short.
SLICE = 1 << 18


def token_pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = True,
                 id_column: str = "doc_id", text_column: str = "text", lean: bool = False) -> DataFrame:
    """``d, piece, start, length, ids_crc32`` and the piece's ``ids`` (null unless ``with_ids``).

    ``lean``: smaller slices, and workers keep no encoder after a task; less memory for more CPU time."""

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        ids, bounds = encoder(path).encode(rows.column("text"))
        d = rows.column("d").to_numpy()
        sizes = np.diff(bounds) + 1
        ends = np.cumsum(sizes)
        out = np.full(int(ends[-1]), end_id, "<u4")
        out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), np.diff(bounds))] = ids
        parts = -(-sizes // length)
        owner = np.repeat(np.arange(len(sizes)), parts)
        piece = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        head = sizes - (parts - 1) * length  # the first piece
        start = np.where(piece == 0, 0, head[owner] + (piece - 1) * length)
        size = np.where(piece == 0, head[owner], length)
        begin = (ends - sizes)[owner] + start
        raw = memoryview(out.tobytes())
        cut = [raw[4 * a:4 * b] for a, b in zip(begin.tolist(), (begin + size).tolist())]
        return batch(d=d[owner], piece=piece.astype(np.int32), start=start, length=size,
                     ids_crc32=np.array([zlib.crc32(one) for one in cut], np.int64),
                     ids=pa.array([bytes(one) if with_ids else None for one in cut], pa.binary()))

    return mapped(id_and_text(docs, id_column, text_column), work,
                  "d long, piece int, start long, length long, ids_crc32 long, ids binary", limit=SLICE if lean else PIECE,
                  after=(lambda: forget_encoder(path)) if lean else None)


def best_fillings(prices: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room up to ``length``, the highest total price that fits and the length to take first (0: leave one
    token free): the dynamic program of the unbounded knapsack."""
    sizes = np.flatnonzero(prices > 0)
    worth = prices[sizes]
    best = np.zeros(length + 1)
    choice = np.zeros(length + 1, np.int64)
    upto = np.searchsorted(sizes, np.arange(length + 1), "right")
    for room in range(1, length + 1):
        count = upto[room]
        value, pick = best[room - 1], 0
        if count:
            total = best[room - sizes[:count]]
            total += worth[:count]
            top = int(total.argmax())
            if total[top] > value:
                value, pick = total[top], int(sizes[top])
        best[room], choice[room] = value, pick
    return best, choice


def filled(first: int, choice: np.ndarray, length: int) -> tuple[int, ...]:
    """The best configuration that holds a piece of length ``first``."""
    taken, room = [first], length - first
    while room > 0:
        pick = int(choice[room])
        if pick:
            taken.append(pick)
        room -= pick or 1
    return tuple(sorted(taken, reverse=True))


@dataclass
class Packing:
    """Configurations (lengths, longest first) and how many sequences have each."""

    configurations: list[tuple[int, ...]] = field(default_factory=list)
    counts: list[int] = field(default_factory=list)

    def add(self, configuration: tuple[int, ...], count: int) -> None:
        if count:
            self.configurations.append(configuration)
            self.counts.append(count)


def solve(histogram: np.ndarray, length: int, rounds: int = ROUNDS) -> Packing:
    """An exact cover of the histogram (index: length, value: pieces) by configurations."""
    left = histogram.astype(np.int64).copy()
    out = Packing()
    out.add((length,), int(left[length]))
    left[length] = 0
    while left.sum() > 4 * length:
        before = left.sum()
        for configuration, weight in _fractional(left, length, rounds).items():
            sizes, taken = np.unique(np.array(configuration), return_counts=True)
            count = min(int(weight), int(np.min(left[sizes] // taken)))
            if count:
                left[sizes] -= count * taken
                out.add(configuration, count)
        if left.sum() > 0.5 * before:
            break
    for configuration, count in _best_fit(left, length):
        out.add(configuration, count)
    return out


def _fractional(need: np.ndarray, length: int, rounds: int) -> dict[tuple[int, ...], float]:
    """A fractional solution by multiplicative weights: how many of each configuration.

    A length is priced at its tokens, and up to ``SLACK`` more the further its cover is behind. In each round the
    dynamic program gives, for each of the lengths that are furthest behind, the best configuration with that length;
    these are raised together, so that every length is covered at an even pace.
    """
    held = np.flatnonzero(need)
    demand = need[held].astype(float)
    place = np.zeros(length + 1, np.int64)
    place[held] = np.arange(len(held))
    covered = np.zeros(len(held))
    found: dict[tuple[int, ...], float] = {}
    pace = 1.0 / rounds
    for turn in range(1, rounds + 1):
        gap = covered / demand
        limit = demand * min((turn + SPREAD) * pace, 1.0)
        prices = np.zeros(length + 1)
        prices[held] = np.where(covered < limit, held * (1.0 + SLACK * np.exp(-(gap - gap.min()) / pace)), 0.0)
        _, choice = best_fillings(prices, length)
        for k in np.argsort(gap, kind="stable")[:TOGETHER].tolist():
            wanted = demand[k] * turn * pace - covered[k]
            if wanted <= 0:
                break
            configuration = filled(int(held[k]), choice, length)
            inside, taken = np.unique(place[np.array(configuration)], return_counts=True)
            size = min(wanted, float(((limit - covered)[inside] / taken).min()))
            if size > 0:
                found[configuration] = found.get(configuration, 0.0) + size
                covered[inside] += size * taken
    return dict(sorted(found.items(), key=lambda one: -one[1]))


def _best_fit(left: np.ndarray, length: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: bins with equal contents are handled together."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}
    for size in np.flatnonzero(left)[::-1].tolist():
        count = int(left[size])
        while count:
            room = min((room for room in open_ if room >= size), default=None)
            if room is None:
                # New bins take as many pieces of this length as fit.
                each = min(length // size, count)
                bins = count // each
                open_.setdefault(length - each * size, {}).setdefault((size,) * each, 0)
                open_[length - each * size][(size,) * each] += bins
                count -= bins * each
                continue
            held, bins = next(iter(open_[room].items()))
            used = min(bins, count)
            if used == bins:
                del open_[room][held]
                if not open_[room]:
                    del open_[room]
            else:
                open_[room][held] = bins - used
            grown = open_.setdefault(room - size, {})
            grown[held + (size,)] = grown.get(held + (size,), 0) + used
            count -= used
    return [(held, bins) for group in open_.values() for held, bins in group.items()]


def places(packing: Packing) -> dict[str, np.ndarray]:
    """Rank ranges: of the pieces of ``length``, those from ``rank`` on go to the sequences from ``sequence`` on, each at
    ``offset``. Ordered by length and rank."""
    rows, sequence = [], 0
    used: dict[int, int] = {}
    for configuration, count in zip(packing.configurations, packing.counts):
        offset = 0
        for size in configuration:
            rows.append((size, used.get(size, 0), sequence, offset))
            used[size] = used.get(size, 0) + count
            offset += size
        sequence += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {name: table[:, k] for k, name in enumerate(("length", "rank", "sequence", "offset"))}


def pack(pieces: DataFrame, length: int = LENGTH, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (with ``d``, ``piece``, ``length``) with ``sequence_id`` and ``offset``. The pieces are read several
    times: give a checkpoint or a table."""
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``length`` rows
    histogram = np.zeros(length + 1, np.int64)
    for row in counts:
        histogram[row.length] = row.n
    table = places(solve(histogram, length, rounds))
    buckets = max(int(histogram.sum()) // BUCKET_ROWS, 8)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("d", "piece"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket"))
                                               - F.col("n")).alias("before"))
    order = Window.partitionBy("length", "bucket").orderBy("d", "piece", "ids_crc32")
    ranked = dealt.withColumn("own", F.row_number().over(order)).join(before, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("own") - 1).drop("bucket", "own", "before")
    kinds = [f"{name} {kind}" for name, kind in ranked.dtypes]
    shift = np.int64(1 << 40)  # ranks stay below: 10**12 pieces of one length
    keys = table["length"] * shift + table["rank"]

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        wanted = rows.column("length").to_numpy() * shift + rows.column("rank").to_numpy()
        at = np.searchsorted(keys, wanted, "right") - 1
        sequence = table["sequence"][at] + rows.column("rank").to_numpy() - table["rank"][at]
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(sequence), pa.array(table["offset"][at])],
                                          names=[*rows.schema.names, "sequence_id", "offset"])

    def run(batches):
        for rows in batches:
            if rows.num_rows:
                yield work(rows)

    return ranked.mapInArrow(run, ", ".join([*kinds, "sequence_id long", "offset long"])).drop("rank")


def pack_documents(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = True,
                   id_column: str = "doc_id", text_column: str = "text", lean: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece, and ``ids`` (little-endian
    unsigned 32-bit) where asked for. ``lean``: see ``token_pieces``."""
    pieces = token_pieces(docs, path, length, end_id, with_ids, id_column, text_column, lean)
    packed = pack(cut_lineage(pieces if with_ids else pieces.drop("ids")), length)
    return packed.select(real_id().alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                         *(["ids"] if with_ids else []))


def op8_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_file(), with_ids=False)
