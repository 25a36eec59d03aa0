"""Exact top-k by inner product: columnar branch and bound.

Vectors are turned into integers, ``floor(256 * x)``, and laid out by dimension. A task adds up the scores of its
candidates block of dimensions by block; after each block, what the remaining dimensions can still add is bounded by the
norms that remain (Cauchy-Schwarz), and only pairs that can still enter a query's best ``k`` are kept on, in compacted
arrays once they are few. The threshold of a query is the k-th best score that the task has seen; a task's first ``SEEDS`` candidates are
scored in full, so that all others are held against one. One row for each query and rank; extra columns are ignored; an empty table gives no rows.

Queries go in waves of bounded size, each broadcast (at most ``WAVE`` vectors) against one scan of the candidates; only a
task's ``k`` best of each query are shuffled. The waves are written to the shared folder one by one when there are several, so the
driver holds one wave at a time.

Vectors that are null, or hold a null or non-finite component, take no part, nor do rows without an id. Shorter vectors count
as padded with zeros. A query's own rows are all rows with its id; of several rows with a query's id the smallest vector is
searched. Other repeated rows are candidates each. Scores are exact while they are below 2**63; floating point is used only
below 2**53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from weirgate.llm.common import batch
from weirgate.session import cut_lineage

TOP = 5
EVERY = 50
WAVE = 4096
#: Dimensions in a block, candidates in a chunk, queries handled together.
BLOCK, CHUNK, TOGETHER = 16, 4096, 128
#: Candidates that give the first thresholds; the share of pairs from which on compacted arrays are cheaper than products.
SEEDS, FEW = 128, 0.2
LARGEST = float(1 << 62)


def valid_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``vec_id`` and the vector as integers, without rows that take no part."""
    doubles = F.transform(F.col(f"`{vector_column}`"), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(LARGEST / 256)))
    return (vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), doubles.alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
            .select("vec_id", F.transform("v", lambda x: F.floor(x * 256)).alias("v")))


def matrix(column: pa.Array, dims: int | None = None) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = max(dims or 0, int(sizes.max(initial=0)), 1)
    if len(sizes) and (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _rest(vectors: np.ndarray, blocks: list[tuple[int, int]]) -> np.ndarray:
    """Norm of what is left from each block on; the last row is zero."""
    squares = [np.square(vectors[:, a:b].astype(float)).sum(axis=1) for a, b in blocks]
    sums = np.cumsum(squares[::-1], axis=0)[::-1]
    return np.sqrt(np.vstack([sums, np.zeros(len(vectors))]))


class Search:
    """The best ``k`` candidates of a set of queries, over chunks of candidates."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.scores = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.filled = np.zeros((len(ids), k), bool)
        #: Blocks worked on as whole products, of all blocks.
        self.products = self.blocks = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        if not self.filled.all() and len(ids) > SEEDS:
            self.add(ids[:SEEDS], vectors[:SEEDS])
            ids, vectors = ids[SEEDS:], vectors[SEEDS:]
        dims = max(vectors.shape[1], self.queries.shape[1])
        vectors, queries = (np.pad(one, ((0, 0), (0, dims - one.shape[1]))) for one in (vectors, self.queries))
        blocks = [(a, min(a + BLOCK, dims)) for a in range(0, dims, BLOCK)]
        size = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * dims
        kind = np.float64 if size < 2.0 ** 52 else np.int64
        columns = np.ascontiguousarray(vectors.T.astype(kind))
        rest_c, rest_q = _rest(vectors, blocks), _rest(queries, blocks)
        for low in range(0, len(self.ids), TOGETHER):
            some = slice(low, min(low + TOGETHER, len(self.ids)))
            row, col, score = self._bounded(queries[some].astype(kind), columns, rest_q[:, some], rest_c, blocks,
                                            self._least(some), self.ids[some, None] == ids[None, :])
            own = self.ids[low + row] != ids[col]
            self._merge(low + row[own], ids[col[own]], score[own].astype(np.int64))

    def _least(self, some: slice) -> np.ndarray:
        """Scores below these cannot enter."""
        return np.where(self.filled[some].all(axis=1), self.scores[some].min(axis=1).astype(float), -np.inf)

    def _bounded(self, queries, columns, rest_q, rest_c, blocks, least, own):
        slack = lambda bound: bound + np.abs(bound) * 1e-9 + 1.0
        dense, number = np.zeros((len(queries), columns.shape[1]), columns.dtype), 0
        for number, (a, b) in enumerate(blocks, 1):
            dense += queries[:, a:b] @ columns[a:b]
            if number == len(blocks):
                break
            alive = slack(dense + rest_q[number][:, None] * rest_c[number][None, :]) >= least[:, None]
            if np.count_nonzero(alive) <= FEW * alive.size:
                break
        self.products += number
        self.blocks += len(blocks)
        if number == len(blocks):
            row, col = np.nonzero(dense >= np.maximum(least, self._kth(dense, own))[:, None])
            return row, col, dense[row, col]
        row, col = np.nonzero(alive)
        score = dense[row, col]
        for number, (a, b) in enumerate(blocks[number:], number + 1):
            for dim in range(a, b):
                score += queries[row, dim] * columns[dim, col]
            alive = slack(score + rest_q[number][row] * rest_c[number][col]) >= least[row]
            row, col, score = row[alive], col[alive], score[alive]
        return row, col, score

    def _kth(self, dense: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The k-th best score of each row; the query's own rows (``own``), however many, do not count."""
        if dense.shape[1] <= self.k:
            return np.full(len(dense), -np.inf)
        lowest = -np.inf if dense.dtype.kind == "f" else np.iinfo(np.int64).min
        place = dense.shape[1] - self.k
        return np.partition(np.where(own, lowest, dense), place, axis=1)[:, place].astype(float)

    def _merge(self, row, ids, score) -> None:
        if not len(row):
            return
        touched = np.unique(row)
        held = self.filled[touched]
        every_row = np.concatenate((row, np.repeat(touched, held.sum(axis=1))))
        every_id = np.concatenate((ids, self.found[touched][held]))
        every_score = np.concatenate((score, self.scores[touched][held]))
        order = np.lexsort((every_id, -every_score, every_row))
        every_row, every_id, every_score = every_row[order], every_id[order], every_score[order]
        first = np.searchsorted(every_row, every_row, "left")
        rank = np.arange(len(every_row)) - first
        best = rank < self.k
        self.filled[touched] = False
        self.scores[every_row[best], rank[best]] = every_score[best]
        self.found[every_row[best], rank[best]] = every_id[best]
        self.filled[every_row[best], rank[best]] = True

    def rows(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.filled)
        return batch(query_id=self.ids[row], vec_id=self.found[row, place], score=self.scores[row, place])


def _wave(candidates: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    sent = candidates.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches):
        search = Search(*sent.value, k)
        for rows in batches:
            for first in range(0, rows.num_rows, CHUNK):
                piece = rows.slice(first, CHUNK)
                search.add(piece.column("vec_id").to_numpy(), matrix(piece.column("v")))
        yield search.rows()

    found = candidates.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every``, the ``k`` best other rows."""
    valid = cut_lineage(valid_vectors(vectors, id_column, vector_column))  # read once a wave
    asked = cut_lineage(valid.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")))
    waves = max(-(-asked.count() * 5 // (4 * WAVE)), 1)  # a quarter of room, as ids are dealt by hash
    parts = []
    for wave in range(waves):
        some = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(waves)) == wave).toArrow()
        if not some.num_rows:
            continue
        ids = some.column("vec_id").combine_chunks().to_numpy()
        queries = matrix(some.column("v").combine_chunks())
        found = _wave(valid, ids, queries, k)
        parts.append(found if waves == 1 else cut_lineage(found))
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    done = parts[0]
    for part in parts[1:]:
        done = done.unionByName(part)
    return done.select("query_id", "rank", "vec_id", "score")


def op7_exact_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
