"""Token counts by looking up pre-token lengths in two tiers, without shuffling pre-tokens or texts.

First tier: a compact hash table (two arrays) of the lengths of frequent pre-tokens, broadcast. Which ones are frequent is
counted over all documents: each task keeps a bounded summary of its own (the rarer half goes when it is full) and hands
on its most frequent entries, and only those few are added up. ``frequent`` bounds the table, 65,536 entries or about
1.5 MB whatever the input. Second tier: what the table misses is encoded once per worker process and kept there.
The tables only save time: counts are those of the library for any table.

Null text counts as empty. One row for each row given, repeated rows and null ids included; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from weirgate.llm.common import batch, documents, id_and_text, mapped, pieces, real_id
from weirgate.llm.kernels import flat, range_hashes, signed
from weirgate.llm.pretokens import Encoder, Table, encoder

FREQUENT = 65_536
PER_TASK = 4_096
SUMMARY = 200_000
LIMIT = 512


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class _Summary:
    """Counts of frequent pre-tokens in bounded room."""

    def __init__(self, room: int):
        self.room, self.table = room, Table(room)
        self.hashes, self.counts, self.texts = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

    def add(self, raw: bytes, starts, ends, hashes) -> None:
        got = self.table.find(hashes)
        missing = np.flatnonzero(got < 0)
        if len(missing):
            fresh, first = np.unique(hashes[missing], return_index=True)
            if len(self.hashes) + len(fresh) > self.room:
                self._shrink(max(self.room // 2 - len(fresh), 0))
                fresh, first = fresh[:self.room // 2], first[:self.room // 2]
                known = self.table.find(fresh) >= 0
                fresh, first = fresh[~known], first[~known]
            at = missing[first]
            self.table.add(fresh, np.arange(len(self.hashes), len(self.hashes) + len(fresh), dtype=np.int32))
            self.hashes = np.concatenate((self.hashes, fresh))
            self.counts = np.concatenate((self.counts, np.zeros(len(fresh), np.int64)))
            self.texts += [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            got = self.table.find(hashes)
        self.counts += np.bincount(got[got >= 0], minlength=len(self.counts))

    def _shrink(self, room: int) -> None:
        best = np.argsort(-self.counts, kind="stable")[:room]
        self.hashes, self.counts = self.hashes[best], self.counts[best]
        self.texts = [self.texts[k] for k in best.tolist()]
        self.table = Table(self.room)
        self.table.add(self.hashes, np.arange(len(best), dtype=np.int32))

    def top(self, count: int):
        best = np.lexsort((self.hashes, -self.counts))[:count]
        return self.hashes[best], self.counts[best], [self.texts[k] for k in best.tolist()]


def frequent_pretokens(texts: DataFrame, path: str, frequent: int = FREQUENT, per_task: int = PER_TASK) -> DataFrame:
    """The most frequent pre-tokens of the corpus: ``hash, pretoken, n``."""

    def run(batches):
        summary, cut = _Summary(SUMMARY), encoder(path)
        for piece in pieces(batches):
            data, offsets = flat(piece.column("text"))
            starts, _, special = cut.cut(data, offsets)
            ends = np.append(starts[1:], len(data))[special < 0]
            starts = starts[special < 0]
            summary.add(data.tobytes(), starts, ends, range_hashes(data, starts, ends))
        hashes, counts, found = summary.top(per_task)
        yield batch(hash=signed(hashes), pretoken=found, n=counts)

    return (texts.select("text").mapInArrow(run, "hash long, pretoken binary, n long")
            .groupBy("hash").agg(F.min("pretoken").alias("pretoken"), F.sum("n").alias("n"))
            .orderBy(F.desc("n"), "hash").limit(frequent))


def length_table(rows: list, path: str) -> Table:
    """Lengths of pre-tokens as a hash table."""
    table = Table(max(len(rows), 1))
    if rows:
        made = Encoder(path)
        made.learn([bytes(row.pretoken).decode() for row in rows], np.zeros(0, np.uint64))
        table.add(np.array([row.hash for row in rows], np.int64).view(np.uint64), made.sizes)
    return table


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, frequent: int = FREQUENT, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    texts = id_and_text(docs, id_column, text_column)
    table = length_table(frequent_pretokens(texts, path, frequent).collect(), path)
    sent = docs.sparkSession.sparkContext.broadcast((table.keys, table.values, table.shift, table.mask))

    def work(piece):
        first = Table.__new__(Table)
        first.keys, first.values, first.shift, first.mask = sent.value
        second = encoder(path)
        data, offsets = flat(piece.column("text"))
        starts, bounds, special = second.cut(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = range_hashes(data, starts, ends)
        sizes = first.find(hashes).astype(np.int64)
        sizes[special >= 0] = 1
        rest = np.flatnonzero(sizes < 0)
        if len(rest):
            numbers = second.numbers(data, starts[rest], ends[rest], hashes[rest])
            sizes[rest] = second.sizes[numbers]
        sums = np.concatenate(([0], np.cumsum(sizes)))
        count = np.diff(sums[bounds])
        return batch(d=piece.column("d"), n_bytes=np.diff(offsets), n_tokens=count, over_limit=count > limit)

    done = mapped(texts, work, "d long, n_bytes long, n_tokens long, over_limit boolean")
    return done.select(real_id().alias("doc_id"), "n_bytes", "n_tokens", "over_limit")


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), tokenizer_file())
