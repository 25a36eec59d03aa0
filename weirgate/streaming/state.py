"""Status changes and failure streaks on streams.

Two forms of the transition check are offered. ``TransitionSink`` handles each micro-batch with the distributed batch
operator and keeps the last status per key in files, so one key may own most of a batch. ``stream_transitions`` keeps
the status in keyed state (RocksDB) for low latency; a key's rows then pass through one task, chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirgate import constants as C
from weirgate.operators.scan import previous_value, streak_since_reset
from weirgate.operators.state import transition_error
from weirgate.sources.generations import Generations
from weirgate.streaming.intake import use_rocksdb


class TransitionSink:
    """``foreachBatch`` handler that writes every status change with its error to ``path/changes``.

    The last status of the keys of batch ``n`` goes to ``path/state/batch=n``; every ``compact_every`` batches the whole
    state is written once, so a batch reads at most that many small folders. All folders are written in overwrite mode
    and batch ``n`` reads only earlier ones: a repeated batch gives the same files.
    """

    def __init__(self, path: str, entity: str, key: str = "entity_id", at: str = "changed_at",
                 tie: str = "event_id", status: str = "status", compact_every: int = 20) -> None:
        self.path, self.entity = path, entity
        self.key, self.columns = key, [at, tie, status]
        self.compact_every = compact_every

    def _last(self, rows: DataFrame) -> DataFrame:
        newest = rows.groupBy(self.key).agg(F.max(F.struct(*self.columns)).alias("_last"))
        return newest.select(self.key, *[F.col(f"_last.{name}").alias(name) for name in self.columns])

    def _stored(self, spark, number: int) -> DataFrame | None:
        if number == 0:
            return None
        base = (number - 1) // self.compact_every * self.compact_every
        folders = [f"{self.path}/state/batch={past}" for past in range(base, number)]
        return self._last(spark.read.parquet(*folders))

    def __call__(self, batch: DataFrame, number: int) -> None:
        at, tie, status = self.columns
        rows = batch.select(self.key, *self.columns, F.lit(True).alias("_fresh"))
        stored = self._stored(batch.sparkSession, number)
        if stored is not None:
            rows = rows.unionByName(stored.withColumn("_fresh", F.lit(False)))
        changes = previous_value(rows, self.key, at, tie, status, "previous_status")
        error = F.when(F.col("previous_status").isNotNull(),
                       transition_error(self.entity, F.col("previous_status"), F.col(status)))
        changes.where("_fresh").select(self.key, *self.columns, "previous_status", error.alias("error")).write.mode(
            "overwrite").parquet(f"{self.path}/changes/batch={number}")
        keep = rows if number % self.compact_every == 0 else rows.join(
            batch.select(self.key).distinct(), self.key, "left_semi")
        self._last(keep).write.mode("overwrite").parquet(f"{self.path}/state/batch={number}")


def _folded_streak() -> list:
    """Entries of a key, oldest first: rows since the last reset, counted on until an entry has a reset of its own."""
    entries = F.array_sort(F.collect_list(F.struct("_batch", "since", "reset")))  # one for each run
    since = F.aggregate(entries, F.lit(0).cast("bigint"), lambda held, one: F.when(one.reset, one.since).otherwise(held + one.since))
    return [since.alias("since"), F.bool_or("reset").alias("reset")]


class StreakSink:
    """``foreachBatch`` handler for the failure streak per source.

    A batch leaves one entry for each of its sources: the failures since the last reset inside the batch, or all of them, and whether there
    was a reset. Entries add up in batch order, so they are merged without a look at any streak (see ``Generations``); a batch
    reads the entries of its own sources and rewrites nothing but what a merge takes up. ``path/streaks`` has the result.
    """

    def __init__(self, path: str, key: str = "source_key", at: str = "finished_at", tie: str = "fetch_id",
                 buckets: int = 16, fanout: int = 4) -> None:
        self.path, self.key, self.at, self.tie = path, key, at, tie
        self.state = Generations(f"{path}/state", key, ("since", "reset"), _folded_streak, buckets, fanout)

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, target = batch.sparkSession, f"{self.path}/streaks/batch={number}"
        self.state.forget(spark, number)
        held = self.state.find(batch.select(self.key), number)
        start = held.select(self.key, F.col("since").alias("start")) if held is not None else None
        is_reset = F.col("fetch_status") != "failed"
        rows = streak_since_reset(batch, self.key, self.at, self.tie, is_reset, "failure_streak", start=start)
        rows.write.mode("overwrite").parquet(target)
        written = spark.read.schema(rows.schema).parquet(target)
        newest = F.max(F.struct(self.at, self.tie, "failure_streak")).getField("failure_streak")
        own = written.groupBy(self.key).agg(newest.alias("_newest"), F.count(F.lit(1)).alias("_rows"), F.bool_or(is_reset).alias("reset"))
        self.state.add(own.select(self.key, F.when(F.col("reset"), F.col("_newest")).otherwise(F.col("_rows")).alias("since"), "reset"),
                       number)


class TransitionProcessor(StatefulProcessor):
    """Keyed state machine: one stored status per key, rows taken in arrival order."""

    def __init__(self, entity: str) -> None:
        self.entity = entity
        self.allowed = set(C.TRANSITIONS[entity])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.status = handle.getValueState("status", "status string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        current = self.status.get()[0] if self.status.exists() else None
        for chunk in rows:
            out = []
            for event_id, target in zip(chunk["event_id"], chunk["status"]):
                error = None
                if current is not None and (current, target) not in self.allowed:
                    error = f"Invalid {self.entity} state transition: '{current}' -> '{target}'"
                out.append((key[0], event_id, current, target, error))
                current = target
            yield pd.DataFrame(out, columns=["entity_id", "event_id", "previous_status", "status", "error"])
        if current is not None:
            self.status.update((current,))

    def close(self) -> None:
        pass


def stream_transitions(events: DataFrame, entity: str) -> DataFrame:
    """Every status change of a stream with its error (I4), using keyed state."""
    use_rocksdb(events.sparkSession)
    return events.select("entity_id", "event_id", "status").groupBy("entity_id").transformWithStateInPandas(
        TransitionProcessor(entity),
        outputStructType="entity_id bigint, event_id bigint, previous_status string, status string, error string",
        outputMode="Append", timeMode="None",
    )
