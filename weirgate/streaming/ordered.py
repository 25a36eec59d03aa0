"""State in event order: a reorder buffer, status changes and due retries on top of it.

Rows arrive in any order. They wait in state until the watermark has passed their time; then all rows up to the watermark are
taken in order of key, time and tie. So the result does not depend on how rows were dealt into batches, as long as none comes
later than the watermark allows.

Keys share a fixed number of buckets by their hash, and a bucket is what a processor sees: its rows are handled as columns and
held as Arrow tables, so a call to the state serves all keys of a bucket and calls do not grow with the keys. A bucket holds
one timer, at the earliest thing it waits for. The number of buckets belongs to a checkpoint: with another one, start anew.

The state of a bucket is what the watermark still holds back and one entry for each of its keys, not its history. A key's rows
of one release pass one task; where a single key may own most of a stream, ``state.TransitionSink`` spreads them instead.

A watermark moves on with the stream's own times only. A stream that ends, or pauses, is brought to an end by a row of a
key of its own with a later time (a heartbeat); the processors give nothing for keys that only have heartbeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weirgate import constants as C
from weirgate.streaming.intake import use_rocksdb

MICROS = 1_000
BUCKETS = 512
#: Rows of a piece of state: what a release reads beyond what it gives out.
PIECE_ROWS = 20_000
ARROW = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string()}


def _schema(columns: list[tuple[str, str]]) -> pa.Schema:
    return pa.schema([(name, ARROW[kind]) for name, kind in columns])


def _packed(rows: pd.DataFrame, schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_table(pa.Table.from_pandas(rows, schema, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(pa.py_buffer(bytes(data))) as reader:
        return reader.read_pandas()


def _whole(values: pd.Series | np.ndarray, missing: np.ndarray) -> pd.api.extensions.ExtensionArray:
    """Whole numbers with nulls."""
    return pd.arrays.IntegerArray(np.array(values, np.int64), np.array(missing, bool))


class TimedRows:
    """Rows of a bucket in pieces of state, with the number and the least time of each piece beside them.

    A release reads the pieces that the watermark has reached and writes back what it leaves of them, cut by time.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, columns: list[tuple[str, str]], at: str) -> None:
        self.schema, self.at = _schema(columns), at
        self.parts = handle.getMapState(name, "number bigint", "rows binary")
        self.listed = handle.getListState(f"{name}_listed", "number bigint, least bigint")

    def add(self, rows: pd.DataFrame) -> None:
        if len(rows):
            self.listed.appendList(self._cut(rows, self._after(list(self.listed.get()))))

    def take(self, passed: int) -> tuple[pd.DataFrame, int | None]:
        """The rows up to ``passed``, which leave the state, and the least time of those that stay."""
        held = [tuple(piece) for piece in self.listed.get()]
        stay = [piece for piece in held if piece[1] > passed]
        if len(stay) == len(held):
            return self.schema.empty_table().to_pandas(), min((least for _, least in held), default=None)
        rows = []
        for number, least in held:
            if least <= passed:
                rows.append(_unpacked(self.parts.getValue((number,))[0]))
                self.parts.removeKey((number,))
        rows = pd.concat(rows, ignore_index=True)
        due = (rows[self.at] <= passed).to_numpy()
        stay += self._cut(rows[~due], self._after(held))
        if stay:
            self.listed.put(stay)
        else:
            self.listed.clear()
        return rows[due], min((least for _, least in stay), default=None)

    @staticmethod
    def _after(pieces: list[tuple]) -> int:
        return max((piece[0] for piece in pieces), default=-1) + 1

    def _cut(self, rows: pd.DataFrame, number: int) -> list[tuple[int, int]]:
        """Write the rows as pieces numbered from ``number``."""
        rows = rows.sort_values(self.at, kind="stable")
        made = []
        for first in range(0, len(rows), PIECE_ROWS):
            piece = rows.iloc[first:first + PIECE_ROWS]
            self.parts.updateValue((number,), (_packed(piece, self.schema),))
            made.append((number, int(piece[self.at].iloc[0])))
            number += 1
        return made


class EventOrder(StatefulProcessor):
    """Hands a bucket's rows to ``take`` once the watermark has passed their ``at_us``.

    ``keys`` names the key columns, ``payload`` the columns kept besides, with their types; ``status`` is null for a heartbeat.
    Bit k of ``nulls`` tells that the k-th whole number of a row is null; it is 0 then.
    ``entry`` is what is kept of every key.
    """

    keys: tuple[str, ...] = ()
    payload: tuple[tuple[str, str], ...] = ()
    entry: tuple[str, str] = ("", "")

    @classmethod
    def columns(cls) -> list[tuple[str, str]]:
        return [*[(name, "bigint") for name in cls.keys], ("at_us", "bigint"), ("tie", "bigint"), *cls.payload]

    @classmethod
    def whole_numbers(cls) -> list[str]:
        return [name for name, kind in cls.columns() if kind == "bigint"]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.names = [*[name for name, _ in self.columns()], "nulls"]
        self.held = TimedRows(handle, "held", [*self.columns(), ("nulls", "bigint")], "at_us")
        self.alarm = handle.getValueState("alarm", "at_ms bigint")
        self.by_key = [*self.keys, "key_nulls"]
        self.entry_schema = _schema([*[(name, "bigint") for name in self.by_key], self.entry])
        self.entries = handle.getValueState("entries", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for chunk in rows:
            fresh = chunk.loc[chunk["status"].notna(), self.names]
            if len(fresh):
                if self.missing(fresh, "at_us").any():
                    raise ValueError("a row without a time has no place in event order")
                self.held.add(fresh)
                least = int(fresh["at_us"].min())
                first = least if first is None else min(first, least)
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * MICROS
        rows, least = self.held.take(passed)
        self.alarm.clear()
        out = self.take(rows, passed)
        waits = [at for at in (least, self.waits()) if at is not None]
        if waits:
            self._wake(min(waits))
        if len(out):
            yield out

    def take(self, rows: pd.DataFrame, passed: int) -> pd.DataFrame:
        """Output for the rows that are due; ``passed`` is the watermark in microseconds."""
        raise NotImplementedError

    def waits(self) -> int | None:
        """The time the processor itself waits for."""
        return None

    def missing(self, rows: pd.DataFrame, name: str) -> np.ndarray:
        """Where a whole number is null."""
        return (rows["nulls"].to_numpy() >> self.whole_numbers().index(name)) & 1 == 1

    def whole(self, rows: pd.DataFrame, name: str) -> pd.api.extensions.ExtensionArray:
        return _whole(rows[name], self.missing(rows, name))

    def in_order(self, rows: pd.DataFrame, none) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
        """The rows by key, time and tie (null first), each one's key as a number, and the entries of all keys (``none``: new)."""
        rows = rows.assign(key_nulls=rows["nulls"] & ((1 << len(self.keys)) - 1))
        if self.entries.exists():
            kept = _unpacked(self.entries.get()[0])
        else:
            kept = self.entry_schema.empty_table().to_pandas()
        both = pd.concat([kept[self.by_key], rows[self.by_key]], ignore_index=True)
        number = both.groupby(self.by_key, sort=False).ngroup().to_numpy()
        # Keys are numbered as they come, kept ones first.
        self.known = both.drop_duplicates(self.by_key)
        entries = np.full(len(self.known), none, object if none is None else np.int64)
        entries[:len(kept)] = kept[self.entry[0]]
        number = number[len(kept):]
        order = np.lexsort((rows["tie"], ~self.missing(rows, "tie"), rows["at_us"], number))
        return rows.iloc[order], number[order], entries

    def keep(self, entries: np.ndarray, worth: np.ndarray) -> None:
        """Write the entries of the keys of ``in_order`` that are worth it."""
        if worth.any():
            rows = self.known[worth].assign(**{self.entry[0]: entries[worth]})
            self.entries.update((_packed(rows, self.entry_schema),))
        else:
            self.entries.clear()

    def _wake(self, at_us: int) -> None:
        """Set the bucket's timer to this time unless an earlier one is set."""
        at_ms = -(-at_us // MICROS)
        held = self.alarm.get()[0] if self.alarm.exists() else None
        if held is not None and held <= at_ms:
            return
        if held is not None:
            self.handle.deleteTimer(held)
        self.handle.registerTimer(at_ms)
        self.alarm.update((at_ms,))

    def close(self) -> None:
        pass


def _edges(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last row of each run of a number."""
    change = number[1:] != number[:-1]
    return np.concatenate(([True], change)), np.concatenate((change, [True]))


class OrderedTransitions(EventOrder):
    """Every status change of a key with its error, in event order."""

    keys = ("entity_id",)
    payload = (("status", "string"),)
    entry = ("status", "string")
    output = "entity_id bigint, event_id bigint, previous_status string, status string, error string"

    def __init__(self, entity: str) -> None:
        self.entity, self.allowed = entity, set(C.TRANSITIONS[entity])

    def _error(self, current: str | None, target: str) -> str | None:
        if current is not None and (current, target) not in self.allowed:
            return f"Invalid {self.entity} state transition: '{current}' -> '{target}'"
        return None

    def take(self, rows: pd.DataFrame, passed: int) -> pd.DataFrame:
        if not len(rows):
            return rows
        rows, number, current = self.in_order(rows, None)
        first, last = _edges(number)
        status = rows["status"].to_numpy(object)
        previous = np.concatenate(([None], status[:-1]))
        previous[first] = current[number[first]]
        current[number[last]] = status[last]
        self.keep(current, np.ones(len(current), bool))
        return pd.DataFrame({
            "entity_id": self.whole(rows, "entity_id"), "event_id": self.whole(rows, "tie"), "previous_status": previous,
            "status": status, "error": [self._error(*change) for change in zip(previous, status)]})


class DueRetries(EventOrder):
    """Retries of a digest part, each given out when its wait is over.

    Attempts are taken in order; ``trial`` counts those of the running delivery from 0. A time-out or rate limit with trials
    left starts a wait, which outlives batches in state with a timer. Parts that start anew leave no entry.
    """

    keys = ("digest_id", "part_number")
    payload = (("status", "string"), ("error_code", "string"), ("retry_after_seconds", "double"), ("finished_us", "bigint"))
    entry = ("trial", "bigint")
    output = "digest_id bigint, part_number bigint, attempt_number bigint, trial bigint, delay_seconds double, due_us bigint"

    def __init__(self, max_trials: int = 3) -> None:
        self.max_trials, self.retryable = max_trials, set(C.RETRYABLE_DELIVERY_ERRORS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = TimedRows(handle, "waiting", [
            ("digest_id", "bigint"), ("part_number", "bigint"), ("attempt_number", "bigint"), ("trial", "bigint"),
            ("delay_seconds", "double"), ("due_us", "bigint"), ("nulls", "bigint")], "due_us")

    def take(self, rows: pd.DataFrame, passed: int) -> pd.DataFrame:
        due, least = self.waiting.take(passed)
        if len(rows):
            fresh = self._retries(rows)
            over = (fresh["due_us"] <= passed).to_numpy()
            later = fresh[~over]
            self.waiting.add(later)
            if len(later):
                least = min([int(later["due_us"].min()), *([] if least is None else [least])])
            due = pd.concat([due, fresh[over]], ignore_index=True) if len(due) else fresh[over]
        self._least = least
        due = due.sort_values(["due_us", "attempt_number"])
        return pd.DataFrame({
            "digest_id": self.whole(due, "digest_id"), "part_number": self.whole(due, "part_number"),
            "attempt_number": _whole(due["attempt_number"], self.missing(due, "tie")), "trial": due["trial"].to_numpy(),
            "delay_seconds": due["delay_seconds"].to_numpy(), "due_us": due["due_us"].to_numpy()})

    def _retries(self, rows: pd.DataFrame) -> pd.DataFrame:
        """The waits that these attempts start."""
        rows, number, trials = self.in_order(rows, 0)
        failed = (rows["status"] == "failed").to_numpy()
        again = failed & rows["error_code"].isin(self.retryable).to_numpy()
        ends = (rows["status"] == "sent").to_numpy() | (failed & ~again)
        first, last = _edges(number)
        begins = first | np.concatenate(([False], ends[:-1]))  # a delivery, or what is seen of it
        place = np.arange(len(rows))
        since = place - np.maximum.accumulate(np.where(begins, place, 0))
        start = np.where(first, trials[number], 0)[place - since]
        trial = (start + since) % self.max_trials
        trials[number[last]] = np.where(ends, 0, (trial + 1) % self.max_trials)[last]
        self.keep(trials, trials != 0)
        waits = again & (trial + 1 < self.max_trials) & ~self.missing(rows, "finished_us")
        rows, trial = rows[waits], trial[waits]
        asked = rows["retry_after_seconds"].to_numpy(float)
        delay = np.where(asked > 0, asked, np.exp2(np.minimum(trial, 3)))
        return pd.DataFrame({
            "digest_id": rows["digest_id"], "part_number": rows["part_number"], "attempt_number": rows["tie"], "trial": trial,
            "delay_seconds": delay, "due_us": rows["finished_us"] + (delay * 1_000_000).astype(np.int64), "nulls": rows["nulls"]})

    def waits(self) -> int | None:
        return self._least


def _in_order(rows: DataFrame, at: str, lateness: str, tie: str, processor: EventOrder, *columns: Column) -> DataFrame:
    use_rocksdb(rows.sparkSession)
    timed = rows.withWatermark(at, lateness).select(
        *processor.keys, at, F.unix_micros(at).alias("at_us"), F.col(tie).cast("bigint").alias("tie"), *columns)
    whole = processor.whole_numbers()
    nulls = sum((F.when(F.col(name).isNull(), 1 << k).otherwise(0) for k, name in enumerate(whole)), F.lit(0))
    # Whole numbers go without nulls: beside one, pandas would make them floats.
    dealt = timed.select(
        F.pmod(F.xxhash64(*processor.keys), F.lit(BUCKETS)).alias("bucket"), at,
        *[F.coalesce(F.col(name).cast("bigint"), F.lit(0)).alias(name) if name in whole else F.col(name)
          for name, _ in processor.columns()],
        nulls.cast("bigint").alias("nulls"))
    return dealt.groupBy("bucket").transformWithStateInPandas(
        processor, outputStructType=processor.output, outputMode="Append", timeMode="EventTime")


def ordered_transitions(events: DataFrame, entity: str, lateness: str) -> DataFrame:
    """Every status change of a stream of ``entity_id, event_id, changed_at, status`` with its error (I4), in event order.

    Rows may come up to ``lateness`` after later ones of any key; later still, the watermark drops them. A null status is a heartbeat.
    """
    return _in_order(events, "changed_at", lateness, "event_id", OrderedTransitions(entity), F.col("status"))


def due_retries(attempts: DataFrame, lateness: str, max_trials: int = 3) -> DataFrame:
    """Retries of a stream of delivery attempts (I5), each as soon as its wait is over in event time.

    Same rule as ``delivery.retry_schedule`` on ``delivery.with_trials``; attempts are in order of ``started_at`` and
    number. A null status is a heartbeat.
    """
    return _in_order(attempts, "started_at", lateness, "attempt_number", DueRetries(max_trials),
                     F.col("status"), F.col("error_code"), F.col("retry_after_seconds").cast("double").alias("retry_after_seconds"),
                     F.unix_micros("finished_at").alias("finished_us"))
