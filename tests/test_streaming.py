"""Streams in several batches give what the batch operators give over all rows."""

import random
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from weirgate import constants as C
from weirgate.operators import delivery, runs, state
from weirgate.operators.scan import previous_value
from weirgate.sources import sinks
from weirgate.sources.generations import Generations, KeyIndex
from weirgate.streaming import intake, ordered, state as stream_state

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


def landed(spark, path, rows, schema, files=5):
    """Rows in arrival order, one file per batch."""
    size = -(-len(rows) // files)
    for part in range(files):
        frame = spark.createDataFrame(rows[part * size:(part + 1) * size], schema).coalesce(1)
        frame.write.mode("append").parquet(f"{path}/{part}")
    whole = spark.createDataFrame(rows, schema)
    stream = intake.stream_intake(spark, f"{path}/*", "parquet", whole.schema, maxFilesPerTrigger="1")
    return stream, whole


def status_rows(seed=1, count=200):
    chooser = random.Random(seed)
    return [(chooser.randrange(6) if chooser.random() < 0.6 else 0, i, START + timedelta(minutes=i),
             chooser.choice(C.DIGEST_STATUSES)) for i in range(count)]


STATUS_SCHEMA = "entity_id bigint, event_id bigint, changed_at timestamp, status string"


def test_transition_sink_over_batches(spark, tmp_path):
    stream, whole = landed(spark, str(tmp_path / "in"), status_rows(), STATUS_SCHEMA)
    sink = stream_state.TransitionSink(str(tmp_path / "out"), "digest", compact_every=2)
    query = intake.run_batches(stream, sink, str(tmp_path / "check"))
    query.awaitTermination()
    assert len(query.recentProgress) >= 5
    found = {row.event_id: (row.previous_status, row.error)
             for row in spark.read.parquet(str(tmp_path / "out/changes")).collect()}
    expected = previous_value(whole, "entity_id", "changed_at", "event_id", "status", "previous_status").withColumn(
        "error", F.when(F.col("previous_status").isNotNull(),
                        state.transition_error("digest", F.col("previous_status"), F.col("status"))))
    assert found == {row.event_id: (row.previous_status, row.error) for row in expected.collect()}


def test_transition_sink_repeats_a_batch(spark, tmp_path):
    rows = status_rows(2, 40)
    sink = stream_state.TransitionSink(str(tmp_path), "digest")
    batches = [spark.createDataFrame(part, STATUS_SCHEMA) for part in (rows[:20], rows[20:])]
    sink(batches[0], 0)
    sink(batches[1], 1)
    once = sorted(map(tuple, spark.read.parquet(str(tmp_path / "changes")).drop("batch").collect()), key=repr)
    sink(batches[1], 1)
    again = sorted(map(tuple, spark.read.parquet(str(tmp_path / "changes")).drop("batch").collect()), key=repr)
    assert once == again and len(once) == 40


def test_keyed_state_over_batches(spark, tmp_path):
    stream, whole = landed(spark, str(tmp_path / "in"), status_rows(3), STATUS_SCHEMA)
    rows = stream_state.stream_transitions(stream, "digest")
    rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    found = {row.event_id: (row.previous_status, row.error) for row in spark.read.parquet(str(tmp_path / "out")).collect()}
    expected = previous_value(whole, "entity_id", "changed_at", "event_id", "status", "previous_status").withColumn(
        "error", F.when(F.col("previous_status").isNotNull(),
                        state.transition_error("digest", F.col("previous_status"), F.col("status"))))
    assert found == {row.event_id: (row.previous_status, row.error) for row in expected.collect()}


def test_streak_sink_over_batches(spark, tmp_path):
    chooser = random.Random(4)
    rows = [(f"s{chooser.randrange(3)}", i, START + timedelta(minutes=i),
             chooser.choice(["failed", "failed", "failed", "success"])) for i in range(150)]
    schema = "source_key string, fetch_id bigint, finished_at timestamp, fetch_status string"
    stream, whole = landed(spark, str(tmp_path / "in"), rows, schema)
    intake.run_batches(stream, stream_state.StreakSink(str(tmp_path / "out")), str(tmp_path / "check")).awaitTermination()
    found = {row.fetch_id: row.failure_streak for row in spark.read.parquet(str(tmp_path / "out/streaks")).collect()}
    assert found == {row.fetch_id: row.failure_streak for row in runs.failure_streak(whole).collect()}


def test_append_once_and_dedup(spark, tmp_path):
    rows = [(i % 17, i) for i in range(100)]
    stream, _ = landed(spark, str(tmp_path / "in"), rows, "key int, n int")
    intake.stream_append_once(stream, str(tmp_path / "out"), "key", str(tmp_path / "check")).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(row.key for row in stored.collect()) == list(range(17))
    sinks.append_once(spark.createDataFrame([(3, 0), (99, 0), (99, 1)], "key int, n int"), str(tmp_path / "out"), "key", 9)
    sinks.append_once(spark.createDataFrame([(3, 0), (99, 0), (99, 1)], "key int, n int"), str(tmp_path / "out"), "key", 9)
    assert sorted(row.key for row in spark.read.parquet(str(tmp_path / "out")).collect()) == [*range(17), 99]
    unique = intake.stream_dedup(stream, "key")
    unique.writeStream.format("parquet").option("path", str(tmp_path / "dedup")).option(
        "checkpointLocation", str(tmp_path / "check2")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(row.key for row in spark.read.parquet(str(tmp_path / "dedup")).collect()) == list(range(17))


@pytest.mark.parametrize("horizon", ["2 hours"])
def test_dedup_within_a_horizon(spark, tmp_path, horizon):
    late = START + timedelta(days=2)
    rows = [(1, START), (1, START + timedelta(hours=1)), (2, late), (3, late), (1, late)]
    stream, _ = landed(spark, str(tmp_path / "in"), rows, "key int, at timestamp", files=5)
    intake.stream_dedup(stream, "key", "at", horizon).writeStream.format("parquet").option(
        "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(
        availableNow=True).start().awaitTermination()
    found = sorted((row.key, row.day) for row in spark.read.parquet(str(tmp_path / "out")).select(
        "key", F.dayofmonth("at").alias("day")).collect())
    assert found == [(1, 1), (1, 3), (2, 3), (3, 3)]


def test_age_filter(spark, tmp_path):
    rows = [(1, START), (2, START + timedelta(hours=50)), (3, START + timedelta(hours=8))]
    stream, _ = landed(spark, str(tmp_path / "in"), rows, "n int, published_at timestamp", files=1)
    kept = intake.stream_age_filter(stream, "published_at", F.lit(START + timedelta(hours=80)))
    kept.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(row.n for row in spark.read.parquet(str(tmp_path / "out")).collect()) == [2, 3]


# Event order, timers, generations ------------------------------------------------------------------------------------------

def shuffled_batches(spark, path, rows, schema, at, files=4, seed=7):
    """Rows in arrival order that is not event order, one file a batch, then a heartbeat long after."""
    order = list(rows)
    random.Random(seed).shuffle(order)
    names = [part.split()[0] for part in schema.split(", ")]
    last = max(row[names.index(at)] for row in rows)
    beat = tuple(last + timedelta(days=400) if name == at else None for name in names)
    size = -(-len(order) // files)
    for part in range(files):
        spark.createDataFrame(order[part * size:(part + 1) * size], schema).coalesce(1).write.mode("append").parquet(path)
    spark.createDataFrame([beat], schema).coalesce(1).write.mode("append").parquet(path)
    return intake.stream_intake(spark, path, "parquet", spark.createDataFrame([], schema).schema, maxFilesPerTrigger="1")


def run_to_files(stream, tmp_path):
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_transitions_in_event_order_from_shuffled_files(spark, tmp_path):
    rows = status_rows(11, 160)
    stream = shuffled_batches(spark, str(tmp_path / "in"), rows, STATUS_SCHEMA, "changed_at")
    query = run_to_files(ordered.ordered_transitions(stream, "digest", "300 days"), tmp_path)
    assert len(query.recentProgress) >= 5
    whole = spark.createDataFrame(rows, STATUS_SCHEMA)
    expected = previous_value(whole, "entity_id", "changed_at", "event_id", "status", "previous_status").withColumn(
        "error", F.when(F.col("previous_status").isNotNull(),
                        state.transition_error("digest", F.col("previous_status"), F.col("status"))))
    got = {row.event_id: (row.previous_status, row.error) for row in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {row.event_id: (row.previous_status, row.error) for row in expected.collect()}


ATTEMPT_SCHEMA = ("digest_id bigint, part_number bigint, attempt_number bigint, status string, error_code string, "
                  "retry_after_seconds int, started_at timestamp, finished_at timestamp")


def attempt_rows(seed, count):
    chooser = random.Random(seed)
    rows, numbers = [], {}
    for k in range(count):
        part = chooser.randrange(3), chooser.randrange(2)
        numbers[part] = numbers.get(part, 0) + 1
        status = chooser.choice(["failed", "failed", "failed", "sent", "pending"])
        code = chooser.choice([*C.RETRYABLE_DELIVERY_ERRORS, "TELEGRAM_PERMANENT_FAILURE"]) if status == "failed" else None
        started = START + timedelta(minutes=k)
        rows.append((*part, numbers[part], status, code, chooser.choice([None, 0, 30]) if code else None, started,
                     None if status == "pending" else started + timedelta(milliseconds=chooser.randrange(900))))
    return rows


def test_due_retries_of_a_stream(spark, tmp_path):
    rows = attempt_rows(5, 150)
    stream = shuffled_batches(spark, str(tmp_path / "in"), rows, ATTEMPT_SCHEMA, "started_at")
    run_to_files(ordered.due_retries(stream, "300 days"), tmp_path)
    schedule = delivery.retry_schedule(delivery.with_trials(spark.createDataFrame(rows, ATTEMPT_SCHEMA))).where("decision = 'retry'")
    names = ("digest_id", "part_number", "attempt_number", "trial", "delay_seconds")
    want = sorted((*[row[name] for name in names], round(row.finished_at.timestamp() * 1e6) + int(row.delay_seconds * 1e6))
                  for row in schedule.collect())
    got = sorted(tuple(row) for row in spark.read.parquet(str(tmp_path / "out")).select(*names, "due_us").collect())
    assert got == want and len(got) > 20


def test_a_retry_is_given_out_when_its_wait_is_over(spark, tmp_path):
    place = str(tmp_path / "in")

    def land(rows):
        spark.createDataFrame(rows, ATTEMPT_SCHEMA).coalesce(1).write.mode("append").parquet(place)

    def run():
        schema = spark.createDataFrame([], ATTEMPT_SCHEMA).schema
        stream = intake.stream_intake(spark, place, "parquet", schema, maxFilesPerTrigger="1")
        run_to_files(ordered.due_retries(stream, "0 seconds"), tmp_path)
        return sorted((row.part_number, row.trial, row.delay_seconds)
                      for row in spark.read.schema(ordered.DueRetries.output).parquet(str(tmp_path / "out")).collect())

    at = lambda seconds: START + timedelta(seconds=seconds)
    land([(1, 1, 1, "failed", "TELEGRAM_RATE_LIMITED", 100, at(0), at(1)), (1, 2, 1, "failed", "TELEGRAM_TIMEOUT", None, at(0), at(1)),
          (1, 3, 1, "sent", None, None, at(0), at(1))])
    beat = lambda seconds: [(9, 9, 0, None, None, None, at(seconds), None)]
    land(beat(50))
    assert run() == [(2, 0, 1.0)]  # the short wait is over, the long one goes on in the state
    land(beat(100))
    assert run() == [(2, 0, 1.0)]
    land(beat(102))
    assert run() == [(1, 0, 100.0), (2, 0, 1.0)]
    land(beat(500))
    assert run() == [(1, 0, 100.0), (2, 0, 1.0)]  # once


def test_runs_before_a_batch():
    held = Generations("p", "k", fanout=4)
    assert held.runs(0) == [] and held.runs(3) == [(0, 0), (0, 1), (0, 2)]
    assert held.runs(27) == [(2, 15), (1, 19), (1, 23), (0, 24), (0, 25), (0, 26)]
    assert [held.level_of(n) for n in (0, 3, 15, 16, 63)] == [0, 1, 2, 0, 3]
    for number in range(200):  # what a batch writes takes the place of the runs it covers
        level = held.level_of(number)
        kept = [run for run in held.runs(number) if run[1] <= number - 4 ** level]
        assert held.runs(number + 1) == [*kept, (level, number)]


def size_of(folders):
    return sum(file.stat().st_size for folder in folders for file in Path(folder).glob("*.parquet"))


def test_what_a_batch_reads_does_not_grow(spark, tmp_path):
    sink = sinks.AppendOnceSink(str(tmp_path / "rows"), "key", buckets=8, fanout=2)
    opened, stored = [], set()
    for number in range(17):
        fresh = [number * 10 + k for k in range(3)]
        old = [max(number - 1, 0) * 10] if number else []  # one key of the batch before comes again
        frame = spark.createDataFrame([(key, number) for key in [*fresh, *old, *fresh]], "key bigint, n int")
        sink(frame, number)
        written = [row.key for row in spark.read.parquet(str(tmp_path / f"rows/batch={number}")).collect()]
        assert sorted(written) == fresh
        stored |= set(fresh)
        opened.append((size_of(sink.index.opened), len(sink.index.runs(number)), len(sink.index.opened)))
    assert sorted(row.key for row in spark.read.parquet(str(tmp_path / "rows")).collect()) == sorted(stored)
    for size, runs_, folders in opened[2:]:
        assert folders <= runs_ * 4 + 4  # the filters its four keys fall into, and entries for the one that is known
    # One run holds everything at both times: its buckets are no larger for eight times the keys.
    assert opened[16][1] == opened[2][1] == 1
    assert opened[16][0] / opened[16][2] <= 1.3 * opened[2][0] / opened[2][2]
    names = {path.name for path in (tmp_path / "rows/_keys/entries").iterdir()}
    assert {name for name in names if name.startswith("_run=")} == {"_run=r000000015-04", "_run=r000000016-00"}  # older runs are gone
    before = sorted(row.key for row in spark.read.parquet(str(tmp_path / "rows")).collect())
    sink(spark.createDataFrame([(160, 0), (161, 0), (162, 0), (150, 0)], "key bigint, n int"), 16)  # the last batch again
    assert sorted(row.key for row in spark.read.parquet(str(tmp_path / "rows")).collect()) == before


def test_streaks_are_kept_as_deltas(spark, tmp_path):
    chooser = random.Random(9)
    schema = "source_key string, fetch_id bigint, finished_at timestamp, fetch_status string"
    rows = [(f"s{chooser.randrange(40)}", i, START + timedelta(minutes=i), chooser.choice(["failed", "failed", "failed", "success"]))
            for i in range(210)]
    sink = stream_state.StreakSink(str(tmp_path / "out"), fanout=2, buckets=2)
    for number in range(7):
        batch = rows[number * 30:(number + 1) * 30]
        for _ in range(2 if number in (1, 3) else 1):  # some batches are repeated
            sink(spark.createDataFrame(batch, schema), number)
        run = f"r{number:09d}-{sink.state.level_of(number):02d}"
        held = spark.read.parquet(str(tmp_path / f"out/state/entries/_run={run}"))
        covered = rows[(number + 1 - 2 ** sink.state.level_of(number)) * 30:(number + 1) * 30]
        assert held.count() == len({row[0] for row in covered})  # the keys of the batches it covers, no others
    got = {row.fetch_id: row.failure_streak for row in spark.read.parquet(str(tmp_path / "out/streaks")).collect()}
    whole = spark.createDataFrame(rows, schema)
    assert got == {row.fetch_id: row.failure_streak for row in runs.failure_streak(whole).collect()}


def test_state_of_batches_without_keys(spark, tmp_path):
    held = KeyIndex(str(tmp_path / "keys"), "k", buckets=2, fanout=2)
    none = spark.createDataFrame([], "k string")
    for number, keys in enumerate([[], ["a"], [], [], ["a", "b"]]):
        frame = spark.createDataFrame([(key,) for key in keys], "k string") if keys else none
        held.forget(spark, number)
        fresh = sorted(row.k for row in held.fresh(frame, number).collect())
        held.add(held.fresh(frame, number), number)
    assert fresh == ["b"]


def test_state_of_many_keys_is_shared(spark, tmp_path):
    """Calls to the state follow the buckets, not the keys; null keys and numbers beyond a float are kept as they are."""
    chooser = random.Random(8)
    big = (1 << 60) + 1
    keys = [*range(3000), big, None]
    rows = []
    for k in range(12_000):
        digest = keys[k] if k < len(keys) else chooser.choice(keys)
        failed = chooser.random() < 0.7
        started = START + timedelta(seconds=k)
        rows.append((digest, 1, k + big, "failed" if failed else "sent", "TELEGRAM_TIMEOUT" if failed else None, None, started,
                     None if k % 50 == 0 else started))
    stream = shuffled_batches(spark, str(tmp_path / "in"), rows, ATTEMPT_SCHEMA, "started_at")
    query = run_to_files(ordered.due_retries(stream, "300 days"), tmp_path)
    assert max(progress["stateOperators"][0]["numRowsTotal"] for progress in query.recentProgress) < 6000
    schedule = delivery.retry_schedule(delivery.with_trials(spark.createDataFrame(rows, ATTEMPT_SCHEMA))).where(
        "decision = 'retry' and finished_at is not null")
    names = ("digest_id", "part_number", "attempt_number", "trial", "delay_seconds")
    order = lambda row: (row[0] is None, row)
    want = sorted((tuple(row) for row in schedule.select(*names).collect()), key=order)
    got = sorted((tuple(row) for row in spark.read.parquet(str(tmp_path / "out")).select(*names).collect()), key=order)
    assert got == want and len(got) > 4000 and any(row[0] is None for row in got) and any(row[0] == big for row in got)


class _Calls:
    """State variables in memory, with a count of calls."""

    def __init__(self):
        self.count = 0

    def getListState(self, name, schema):
        return _Held(self, [])

    def getMapState(self, name, key_schema, schema):
        return _Held(self, {})


class _Held:
    def __init__(self, calls, value):
        self.calls, self.value = calls, value

    def __getattribute__(self, name):
        if name not in ("calls", "value"):
            object.__getattribute__(self, "calls").count += 1
        return object.__getattribute__(self, name)

    def get(self):
        return iter(self.value)

    def appendList(self, rows):
        self.value = [*self.value, *rows]

    def put(self, rows):
        self.value = rows

    def clear(self):
        self.value = []

    def getValue(self, key):
        return self.value[key]

    def updateValue(self, key, row):
        self.value[key] = row

    def removeKey(self, key):
        del self.value[key]


def test_a_release_reads_the_pieces_it_reaches(monkeypatch):
    monkeypatch.setattr(ordered, "PIECE_ROWS", 10)
    calls = _Calls()
    held = ordered.TimedRows(calls, "held", [("at_us", "bigint"), ("tie", "bigint")], "at_us")
    held.add(pd.DataFrame({"at_us": range(999, -1, -1), "tie": range(1000)}))
    calls.count = 0
    due, least = held.take(4)
    assert due["at_us"].tolist() == [0, 1, 2, 3, 4] and least == 5 and calls.count < 8
    due, least = held.take(-1)
    assert not len(due) and least == 5
    held.add(pd.DataFrame({"at_us": [2], "tie": [7]}))
    due, least = held.take(500)
    assert sorted(due["at_us"]) == [2, *range(5, 501)] and least == 501
    due, least = held.take(5000)
    assert sorted(due["at_us"]) == list(range(501, 1000)) and least is None
    assert held.parts.value == {} and held.listed.value == []
