"""Cascades, versioned tables, Bloom prefilters, version differences, numbered warnings, admission of crossing chains."""

import itertools
import random
import threading
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from weirgate.functions import bloom
from weirgate.operators import cascade, components, differ, intake, news, prefilter, runs, state
from weirgate.operators.cascade import Reference
from weirgate.sources import config, feeds
from weirgate.sources.versions import CommitConflict, VersionedTable

START = datetime(2026, 1, 1, tzinfo=timezone.utc)


# Cascades ------------------------------------------------------------------------------------------------------------------

def deletable(tables, references, asked):
    """The largest set of rows that can go, row by row: {(table, key): outcome}."""
    children = defaultdict(list)
    for one in references:
        for key, row in tables[one.child].items():
            if row.get(one.column) is not None:
                children[one.parent, row[one.column], one.action].append((one.child, key))
    seeds = {(table, key) for table, keys in asked.items() for key in keys if key in tables[table]}
    reached, front = set(seeds), list(seeds)
    while front:
        node = front.pop()
        for child in children[(*node, "cascade")]:
            if child not in reached:
                reached.add(child)
                front.append(child)
    going, blocked = set(reached), set()
    while True:
        bad = {node for node in going if any(child not in going for action in ("cascade", "restrict")
                                             for child in children[(*node, action)])}
        blocked |= bad
        rest = going - bad
        alive = {node for node in rest if node in seeds}
        front = list(alive)
        while front:
            for child in children[(*front.pop(), "cascade")]:
                if child in rest and child not in alive:
                    alive.add(child)
                    front.append(child)
        if alive == going:
            break
        going = alive
    return {node: "deleted" if node in going else "blocked" if node in blocked else "kept" for node in reached}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cascades_over_several_levels(spark, seed):
    chooser = random.Random(seed)
    references = [Reference("b", "a_id", "a", "cascade"), Reference("c", "b_id", "b", "cascade"), Reference("d", "c_id", "c", "cascade"),
                  Reference("d", "a_id", "a", "restrict"), Reference("e", "b_id", "b", "restrict"), Reference("c", "up", "c", "cascade")]
    tables = {"a": {k: {} for k in range(12)},
              "b": {k: {"a_id": chooser.randrange(14)} for k in range(20)},
              "c": {k: {"b_id": chooser.randrange(22), "up": chooser.choice([None, None, chooser.randrange(30)])} for k in range(30)},
              "d": {k: {"c_id": chooser.randrange(90), "a_id": chooser.choice([None, None, None, chooser.randrange(12)])} for k in range(25)},
              "e": {k: {"b_id": chooser.randrange(60)} for k in range(10)}}
    asked = {"a": [0, 1, 2, 3, 4, 5, 99], "b": [0, 7], "e": [0, 1, 2, 3]}
    columns = {"a": [], "b": ["a_id"], "c": ["b_id", "up"], "d": ["c_id", "a_id"], "e": ["b_id"]}
    frames = {name: (spark.createDataFrame([(k, *[row.get(c) for c in columns[name]]) for k, row in rows.items()],
                                           ", ".join(f"{c} int" for c in ("id", *columns[name]))), "id") for name, rows in tables.items()}
    wanted = {name: spark.createDataFrame([(k,) for k in keys], "id int") for name, keys in asked.items()}
    closure = cascade.delete_closure(frames, references, wanted)
    got = {(row.table, int(row.key)): row.outcome for row in closure.collect()}
    assert got == deletable(tables, references, asked)
    left = cascade.remaining(frames["c"][0], "c", "id", closure)
    assert {row.id for row in left.collect()} == {k for k in tables["c"] if got.get(("c", k)) != "deleted"}


def test_a_run_goes_through_digest_items_and_attempts(spark):
    table = lambda rows, schema: (spark.createDataFrame(rows, schema), "id")
    tables = {"runs": table([(1,), (2,)], "id int"), "digests": table([(10, 1), (20, 2)], "id int, run int"),
              "items": table([(100, 10), (101, 10), (200, 20)], "id int, digest int"),
              "attempts": table([(7, 10), (8, 20)], "id int, digest int")}
    references = [Reference("digests", "run", "runs", "restrict"), Reference("items", "digest", "digests", "cascade"),
                  Reference("attempts", "digest", "digests", "cascade")]
    run = tables["runs"][0].where("id = 1")
    alone = cascade.delete_closure(tables, references, {"runs": run})
    assert [(row.table, row.key, row.outcome) for row in alone.collect()] == [("runs", "1", "blocked")]
    both = cascade.delete_closure(tables, references, {"runs": run, "digests": tables["digests"][0].where("id = 10")})
    assert {(row.table, row.key): row.outcome for row in both.collect()} == dict.fromkeys(
        [("runs", "1"), ("digests", "10"), ("items", "100"), ("items", "101"), ("attempts", "7")], "deleted")
    with pytest.raises(ValueError):
        Reference("a", "b", "c", "ignore")


# Versioned tables ----------------------------------------------------------------------------------------------------------

def test_versions_deletes_and_compaction(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    table.append(spark.range(100).withColumn("x", F.col("id") % 7).repartition(3))
    table.append(spark.range(100, 120).withColumn("x", F.lit(None).cast("bigint")))
    held = table.manifest()
    table.delete(F.col("x") == 3)
    after = table.manifest()
    assert after.data == held.data and len(after.deletes) == 1  # nothing else was written
    deleted = spark.read.parquet(f"{table.path}/deletes/{after.deletes[0]}")
    assert deleted.columns == ["_file", "_row"] and deleted.count() == 14
    table.delete((F.col("x") == 3) | (F.col("id") < 10))
    want = sorted(k for k in range(120) if k >= 10 and (k >= 100 or k % 7 != 3))
    assert sorted(row.id for row in table.read().collect()) == want
    assert table.read(2).count() == 120  # older versions stay readable
    table.compact()
    assert sorted(row.id for row in table.read().collect()) == want and table.manifest().deletes == []
    assert table.version() == 5


def test_of_two_writers_one_fails_cleanly(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.append(spark.range(5))
    base, outcomes = table.version(), []

    def write(first):
        try:
            VersionedTable(spark, table.path).append(spark.range(first, first + 5), base)
            outcomes.append("done")
        except CommitConflict:
            outcomes.append("conflict")

    writers = [threading.Thread(target=write, args=(first,)) for first in (10, 20, 30)]
    for one in writers:
        one.start()
    for one in writers:
        one.join()
    assert sorted(outcomes) == ["conflict", "conflict", "done"]
    rows = sorted(row.id for row in table.read().collect())
    assert rows[:5] == [0, 1, 2, 3, 4] and len(rows) == 10 and rows[5] in (10, 20, 30)
    assert [name for name in (tmp_path / "t/log").iterdir() if name.name.startswith("_")] == []
    table.append(spark.range(50, 55))  # goes on from the winner
    assert table.read().count() == 15


# Bloom filters -------------------------------------------------------------------------------------------------------------

def test_bloom_filter():
    source = np.random.default_rng(1)
    keys = source.integers(-2 ** 62, 2 ** 62, 5000)
    held = bloom.made(keys)
    assert bloom.may_hold(held, keys).all()
    assert bloom.may_hold(held, source.integers(-2 ** 62, 2 ** 62, 20000)).mean() < 0.03
    assert len(held) * 8 == bloom.bits_for(5000)
    assert not bloom.may_hold(bloom.made(keys[:0]), keys).any()


def test_prefilter_keeps_what_can_join(spark, monkeypatch):
    stored = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("n"))
    batch = spark.range(0, 600, 3).select(F.col("id").cast("string").alias("key"), (F.col("id") + 30_000).alias("m")).unionByName(
        spark.createDataFrame([(None, None)], "key string, m bigint"))
    for slices in (prefilter.SLICE_KEYS, 50):  # one filter, and several
        monkeypatch.setattr(prefilter, "SLICE_KEYS", slices)
        likely = prefilter.only_likely(stored, batch, (["k"], ["key"]))
        kept = {row.k for row in likely.collect()}
        assert {str(k) for k in range(0, 600, 3)} <= kept and len(kept) < 200 + 1500
        either = {row.k for row in prefilter.only_likely(stored, batch, (["k"], ["key"]), (["n"], ["m"])).collect()}
        assert {str(k) for k in range(0, 600, 3)} | {str(k) for k in range(30_000, 30_600, 3)} <= either and len(either) < 400 + 2500
    monkeypatch.setattr(prefilter, "MOST_KEYS", 10)
    assert prefilter.only_likely(stored, batch, (["k"], ["key"])) is stored


def test_prefilter_runs_before_the_shuffle(spark):
    stored = spark.range(20_000).select(F.concat(F.lit("h"), F.col("id")).alias("file_hash"), F.lit("2026").alias("processed_at"),
                                        F.lit("processed").alias("status"))
    new = spark.createDataFrame([(f"h{k}",) for k in range(0, 500, 10)], "file_hash string")
    likely = prefilter.only_likely(stored, new, (["file_hash"], ["file_hash"]))
    found = intake.mark_duplicates(new, likely)
    assert found.where("is_duplicate").count() == 50
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange") < text.index("words") and "EvalPython" not in text  # the filter is below the shuffle, on the JVM
    assert likely.count() < 50 + 1000


# Version differences -------------------------------------------------------------------------------------------------------

def test_only_differing_buckets_are_joined(spark):
    before = spark.range(20_000).select("id", F.lit("manual").alias("trigger"), F.when(F.col("id") % 2 == 0, "done").otherwise("running")
                                        .alias("status"), F.when(F.col("id") % 5 != 0, F.col("id")).alias("n"))
    after = before.withColumn("n", F.when(F.col("id") == 4000, 1).when(F.col("id") == 15, 7).otherwise(F.col("n"))).withColumn(
        "trigger", F.when(F.col("id") == 9001, "x").otherwise(F.col("trigger"))).where("id <> 77").unionByName(
        spark.createDataFrame([(30_000, "manual", "done", 1)], before.schema))
    columns = ["trigger", "status", "n"]
    parts = differ.changed_parts(before, after, "id", columns)
    counts = [one.count() for one in parts]
    assert max(counts) < 40 and min(counts) > 3  # five buckets of 262,144 differ
    want = state.terminal_immutability(before, after, "id", ["trigger"], "running", ["n"]).collect()
    got = state.terminal_immutability(*parts, "id", ["trigger"], "running", ["n"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) == 2
    assert [one.count() for one in differ.changed_parts(before, before, "id", columns)] == [0, 0]
    swapped = before.withColumn("n", F.when(F.col("id") == 1, 2).when(F.col("id") == 2, 1).otherwise(F.col("n")))
    for levels, branch in ((1, 1), (2, 8)):  # differences inside one bucket do not cancel out
        assert differ.changed_parts(before, swapped, "id", columns, levels, branch)[0].count() > 0


# Numbered warnings ---------------------------------------------------------------------------------------------------------

def test_warning_lines_are_bounded(spark):
    rows = spark.range(1000).select(F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("source_key"),
                                    (F.col("id") % 4).alias("consecutive_failures")).repartition(7)
    lines = runs.noisy_feed_lines(rows, 2, per_line=30).orderBy("line").collect()
    keys = [f"s{k:04d}" for k in range(1000) if k % 4 >= 2]
    assert [row.line for row in lines] == list(range(1, 18)) and {row.noisy for row in lines} == {500}
    head = "One or more feeds exceeded the consecutive failure threshold: "
    assert [row.warning for row in lines] == [head + ", ".join(keys[k:k + 30]) for k in range(0, 500, 30)]
    assert [row["keys"] for row in lines] == [30] * 16 + [20]
    assert runs.noisy_feed_lines(rows, 9).collect() == []


# Admission -----------------------------------------------------------------------------------------------------------------

def sequential(rows):
    urls, externals, admitted = set(), set(), []
    for _, url, external in rows:
        fresh = url not in urls and (external is None or external not in externals)
        if fresh:
            urls.add(url)
            externals.add(external)
        admitted.append(fresh)
    return admitted


def crossing(count, seed):
    """Rows that each share a key with one of the last few rows on either side: chains that cross all the time."""
    chooser = random.Random(seed)
    rows = []
    for k in range(count):
        back = [chooser.randrange(max(k - 4, 0), k + 1) for _ in range(2)]
        rows.append((k, f"u{back[0]}", None if chooser.random() < 0.05 else f"e{back[1]}"))
    return rows


def counted(monkeypatch):
    calls = []
    for module in (news, components):
        monkeypatch.setattr(module, "cut_lineage", lambda frame, held=module.cut_lineage: calls.append(1) or held(frame))
    rounds = []
    walk = news._walked
    monkeypatch.setattr(news, "_walked", lambda *given: rounds.append(1) or walk(*given))
    return calls, rounds


def test_crossing_chains_take_few_rounds(spark, monkeypatch):
    calls, rounds = counted(monkeypatch)
    data = crossing(10_000, 3)
    got = news.admit_in_batch(spark.createDataFrame(data, "n int, url_hash string, ext_key string").repartition(4), "n")
    assert [row.admitted for row in got.orderBy("n").collect()] == sequential(data)
    assert len(rounds) <= 2 and len(calls) <= 60


def test_components_larger_than_a_walk(spark, monkeypatch):
    monkeypatch.setattr(news, "WALKED", 50)
    monkeypatch.setattr(news, "CHAIN_ROUND", 2)
    data = crossing(400, 5)
    got = news.admit_in_batch(spark.createDataFrame(data, "n int, url_hash string, ext_key string").repartition(2), "n")
    assert [row.admitted for row in got.orderBy("n").collect()] == sequential(data)


def test_components(spark):
    chooser = random.Random(2)
    edges = [(chooser.randrange(300), chooser.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1040)]
    label = {node: node for node in itertools.chain(*edges)}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {row.node: row.component for row in components.components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {node: one for node, one in label.items() if any(node in edge and edge[0] != edge[1] for edge in edges)}


@pytest.mark.parametrize("more", [[], [(5, 5)], [(0, 1000), (1001, 2000), (2000, 3000), (7, 8), (4000, 4001)]])
def test_components_grow_with_more_edges(spark, more):
    first = [(k, k + 10) for k in range(40)] + [(k, k + 1) for k in range(1000, 1005)]
    frame = lambda edges: spark.createDataFrame(edges, "a int, b int")
    found = lambda nodes: {row.node: row.component for row in nodes.collect()}
    nodes = components.components(frame(first))
    want = found(components.components(frame(first + more)))
    assert found(components.extended(nodes, frame(more))) == want
    assert found(components.extended(components.components(frame([])), frame(first + more))) == want


# Readers -------------------------------------------------------------------------------------------------------------------

def test_entries_are_numbered_over_blocks(spark, tmp_path):
    for name, count in (("a", 400), ("b", 3), ("c", 0)):
        items = "".join(f"<item><guid>{name}-{k}</guid><title>{'t' * 50} {k}</title></item>\n" for k in range(count))
        (tmp_path / f"{name}.xml").write_text(f"<channel>\n{items}</channel>\n")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        rows = feeds.scan_feed_entries(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert sorted((row.external_id.split("-")[0], row.entry_index) for row in rows) == [
        *[("a", k) for k in range(400)], *[("b", k) for k in range(3)]]
    assert all(row.external_id.endswith(f"-{row.entry_index}") for row in rows)


def test_configuration_by_any_path(spark, tmp_path):
    spark.range(1).select(F.lit("version: 1\ninclude_keywords: [' AI ']\n")).write.text(str(tmp_path / "profile"))
    assert config.load_topic_profile(str(tmp_path / "profile"), spark).include_keywords == ("ai",)
    (tmp_path / "one.yaml").write_text("version: 1\ninclude_keywords: [x]\nextra: 1\n")
    with pytest.raises(ValueError):
        config.load_topic_profile(str(tmp_path / "one.yaml"), spark)
