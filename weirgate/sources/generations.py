"""Keyed state on plain files that each micro-batch adds to without rewriting it.

A batch writes the entries of its own keys as one run. Whenever ``fanout`` runs of a level are there, they are merged, newest last,
into one run of the next level, so batch ``n`` finds at most ``(fanout - 1) * log(n)`` runs, and an entry is rewritten once a
level. Which runs exist before batch ``n`` follows from ``n`` alone: batch ``n`` reads only those, writes one folder in overwrite mode, and a
repeated batch gives the same files. Runs that were merged away are removed by the batch after the one that merged them, which
can not be repeated by then.

A run is cut into buckets by the hash of the key, ``fanout`` times as many on each level, so a bucket stays about as large as that
of a first run. Each has a Bloom filter in a file of its own. A batch opens the filters of the buckets its keys fall into, and
the entries of those buckets where a filter says that a key may be there; both are folders of a partitioned table. So
what a batch reads follows from its own keys, not from how much is stored.

The driver holds the numbers of buckets that are hit, never keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weirgate.functions import bloom

FANOUT, BUCKETS = 4, 16


def _checked(left: pa.Table, right: pa.Table) -> pa.Table:
    """Keys of the left side (one run and bucket) that the filter on the right may hold."""
    if not left.num_rows or not right.num_rows:
        return left.slice(0, 0).select(["_run", "_bucket", "_hash"])
    held = bloom.may_hold(right.column("filter")[0].as_py(), left.column("_hash").to_numpy())
    return left.select(["_run", "_bucket", "_hash"]).filter(pa.array(held))


def _filter_of(table: pa.Table) -> pa.Table:
    hashes = np.unique(table.column("_hash").to_numpy())
    return pa.table({"_bucket": table.column("_bucket").slice(0, 1), "filter": pa.array([bloom.made(hashes)], pa.binary())})


class Generations:
    """Entries by key under ``path``. ``values`` are the columns besides ``key``; ``merge`` reduces entries of one key, given with
    the number of their batch as ``_batch``, to the columns ``values`` (aggregates by name)."""

    def __init__(self, path: str, key: str, values: Sequence[str] = (), merge: Callable[[], list[Column]] = list,
                 buckets: int = BUCKETS, fanout: int = FANOUT) -> None:
        self.path, self.key, self.values, self.merge = path, key, list(values), merge
        self.buckets, self.fanout = buckets, fanout
        #: Folders that the last ``find`` opened.
        self.opened: list[str] = []

    def runs(self, number: int) -> list[tuple[int, int]]:
        """(level, last batch) of the runs that batch ``number`` finds, oldest first."""
        found, level, size, batches = [], 0, 1, number
        while size * self.fanout <= number:
            level, size = level + 1, size * self.fanout
        done = 0
        while size:
            for _ in range((batches - done) // size):
                done += size
                found.append((level, done - 1))
            level, size = level - 1, size // self.fanout
        return found

    def level_of(self, number: int) -> int:
        """The level of the run that batch ``number`` writes."""
        level, size = 0, self.fanout
        while (number + 1) % size == 0:
            level, size = level + 1, size * self.fanout
        return level

    def _run(self, level: int, last: int) -> str:
        return f"r{last:09d}-{level:02d}"

    def _hash(self) -> Column:
        return F.xxhash64(F.col(self.key))

    def _bucket(self, level: int) -> Column:
        return F.pmod(F.col("_hash"), F.lit(self.buckets * self.fanout ** level)).cast("int")

    def find(self, keys: DataFrame, number: int) -> DataFrame | None:
        """Entries of earlier batches than ``number`` for the ``keys``, merged to one row a key; None where there are none."""
        spark, self.opened = keys.sparkSession, []
        runs = self.runs(number)
        if not runs:
            return None
        wanted = keys.select(self.key).distinct().withColumn("_hash", self._hash())
        each = F.explode(F.array(*[F.struct(F.lit(self._run(*run)).alias("_run"), self._bucket(run[0]).alias("_bucket"))
                                   for run in runs]))
        placed = wanted.select("_hash", each.alias("_at")).select("_at._run", "_at._bucket", "_hash")
        filters = self._open(spark, "filters", placed, runs)
        if filters is None:
            return None
        likely = placed.groupBy("_run", "_bucket").cogroup(filters.groupBy("_run", "_bucket")).applyInArrow(
            _checked, "_run string, _bucket int, _hash bigint")
        held = self._open(spark, "entries", likely, runs)
        if held is None:
            return None
        return self._merged(held.join(wanted.select(self.key), self.key, "left_semi"))

    def _open(self, spark: SparkSession, kind: str, hits: DataFrame, runs: list[tuple[int, int]]) -> DataFrame | None:
        """The rows of the buckets that are hit."""
        some = [(row["_run"], row["_bucket"]) for row in hits.select("_run", "_bucket").distinct().collect()]
        root = f"{self.path}/{kind}"
        there = {run: self._names(spark, f"{root}/_run={run}") for run in {run for run, _ in some}}
        folders = sorted(f"{root}/_run={run}/_bucket={bucket}" for run, bucket in some if f"_bucket={bucket}" in there[run])
        self.opened += folders
        if not folders:
            return None
        return spark.read.option("basePath", root).parquet(*folders).withColumn("_bucket", F.col("_bucket").cast("int"))

    def _merged(self, entries: DataFrame) -> DataFrame:
        if not self.values:
            return entries.select(self.key).distinct()
        return entries.groupBy(self.key).agg(*self.merge())

    def add(self, entries: DataFrame, number: int) -> None:
        """Write the entries of batch ``number``: one row for each key, ``key`` and ``values``."""
        spark = entries.sparkSession
        level = self.level_of(number)
        size = self.fanout ** level
        rows = entries.select(self.key, *self.values, F.lit(number).cast("bigint").alias("_batch"))
        inside = [run for run in self.runs(number) if run[1] > number - size]
        inside = [run for run in inside if any(name.startswith("_bucket=") for name in self._names(
            spark, f"{self.path}/entries/_run={self._run(*run)}"))]
        if inside:
            root = f"{self.path}/entries"
            older = spark.read.option("basePath", root).parquet(*[f"{root}/_run={self._run(*run)}" for run in inside])
            rows = rows.unionByName(older.select(self.key, *self.values, "_batch"))
            merged = rows.groupBy(self.key).agg(*self.merge(), F.max("_batch").alias("_batch"))
            rows = merged.select(self.key, *self.values, "_batch")
        target = self._run(level, number)
        hashed = rows.withColumn("_hash", self._hash()).withColumn("_bucket", self._bucket(level))
        hashed.repartition("_bucket").drop("_hash").write.mode("overwrite").partitionBy("_bucket").parquet(
            f"{self.path}/entries/_run={target}")
        if not any(name.startswith("_bucket=") for name in self._names(spark, f"{self.path}/entries/_run={target}")):
            return  # no entries, so no buckets
        written = spark.read.parquet(f"{self.path}/entries/_run={target}")
        written.select(F.col("_bucket").cast("int").alias("_bucket"), self._hash().alias("_hash")).groupBy("_bucket").applyInArrow(
            _filter_of, "_bucket int, filter binary").write.mode("overwrite").partitionBy("_bucket").parquet(
            f"{self.path}/filters/_run={target}")

    def forget(self, spark: SparkSession, number: int) -> list[str]:
        """Remove runs that neither batch ``number`` nor a later one can read; returns their names."""
        kept = {self._run(*run) for run in self.runs(number)}
        gone = []
        for kind in ("entries", "filters"):
            for name in sorted(self._names(spark, f"{self.path}/{kind}")):
                run = name.removeprefix("_run=")
                if name.startswith("_run=") and run not in kept and int(run[1:].split("-")[0]) < number:
                    place = self._path(spark, f"{self.path}/{kind}/{name}")
                    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
                    gone.append(f"{kind}/{run}")
        return gone

    @staticmethod
    def _path(spark: SparkSession, path: str):
        return spark._jvm.org.apache.hadoop.fs.Path(path)

    def _names(self, spark: SparkSession, path: str) -> set[str]:
        """Names in a folder; none where it does not exist."""
        location = self._path(spark, path)
        files = location.getFileSystem(spark._jsc.hadoopConfiguration())
        return {status.getPath().getName() for status in files.listStatus(location)} if files.exists(location) else set()


class KeyIndex(Generations):
    """The keys that earlier batches have stored."""

    def __init__(self, path: str, key: str, buckets: int = BUCKETS, fanout: int = FANOUT) -> None:
        super().__init__(path, key, (), list, buckets, fanout)

    def fresh(self, rows: DataFrame, number: int) -> DataFrame:
        """``rows`` whose key no earlier batch has stored. Rows without a key are kept."""
        known = self.find(rows.where(F.col(self.key).isNotNull()), number)
        return rows if known is None else rows.join(known, self.key, "left_anti")
