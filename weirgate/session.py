"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import contextlib
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Settings the library is designed for. They are runtime settings, so a caller's session keeps its own.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Without call sites for every column, building a large expression takes a fraction of the time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Whole pages and documents go to Python workers: bound a batch by bytes, not only by rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "weirgate", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session to UTC: every timestamp in the data model is UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Jobs inside send batches of at most about ``limit`` bytes to Python. A batch is held as Arrow vectors and as a message by the
    executor, and again by its worker: without it that is a whole input partition. The caller's setting comes back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own; on a cluster a
    machine-local folder would be lost with its machine, so the setting is required there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    chosen = getattr(context, "_weirgate_folder", None)
    if chosen is None:
        chosen = tempfile.mkdtemp(prefix="weirgate-")
        context._weirgate_folder = chosen
    return chosen


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Materialise ``frame`` with a reliable checkpoint, so a lost executor costs no recomputation chain."""
    spark = frame.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return frame.checkpoint(eager=True)
