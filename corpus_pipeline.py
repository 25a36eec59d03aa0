"""The corpus pipeline: quality rules, near duplicates, personal data, source mixing, packing.

Each stage is one operator of ``weirgate.llm``. It takes what the stage before it kept as ``docs``, with the columns of
``documents``, and its decisions take effect: rejected documents and all but one of each group of near duplicates go,
personal data is replaced in the texts, and documents come as often as the mixture asks for. The last stage returns each
piece's place in its document and in its sequence. Null texts fail the quality rules; a null id is kept as it is.
Documents that come several times in the mixture are packed as often. Extra columns travel along up to the packing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirgate.llm.common import free_name
from weirgate.llm.mixing import EVENNESS, mixed, realised
from weirgate.llm.near_dedup import FEW_IDS, PERCENT, near_duplicates
from weirgate.llm.packing import pack_documents
from weirgate.llm.pii import redact_column
from weirgate.llm.quality import kept_rows
from weirgate.llm.token_counts import tokenizer_file
from weirgate.session import arrow_batches, cut_lineage, shared_folder


#: Bytes of a batch that goes to Python: workers and executors hold what several stages left, so each should need little.
BATCH = 1 << 20


def _sparing(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The jobs that ``stage`` runs by itself take small batches; what its result computes follows the caller's setting."""

    @wraps(stage)
    def run(spark: SparkSession, *given, **named) -> DataFrame:
        with arrow_batches(spark, BATCH):
            return stage(spark, *given, **named)

    return run


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


@_sparing
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the risk-controlled thresholds keep."""
    return kept_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_sparing
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: float = PERCENT) -> DataFrame:
    """One row of each group of near duplicates (similar by ``percent`` or more): the one with the smallest id. Every row is a
    document of its own here, whatever its id: the number it is known by is written once, so that all reads of it agree."""
    row, first = free_name(docs.columns, "_row"), free_name(docs.columns, "_first")
    folder = f"{shared_folder(spark)}/near-duplicates-{uuid4().hex}"
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(folder)
    rows = spark.read.parquet(folder)
    groups = near_duplicates(rows, percent, id_column=row).select(F.col("doc_id").alias(row), F.col("component_id").alias("component"))
    later = cut_lineage(groups.filter(F.col(row) != F.col("component")))
    members = later.unionByName(later.select(F.col("component").alias(row), "component").distinct())
    stays = (members.join(rows.select(row, "doc_id"), row).groupBy("component")
             .agg(F.min(F.struct("doc_id", row)).alias(first)).select(f"{first}.{row}"))
    # Most documents stay: those that go are named to the scan while they are few, so that no text is shuffled.
    gone = cut_lineage(members.join(stays, row, "left_anti").select(row))
    return rows.join(F.broadcast(gone) if gone.count() <= FEW_IDS else gone, row, "left_anti").drop(row)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _with_length(redact_column(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of their sources holds them, at least once."""
    tokens = free_name(docs.columns, "_tokens")
    names = {"tokens_as": tokens, "copies_as": free_name([*docs.columns, tokens], "_copies")}
    return realised(mixed(docs, evenness=EVENNESS, **names), **names)


@_sparing
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences and offsets. Workers still hold what earlier stages left, so memory is spared."""
    return pack_documents(docs, tokenizer_file(), with_ids=False, lean=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_dedup_stage),
    ("personal_data", pii_stage),
    ("source_mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the stages; the tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{number}-{name}")
            docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
