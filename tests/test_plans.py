"""Physical plans: what reaches the scan, where Python runs, and that no window is global."""

import re

import pytest

from weirgate.plans.registry import all_queries

QUERIES = all_queries()
STREAMS = {name for name in QUERIES if name.startswith("stream_")}
#: Queries that need real URL, IP or HTML parsing.
PYTHON = {"entry_normalize", "html_sanitize", "url_canonicalize", "url_policy"}


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def plans(spark, folder):
    return {name: plan(query.run(spark, folder)) for name, query in QUERIES.items() if name not in STREAMS}


def test_python_runs_only_where_needed(plans):
    using = {name for name, text in plans.items() if re.search(r"ArrowEvalPython|BatchEvalPython|InPandas", text)}
    assert using == PYTHON


def test_no_cross_joins(plans):
    assert not [name for name, text in plans.items() if "CartesianProduct" in text or "BroadcastNestedLoopJoin" in text]


def test_no_global_windows(plans):
    """A window without a partition key would put a table into one task; only the one-run ranking of the at most 25
    chosen candidates has a single partition."""
    found = set()
    for name, text in plans.items():
        for block in re.findall(r"\(\d+\) Window\n(.*?)\n\n", text, re.S):
            if re.search(r"Arguments: \[.*\], \[[^\[\]]*(ASC|DESC)[^\[\]]*\]\s*$", block) and "windowspecdefinition(run_id" \
                    not in block and re.search(r"\], \[\], ", block):
                found.add(name)
    assert found == set()


def test_scans_read_only_needed_columns(plans):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plans["unique_check"]).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == {"l_orderkey", "l_linenumber"}
    sources = re.findall(r"ReadSchema: struct<([^>]*)>", plans["source_list"])
    assert all({field.split(":")[0] for field in schema.split(",")} == {"source"} for schema in sources)


def test_rank_filter_is_a_group_limit(plans):
    assert plans["news_select_top"].count("WindowGroupLimit") >= 2
    assert "TakeOrderedAndProject" in plans["news_select_top"]


def test_top_k_reports_do_not_sort_everything(plans):
    for name in ("news_eligible", "latest_records"):
        assert "TakeOrderedAndProject" in plans[name]


def test_hot_key_is_split_in_lookups(spark):
    """A third of the new rows share a hash: the adaptive join splits that partition."""
    from pyspark.sql import functions as F
    from weirgate.operators import intake

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        new = spark.range(300_000, numPartitions=8).select(
            F.sha2(F.col("id").cast("string"), 512).alias("text"), F.sha2(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string"), 256).alias("file_hash"))
        audit = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("file_hash"),
                                         F.col("id").cast("string").alias("processed_at"), F.lit("processed").alias("status"))
        marked = intake.mark_duplicates(new, audit)
        result = marked.groupBy("is_duplicate").agg(F.count(F.lit(1)).alias("count"), F.max("text"))
        rows = {row.is_duplicate: row["count"] for row in result.collect()}
        final = result._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert rows == {True: 100_000 + 666, False: 199_334}
    assert "skew=true" in final
