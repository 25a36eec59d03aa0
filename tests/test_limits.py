"""Inputs beyond the contract's sizes: nothing is dropped silently."""

import pytest
from pyspark.sql import functions as F

from weirgate import constants as C
from weirgate.functions.numbers import plain_number
from weirgate.operators import digest, intake, state
from weirgate.plans import tables as t
from weirgate.sources import feeds


def _lines(spark, items, title="T"):
    rows = [(1, position, news, title, "PRODUCT", "s", "https://x.org/a", "S", title is None) for position, news in items]
    return spark.createDataFrame(rows, "digest_id long, position int, news_item_id long, title string, tag string, "
                                       "summary string, canonical_url string, source_name string, missing_parent boolean")


@pytest.mark.parametrize("items, error", [
    ([(k, k) for k in range(1, 8)], None),
    ([(k, k) for k in range(1, 9)], "Digest must contain between 1 and 7 items"),
    ([(1, 1), (1, 2), (1, 3)], "Digest item positions must be unique"),
    ([(1, 5), (2, 5)], "Digest news items must be unique"),
    ([(1, 1), (3, 2)], "Digest item positions must be consecutive starting at 1"),
    ([(0, 1), (1, 2)], "Digest item positions must be consecutive starting at 1"),
    ([(None, 1)], "Digest item positions must be consecutive starting at 1"),
])
def test_broken_digests_are_not_rendered(spark, items, error):
    lines = _lines(spark, items)
    assert digest.check_positions(lines).first().position_error == error
    blocks = digest.digest_blocks(lines).withColumn("digest_title", F.lit("D"))
    row = digest.split_messages(digest.render_digest(blocks)).first()
    assert row.items == len(items) and row.digest_error == error and row.split_error == error
    assert (row.rendered_text is None) == (error is not None) == (row.parts is None)


def test_missing_parent_fails_the_digest(spark):
    row = digest.render_digest(digest.digest_blocks(_lines(spark, [(1, 1)], None)).withColumn("digest_title", F.lit("D"))).first()
    assert row.digest_error == C.DIGEST_UNUSABLE and row.rendered_text is None


def test_many_candidates_keep_their_ids(spark):
    rows = spark.range(130).select(
        F.lit(1).alias("run_id"), F.col("id").alias("news_item_id"), (-F.col("id")).cast("double").alias("score"),
        F.lit("t").alias("title"), F.lit("s").alias("source_name"), F.lit("x").alias("sanitized_summary"),
        F.lit(None).cast("timestamp").alias("published_at"))
    ids = [row.candidate_id for row in digest.candidate_ids(rows).orderBy("rank").collect()]
    assert len(set(ids)) == 130 and ids[0] == "c_01" and ids[9] == "c_10" and ids[99] == "c_100"
    row = digest.article_payload(digest.candidate_ids(rows)).first()
    assert row.articles_json is None and row.payload_error == "a request holds at most 25 articles, got 130"


def test_null_fields_are_breaches(spark):
    kind = ("run_id int, output struct<items:array<struct<candidate_id:string,summary:string,tag:string,"
            "relevance_score:double,selection_reason:string>>>")
    outputs = spark.createDataFrame([(1, ([(None, None, None, None, None), ("c_01", None, "PRODUCT", 0.5, "r")],))], kind)
    contexts = spark.createDataFrame([(1, f"c_0{k}", f"n{k}", "candidate") for k in range(1, 4)],
                                     "run_id int, candidate_id string, news_item_id string, status string")
    row = digest.validate_digest_output(outputs, contexts, minimum=1).first()
    assert row.errors == ["unknown candidate_id ", "summary length must be between 80 and 280 characters"]
    assert not row.accepted and row.news_ids is None
    foreign = contexts.unionByName(spark.createDataFrame([(1, "c_100", "n", "candidate")], contexts.schema))
    assert "candidate ids must be c_ and two digits" in digest.validate_digest_output(outputs, foreign).first().errors


@pytest.mark.parametrize("value, text", [
    (999999999999999.0, "999999999999999"), (1e15, "1000000000000000"), (1e20, "100000000000000000000"), (1e-7, "1e-7"),
    (-1e18, "-1000000000000000000"), (0.1, "0.1")])
def test_large_numbers_print_all_digits(spark, value, text):
    assert spark.range(1).select(plain_number(F.lit(value)).alias("x")).first().x == text


def test_every_order_line_is_in_a_digest(spark, folder):
    items = t.digest_items(spark, folder)
    assert items.count() == t.table(spark, folder, "lineitem").count()
    assert items.groupBy("digest_id", "position").count().where("count > 1 or position not between 1 and 7").count() == 0


def test_several_requests_for_one_key_change_nothing(spark):
    rows = spark.createDataFrame([("a", "collected", None), ("b", "collected", None)],
                                 "news_item_id string, status string, ignore_reason string")
    asked = spark.createDataFrame([("a", "candidate", None), ("a", "used", None), ("b", "candidate", None)],
                                  "news_item_id string, target_status string, request_reason string")
    got = {row.news_item_id: row for row in state.apply_transitions(rows, asked).collect()}
    assert len(got) == 2 and got["a"].status == "collected" and got["a"].transition_error
    assert got["b"].status == "candidate"


def test_blank_content_type_counts_as_absent(spark):
    row = spark.createDataFrame([(200, " ", 10, "plain", 3, None)], "http_status int, content_type string, body_bytes int, "
                                "body_prefix string, entries_count int, error_code string")
    assert feeds.classify_fetch(row, 100).first().fetch_status == "success"


def test_difference_reduces_the_right_side(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,)] * 5 + [(None,)], "k int")
    assert sorted((row.k for row in intake.difference(left, right, "k").collect()), key=str) == [2, None]


def test_a_long_chain_is_admitted_in_few_rounds(spark, monkeypatch):
    from weirgate.operators import news

    cuts = []
    real = news.cut_lineage
    monkeypatch.setattr(news, "cut_lineage", lambda frame: cuts.append(1) or real(frame))
    count = 10_000
    frame = spark.range(count).select(
        F.col("id").cast("int").alias("n"), F.concat(F.lit("u"), F.floor(F.col("id") / 2)).alias("url_hash"),
        F.concat(F.lit("e"), F.floor((F.col("id") + 1) / 2)).alias("ext_key"))
    got = news.admit_in_batch(frame, "n")
    assert got.where(F.col("admitted") != (F.col("n") % 2 == 0)).count() == 0
    assert len(cuts) <= 30


@pytest.mark.parametrize("text, good", [
    ('{"digest_title": "D", "items": [{"candidate_id": "c_01", "summary": "s", "tag": "t", "relevance_score": 1, '
     '"selection_reason": "r"}]}', True),
    ('{"digest_title": "D", "items": [{"candidate_id": "c_01", "summary": "s", "tag": "t", "relevance_score": 0.5, '
     '"selection_reason": "r", "extra": 1}]}', False),
    ('{"digest_title": "D", "items": [{"candidate_id": "c_01", "summary": "s", "tag": "t", "relevance_score": "1", '
     '"selection_reason": "r"}]}', False),
    ('{"digest_title": 5, "items": []}', False), ('{"digest_title": "D", "items": {}}', False), ('{"digest_title": "D"}', False),
    ("[]", False), ("no json", False), ('{"digest_title": "D", "items": [{"candidate_id": "c_01"}]}', False)])
def test_answers_are_closed_and_strict_at_every_level(spark, text, good):
    from weirgate.sources.responses import read_model_responses

    item = "array<struct<candidate_id:string,summary:string,tag:string,relevance_score:double,selection_reason:string>>"
    schema = spark.createDataFrame([], f"digest_title string, items {item}").schema
    row = read_model_responses(spark.createDataFrame([(text,)], "output_text string"), schema).first()
    assert (row.schema_error is None) == good
