"""Digest queries: candidates, validation, consumption, rendering, splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weirgate import schemas
from weirgate.operators import digest, intake, news
from weirgate.plans import sql, tables as t
from weirgate.plans.registry import Query
from weirgate.sources import responses

QUERIES: dict[str, Query] = {}


def candidate_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Request text for the selected candidates."""
    items, sources = t.news_items(spark, folder), t.feed_sources(spark, folder)
    chosen = news.select_candidates(items, sources, t.PROFILE, t.NOW).select("news_item_id", "source_key", "score")
    # At most 25 rows by the selection limit: broadcasting them spares a shuffle of all texts.
    rows = items.select("news_item_id", "title", "sanitized_summary", "published_at").join(
        F.broadcast(chosen), "news_item_id")
    rows = rows.join(sources.select("source_key", F.col("name").alias("source_name")), "source_key")
    return digest.article_payload(digest.candidate_ids(rows.withColumn("run_id", F.lit(1)))).select("run_id", "articles_json")



_JSON = ("'{\"candidate_id\": \"' || candidate_id || '\", \"source_name\": ' || to_json(source_name) || ', \"title\": ' || "
         "to_json(title) || ', \"summary\": ' || to_json(summary) || ', \"published_at\": \"' || published_at || "
         "'\", \"relevance_score\": \"' || relevance_score || '\"}'")
_CANDIDATES = """
SELECT 'c_' || lpad(CAST(row_number() OVER (ORDER BY c.score DESC, c.news_item_id) AS VARCHAR), 2, '0') AS candidate_id,
       f.name AS source_name, c.title, substr(i.sanitized_summary, 1, 1500) AS summary,
       CASE WHEN published_us IS NULL THEN ''
            ELSE strftime(make_timestamp(published_us), '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS published_at,
       printf('%.3f', c.score) AS relevance_score
FROM chosen c JOIN news_item i USING (news_item_id) JOIN feed_source f ON f.source_key = c.source_key"""
QUERIES["candidate_payload"] = Query(candidate_payload, sql.query(f"""
SELECT 1 AS run_id, '{{"articles": [' || string_agg({_JSON}, ', ' ORDER BY candidate_id) || ']}}' AS articles_json
FROM ({_CANDIDATES})""", "feed_source", "news_item", "scored", "chosen"))


def candidate_fields(spark: SparkSession, folder: str) -> DataFrame:
    """The same request text, parsed back into its fields."""
    schema = ("struct<articles:array<struct<candidate_id:string,source_name:string,title:string,summary:string,"
              "published_at:string,relevance_score:string>>>")
    parsed = candidate_payload(spark, folder).select(F.inline(F.from_json("articles_json", schema)["articles"]))
    return parsed.select("candidate_id", "source_name", "title", F.sha2("summary", 256).alias("summary_hash"),
                         "published_at", "relevance_score")


QUERIES["candidate_fields"] = Query(candidate_fields, sql.query(f"""
SELECT candidate_id, source_name, title, sha256(summary) AS summary_hash, published_at, relevance_score
FROM ({_CANDIDATES})""", "feed_source", "news_item", "scored", "chosen"))


# --- validation: every document stands for one model answer, its run is the language and number -----

def _outputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Answers of 2..8 items and contexts of 0..9 candidates per run, with the faults the rules look for."""
    key = F.col("doc_id")
    count = (key % 7 + 2).cast("int")

    def item(index: Column) -> Column:
        number = F.when(key % 13 == 0, F.lit(1)).when((key % 17 == 0) & (index == 1), F.lit(98)).otherwise(index)
        size = F.when(key % 5 == 0, 60).otherwise(90) + index
        # The pieces of a text go around its items: the last item takes what is left, however long.
        summary = F.substring(F.col("text"), (index - 1) * 100 + 1, F.when(index == count, F.length("text")).otherwise(size))
        summary = F.when((key % 11 == 0) & (index == 2), F.concat(summary, F.lit(" see www.x.org"))).otherwise(summary)
        return F.struct(
            F.concat(F.lit("c_"), F.lpad(number.cast("string"), 2, "0")).alias("candidate_id"),
            summary.alias("summary"),
            F.when((key % 19 == 0) & (index == 1), "NEWS").otherwise("PRODUCT").alias("tag"),
            F.lit(0.5).alias("relevance_score"), F.lit("Useful.").alias("selection_reason"))

    items = F.transform(F.sequence(F.lit(1), count), item)
    outputs = t.table(spark, folder, "documents").select(
        "doc_id", key.alias("run_id"), F.struct(F.lit("Daily").alias("digest_title"), items.alias("items")).alias("output"))
    contexts = t.table(spark, folder, "documents").where((key % 23) != 5).select(
        key.alias("run_id"), F.explode(F.sequence(F.lit(1), F.lit(8))).alias("n")).select(
        "run_id", F.concat(F.lit("c_"), F.lpad(F.col("n").cast("string"), 2, "0")).alias("candidate_id"),
        F.concat_ws("-", F.col("run_id").cast("string"), F.col("n").cast("string")).alias("news_item_id"),
        F.when((F.col("run_id") % 29 == 0) & (F.col("n") == 1), "used")
        .when((F.col("run_id") % 31 == 0) & (F.col("n") == 2), "collected").otherwise("candidate").alias("status"))
    return outputs, contexts


def digest_validate(spark: SparkSession, folder: str) -> DataFrame:
    outputs, contexts = _outputs(spark, folder)
    checked = digest.validate_digest_output(outputs, contexts)
    return checked.select("doc_id", "accepted", F.array_join("errors", "\n").alias("errors"),
                          digest.validation_error_text(F.col("errors")).alias("error_text"),
                          F.array_join("news_ids", ",").alias("news_ids"))


_VALIDATED = r"""
, answer AS (SELECT doc_id, doc_id % 7 + 2 AS n, text AS words
             FROM documents),
item AS (SELECT doc_id, n, i, CASE WHEN doc_id % 13 = 0 THEN 1 WHEN doc_id % 17 = 0 AND i = 1 THEN 98 ELSE i END AS num,
           substr(words, (i - 1) * 100 + 1,
                  CASE WHEN i = n THEN length(words) WHEN doc_id % 5 = 0 THEN 60 + i ELSE 90 + i END)
             || CASE WHEN doc_id % 11 = 0 AND i = 2 THEN ' see www.x.org' ELSE '' END AS summary,
           CASE WHEN doc_id % 19 = 0 AND i = 1 THEN 'NEWS' ELSE 'PRODUCT' END AS tag
         FROM (SELECT *, CAST(unnest(range(1, n + 1)) AS INTEGER) AS i FROM answer)),
marked AS (SELECT *, 'c_' || lpad(CAST(num AS VARCHAR), 2, '0') AS cid, num <= 8 AND doc_id % 23 <> 5 AS known,
             CASE WHEN doc_id % 29 = 0 AND num = 1 THEN 'used' WHEN doc_id % 31 = 0 AND num = 2 THEN 'collected'
                  ELSE 'candidate' END AS state,
             row_number() OVER (PARTITION BY doc_id, num ORDER BY i) > 1 AS again FROM item),
listed AS (SELECT doc_id, n, i, cid, num, list_filter([
    CASE WHEN again THEN 'duplicate candidate_id ' || cid END,
    CASE WHEN NOT known THEN 'unknown candidate_id ' || cid END,
    CASE WHEN known AND state = 'used' THEN 'candidate ' || cid || ' was already used' END,
    CASE WHEN known AND state = 'collected' THEN 'candidate ' || cid || ' is not in candidate status' END,
    CASE WHEN known AND length(summary) NOT BETWEEN 80 AND 280
         THEN 'summary length must be between 80 and 280 characters' END,
    CASE WHEN known AND regexp_matches(summary, '(?i)(https?://|www\.|<|>|\[/?(b|i|u|code|pre|a)\]|telegram\.me)')
         THEN 'summary must not contain URLs, HTML, or Telegram markup' END,
    CASE WHEN known AND tag = 'NEWS' THEN 'invalid tag for ' || cid END], lambda e: e IS NOT NULL) AS errors FROM marked),
bounds AS (SELECT doc_id, n, CASE WHEN doc_id % 23 <> 5 THEN 5 ELSE 0 END AS most,
             CASE WHEN doc_id % 23 <> 5 THEN 3 ELSE 0 END AS least_n FROM answer),
gathered AS (SELECT b.doc_id,
    list_filter([CASE WHEN b.n NOT BETWEEN least_n AND most THEN 'item count must be between ' || least_n || ' and '
                 || most || ', got ' || b.n END], lambda e: e IS NOT NULL) || l.errors AS errors, ids
  FROM bounds b JOIN (SELECT doc_id, flatten(list(errors ORDER BY i)) AS errors,
                             string_agg(doc_id || '-' || num, ',' ORDER BY i) AS ids FROM listed GROUP BY 1) l
    USING (doc_id))
"""
QUERIES["digest_validate"] = Query(digest_validate, "WITH" + _VALIDATED.strip().lstrip(",") + r"""
SELECT doc_id, len(errors) = 0 AS accepted, array_to_string(errors, chr(10)) AS errors,
       substr(array_to_string(list_transform(errors, lambda e: '- ' || e), chr(10)), 1, 500) AS error_text,
       CASE WHEN len(errors) = 0 THEN ids END AS news_ids
FROM gathered""")


def digest_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Runs with a second answer, that of the run 10 numbers on, for two out of three rejected ones."""
    outputs, contexts = _outputs(spark, folder)
    checked = digest.validate_digest_output(outputs, contexts)
    second = checked.where(F.col("run_id") % 3 != 0).select(
        (F.col("run_id") - 10).alias("run_id"), "accepted", "errors", "news_ids")
    return digest.repair_outcome(checked, second).select(
        "doc_id", "answer", "repair_errors", "error_code", "error_summary", F.array_join("news_ids", ",").alias("news_ids"))


QUERIES["digest_repair"] = Query(digest_repair, "WITH" + _VALIDATED.strip().lstrip(",") + r"""
, told AS (SELECT *, substr(array_to_string(list_transform(errors, lambda e: '- ' || e), chr(10)), 1, 500) AS tell FROM gathered)
SELECT a.doc_id, CASE WHEN len(a.errors) = 0 THEN 'primary' WHEN len(b.errors) = 0 THEN 'repair' END AS answer,
       CASE WHEN len(a.errors) > 0 THEN a.tell END AS repair_errors,
       CASE WHEN len(a.errors) > 0 AND len(b.errors) > 0 THEN 'OUTPUT_POST_VALIDATION_FAILED' END AS error_code,
       CASE WHEN len(a.errors) > 0 AND len(b.errors) > 0 THEN b.tell END AS error_summary,
       CASE WHEN len(a.errors) = 0 THEN a.ids WHEN len(b.errors) = 0 THEN b.ids END AS news_ids
FROM told a LEFT JOIN told b ON b.doc_id = a.doc_id + 10 AND b.doc_id % 3 <> 0""")


def digest_accepted_items(spark: SparkSession, folder: str) -> DataFrame:
    """Digest items of the accepted answers."""
    outputs, contexts = _outputs(spark, folder)
    rows = digest.accepted_items(digest.validate_digest_output(outputs, contexts), key="doc_id")
    return rows.select("doc_id", "position", "news_item_id", "tag", F.length("summary").alias("summary_length"),
                       F.col("relevance_score").cast("double").alias("relevance_score"))


QUERIES["digest_accepted_items"] = Query(digest_accepted_items, "WITH" + _VALIDATED.strip().lstrip(",") + """
SELECT m.doc_id, i AS position, m.doc_id || '-' || num AS news_item_id, tag, length(summary) AS summary_length,
       CAST(0.5 AS DOUBLE) AS relevance_score
FROM marked m JOIN gathered g ON g.doc_id = m.doc_id WHERE len(g.errors) = 0""")


def digest_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Position rules on the raw order lines, most of which break them."""
    items = t.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("digest_id"), F.col("l_linenumber").alias("position"),
        F.col("l_partkey").alias("news_item_id"))
    return digest.check_positions(items)


QUERIES["digest_positions"] = Query(digest_positions, """
SELECT digest_id, items, CASE WHEN items > 7 THEN 'Digest must contain between 1 and 7 items'
    WHEN positions < items THEN 'Digest item positions must be unique'
    WHEN news < items THEN 'Digest news items must be unique'
    WHEN low <> 1 OR high <> items THEN 'Digest item positions must be consecutive starting at 1' END AS position_error
FROM (SELECT l_orderkey AS digest_id, count(*) AS items, count(DISTINCT l_linenumber) AS positions,
             count(DISTINCT l_partkey) AS news, min(l_linenumber) AS low, max(l_linenumber) AS high
      FROM lineitem GROUP BY 1)""")


def digest_consume(spark: SparkSession, folder: str) -> DataFrame:
    """Digests that may take their candidates, all or nothing."""
    created, _ = digest.consume_candidates(t.digest_items(spark, folder), t.part_news(spark, folder))
    return created


QUERIES["digest_consume"] = Query(digest_consume, sql.query("""
SELECT digest_id, missing = 0 AND other = 0 AS created,
       CASE WHEN missing > 0 THEN 'One or more selected news items do not exist.'
            WHEN other > 0 THEN 'All selected news items must have candidate status.' END AS error
FROM (SELECT digest_id, count(*) FILTER (WHERE status IS NULL) AS missing,
             count(*) FILTER (WHERE status <> 'candidate') AS other
      FROM digest_item LEFT JOIN part_news USING (news_item_id) GROUP BY 1)""", "digest_item", "part_news"))


def news_after_consume(spark: SparkSession, folder: str) -> DataFrame:
    _, after = digest.consume_candidates(t.digest_items(spark, folder), t.part_news(spark, folder))
    return after.select("news_item_id", "status")


QUERIES["news_after_consume"] = Query(news_after_consume, sql.query("""
SELECT news_item_id, CASE WHEN news_item_id IN (
         SELECT news_item_id FROM digest_item WHERE digest_id NOT IN (
           SELECT digest_id FROM digest_item LEFT JOIN part_news p USING (news_item_id)
           WHERE p.status IS NULL OR p.status <> 'candidate')) THEN 'used' ELSE status END AS status
FROM part_news""", "digest_item", "part_news"))


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    lines = digest.digest_lines(t.digest_items(spark, folder), t.part_news(spark, folder), t.brand_sources(spark, folder))
    # No digest has more than seven lines here, so none is combined before the shuffle: that would sort all texts twice.
    lines = t.dealt(lines, t.table(spark, folder, "lineitem"), "digest_id")
    titles = t.digests(spark, folder).select("run_id", "digest_title")
    return digest.digest_blocks(lines).withColumn("run_id", t.order_of()).join(titles, "run_id")


def digest_render(spark: SparkSession, folder: str) -> DataFrame:
    """Full text of every digest."""
    return digest.render_digest(_blocks(spark, folder)).select("digest_id", "items", "digest_error",
                                                                     "rendered_text")


QUERIES["digest_render"] = Query(digest_render, sql.query("""
SELECT digest_id, items, problem AS digest_error, CASE WHEN problem IS NULL THEN
  title || chr(10) || chr(10) || body || chr(10) || chr(10) || footer || chr(10) END AS rendered_text FROM titled""", "digest_item", "part_news", "blocks", "digest", "titled"))

SPLIT_LIMIT = 900


def digest_split(spark: SparkSession, folder: str) -> DataFrame:
    """Message parts of every digest, with a limit low enough to split them."""
    rows = digest.split_messages(_blocks(spark, folder), SPLIT_LIMIT)
    return rows.select("digest_id", "split_error", F.posexplode_outer("parts").alias("part", "text"))


QUERIES["digest_split"] = Query(digest_split, sql.query("", "digest_item", "part_news", "blocks", "digest", "titled",
                                                        recursive=True).rstrip() + f"""
, fill AS (
  SELECT b.digest_id, b.position, 0 AS part, b.block AS filled, t.n, t.title, t.footer
  FROM blocks b JOIN titled t USING (digest_id) WHERE b.position = 1 AND problem IS NULL
  UNION ALL
  SELECT f.digest_id, b.position, CASE WHEN fits THEN part ELSE part + 1 END,
         CASE WHEN fits THEN filled || chr(10) || chr(10) || chr(10) || b.block ELSE b.block END, n, title, footer
  FROM (SELECT f.*, b.position AS next_position, b.block,
               length(title) + length(footer) + 5 + length(filled) + 3 + length(b.block) <= {SPLIT_LIMIT} AS fits
        FROM fill f JOIN blocks b ON b.digest_id = f.digest_id AND b.position = f.position + 1) f
  JOIN blocks b ON b.digest_id = f.digest_id AND b.position = f.next_position)
SELECT digest_id, CAST(NULL AS VARCHAR) AS split_error, part,
       CASE WHEN part = 0 THEN title || chr(10) || chr(10) ELSE '' END || filled
         || CASE WHEN part = last_part THEN chr(10) || chr(10) || footer ELSE '' END || chr(10) AS text
FROM (SELECT *, row_number() OVER (PARTITION BY digest_id, part ORDER BY position DESC) AS back,
             max(part) OVER (PARTITION BY digest_id) AS last_part FROM fill)
WHERE back = 1
UNION ALL SELECT digest_id, problem, NULL, NULL FROM titled WHERE problem IS NOT NULL""")


def sent_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Digests without a run of the same number that succeeded."""
    return intake.difference(
        t.digests(spark, folder).select("run_id", "status"),
        t.pipeline_runs(spark, folder).where(F.col("status") == "success"), "run_id")


QUERIES["sent_difference"] = Query(sent_difference, sql.query("""
SELECT run_id, status FROM digest WHERE run_id NOT IN (SELECT run_id FROM run WHERE status = 'success')""",
    "digest", "run"))


def model_responses_digest(spark: SparkSession, folder: str) -> DataFrame:
    """Digest answers as JSON texts, with faults inside the items: one document, one answer."""
    key = F.col("doc_id")
    item = F.to_json(F.struct(
        F.lit("c_01").alias("candidate_id"), F.col("text").alias("summary"), F.lit("PRODUCT").alias("tag"),
        F.lit(1).alias("relevance_score"), F.lit("Useful.").alias("selection_reason")))
    item = (F.when(key % 7 == 1, F.replace(item, F.lit('"tag":'), F.lit('"extra":[1],"tag":')))
            .when(key % 7 == 2, F.replace(item, F.lit('"relevance_score":1'), F.lit('"relevance_score":"1"')))
            .when(key % 7 == 3, F.replace(item, F.lit('"selection_reason":"Useful."'), F.lit('"selection_reason":5')))
            .when(key % 7 == 4, F.replace(item, F.lit('"tag":"PRODUCT",'), F.lit(""))).otherwise(item))
    whole = F.concat(F.lit('{"digest_title":"D","items":['), item, F.when(key % 7 == 5, "]").otherwise("]}"))
    rows = t.table(spark, folder, "documents").select("doc_id", whole.alias("output_text"))
    found = responses.read_model_responses(rows, schemas.DIGEST_OUTPUT)
    return found.select("doc_id", "schema_error", F.sha2(F.col("output.items")[0]["summary"], 256).alias("summary_hash"))


QUERIES["model_responses_digest"] = Query(model_responses_digest, """
SELECT doc_id, CASE WHEN doc_id % 7 BETWEEN 1 AND 5 THEN 'INVALID_STRUCTURED_OUTPUT' END AS schema_error,
       CASE WHEN doc_id % 7 NOT BETWEEN 1 AND 5 THEN sha256(text) END AS summary_hash FROM documents""")
