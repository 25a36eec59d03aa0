"""Row rules, keys, references, contracts and secrets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from weirgate import constants as C
from weirgate.functions.text import strip
from weirgate.operators.keys import one_per_key

c = F.col


def _all(*conditions: Column) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def _none(*names: str) -> Column:
    return _all(*[c(name).isNull() for name in names])


def _set(*names: str) -> Column:
    return _all(*[c(name).isNotNull() for name in names])


def _not_negative(*names: str) -> Column:
    return _all(*[c(name) >= 0 for name in names])


def _exactly(condition: Column, inside: Column, outside: Column) -> Column:
    """``inside`` holds where ``condition`` does, ``outside`` elsewhere."""
    return (condition & inside) | (~condition & outside)


def _error_matches_status() -> Column:
    failed = c("status") == "failed"
    return _exactly(failed, _set("error_code"), _none("error_code", "error_summary"))


def _http_valid() -> Column:
    return c("http_status").between(100, 599)


def _hex64(name: str) -> Column:
    return F.rlike(c(name), F.lit(r"\A[0-9a-f]{64}\z"))


def _known(name: str, values: tuple[str, ...]) -> Column:
    return c(name).isin(*values)


def _trimmed_length(name: str, maximum: int) -> Column:
    return F.length(strip(name)).between(1, maximum)


def rule_catalogue(table: str) -> list[tuple[str, Column]]:
    """Named conditions every row of a stored table has to meet (J8, B17). A null condition counts as met."""
    completed = c("finished_at") >= c("started_at")
    catalogue = {
        "feed_sources": [
            ("consecutive_failures_non_negative", _not_negative("consecutive_failures")),
            ("priority_range", c("priority").between(0, 10)),
            ("key_format", F.rlike(c("source_key"), F.lit(r"\A[a-z0-9]+(-[a-z0-9]+)*\z"))),
            ("key_length", _trimmed_length("source_key", 64)),
            ("name_length", _trimmed_length("name", 160)),
            ("category_length", _trimmed_length("category", 64)),
            ("language_code", F.rlike(c("language"), F.lit(r"\A[a-z]{2}\z"))),
        ],
        "pipeline_runs": [
            ("trigger_type_known", _known("trigger_type", C.TRIGGER_TYPES)),
            ("status_known", _known("status", C.RUN_STATUSES)),
            ("error_code_known", _known("error_code", C.ERROR_CODES)),
            ("error_matches_status", _error_matches_status()),
            ("completion_matches_status", _exactly(
                c("status") == "running", _none("finished_at", "duration_ms"), _set("finished_at", "duration_ms"))),
            ("duration_non_negative", _not_negative("duration_ms")),
            ("feed_counters_consistent", c("feeds_succeeded") <= c("feeds_total")),
            ("counters_non_negative", _not_negative(
                "feeds_total", "feeds_succeeded", "items_fetched", "items_inserted", "items_duplicate",
                "candidates_count", "selected_count")),
            ("completion_time_valid", completed),
            ("item_counters_consistent", c("items_inserted") + c("items_duplicate") <= c("items_fetched")),
            ("selection_counters_consistent", c("selected_count") <= c("candidates_count")),
        ],
        "digests": [
            ("status_known", _known("status", C.DIGEST_STATUSES)),
            ("error_code_known", _known("error_code", C.ERROR_CODES)),
            ("error_matches_status", _error_matches_status()),
            ("sent_time_matches_status", _exactly(c("status") == "sent", _set("sent_at"), _none("sent_at"))),
            ("model_valid", c("model") == C.DIGEST_MODEL),
            ("input_tokens_non_negative", _not_negative("input_tokens")),
            ("output_tokens_non_negative", _not_negative("output_tokens")),
            ("sent_time_valid", c("sent_at") >= c("created_at")),
            ("title_length", _trimmed_length("title", 200)),
        ],
        "feed_fetches": [
            ("status_known", _known("status", C.FETCH_STATUSES)),
            ("error_code_known", _known("error_code", C.ERROR_CODES)),
            ("error_matches_status", _error_matches_status()),
            ("not_modified_result_valid", (c("status") != "not_modified") | (
                _set("http_status") & (c("http_status") == 304) & (c("entries_count") == 0))),
            ("success_http_valid", (c("status") != "success") | (
                _set("http_status") & c("http_status").between(200, 299))),
            ("duration_non_negative", _not_negative("duration_ms")),
            ("entries_non_negative", _not_negative("entries_count")),
            ("completion_time_valid", completed),
            ("http_status_valid", _http_valid()),
        ],
        "news_items": [
            ("status_known", _known("status", C.NEWS_STATUSES)),
            ("ignore_reason_known", _known("ignore_reason", C.IGNORE_REASONS)),
            ("ignore_reason_matches_status", _exactly(
                c("status") == "ignored", _set("ignore_reason"), _none("ignore_reason"))),
            ("content_hash_valid", _hex64("content_hash")),
            ("url_hash_valid", _hex64("url_hash")),
            ("title_length", _trimmed_length("title", 500)),
        ],
        "delivery_attempts": [
            ("status_known", _known("status", C.DELIVERY_STATUSES)),
            ("error_code_known", _known("error_code", C.ERROR_CODES)),
            ("result_matches_status",
             ((c("status") == "pending") & _none("finished_at", "message_id", "http_status", "retry_after_seconds",
                                                 "error_code", "error_summary"))
             | ((c("status") == "sent") & _set("finished_at", "message_id", "http_status")
                & c("http_status").between(200, 299) & _none("retry_after_seconds", "error_code", "error_summary"))
             | ((c("status") == "failed") & _set("finished_at", "error_code") & _none("message_id"))),
            ("completion_time_valid", completed),
            ("http_status_valid", _http_valid()),
            ("numbering_positive", (c("part_number") >= 1) & (c("attempt_number") >= 1)),
            ("retry_after_non_negative", _not_negative("retry_after_seconds")),
            ("message_id_positive", c("message_id") > 0),
        ],
        "digest_items": [
            ("position_valid", c("position").between(1, C.DIGEST_MAX_ITEMS)),
            ("relevance_score_valid", c("relevance_score").between(0, 1)),
            ("tag_known", _known("tag", C.DIGEST_TAGS)),
        ],
    }
    return catalogue[table]


def check_rules(rows: DataFrame, table: str) -> DataFrame:
    """Add ``failed_rules``: the names of the rules a row breaks, in catalogue order."""
    failed = [F.when(~F.coalesce(condition, F.lit(True)), F.lit(name)) for name, condition in rule_catalogue(table)]
    return rows.withColumn("failed_rules", F.array_compact(F.array(*failed)))


def rule_summary(checked: DataFrame) -> DataFrame:
    """Rows per broken rule."""
    return checked.select(F.explode("failed_rules").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


def check_unique(rows: DataFrame, columns: list[str], where: Column | None = None) -> DataFrame:
    """Key values that occur more than once (J9); ``where`` makes the key partial. Nulls are never equal."""
    kept = rows if where is None else rows.where(where)
    kept = kept.where(_all(*[c(name).isNotNull() for name in columns]))
    return kept.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where(c("rows") > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose parent does not exist (C9); a null reference is no orphan."""
    keys = parent.select(c(parent_key).alias(child_key))
    return child.where(c(child_key).isNotNull()).join(keys, child_key, "left_anti")


def cascade_effect(deleted: DataFrame, key: str, edges: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """What deleting parents does to each child table.

    ``edges`` lists ``(table, child, child key, action)``. ``cascade`` removes the child rows, ``restrict`` keeps the
    parent. One row per edge: affected child rows and distinct parents they hang on.
    """
    results = []
    for table, child, child_key, action in edges:
        hit = child.select(c(child_key).alias(key)).join(deleted.select(key), key, "left_semi")
        results.append(hit.agg(F.count(F.lit(1)).alias("child_rows"), F.count_distinct(key).alias("parents")).select(
            F.lit(table).alias("child_table"), F.lit(action).alias("action"), "child_rows", "parents",
            F.when(F.lit(action) == "restrict", c("parents")).otherwise(0).cast("bigint").alias("blocked_parents")))
    return reduce(lambda left, right: left.unionByName(right), results)


def scan_secrets(rows: DataFrame, key: str, text: str, patterns: dict[str, str] | None = None,
                 needles: dict[str, str] | None = None) -> DataFrame:
    """Label, place and number of key-shaped texts (J11), whole texts, one row per key and label.

    ``needles`` may name a lower-case text that every match of a pattern contains; the pattern then runs only on texts
    that contain it.
    """
    patterns = C.SECRET_PATTERNS if patterns is None else patterns
    needles = C.SECRET_NEEDLES if needles is None else needles

    def count(label: str, pattern: str) -> Column:
        matches = F.regexp_count(c(text), F.lit(pattern)).cast("bigint")
        if label not in needles:
            return matches
        return F.when(F.contains(c("_lower"), F.lit(needles[label])), matches).otherwise(F.lit(0).cast("bigint"))

    counts = F.array(*[
        F.struct(F.lit(label).alias("label"), count(label, pattern).alias("matches"))
        for label, pattern in patterns.items()
    ])
    # One slot per pattern and the filter behind it: each pattern runs at most once per text.
    lowered = rows.select(key, text, F.lower(text).alias("_lower"))
    return lowered.select(key, F.inline(counts)).where(c("matches") > 0)


def header_mismatch(rows: DataFrame, expected: tuple[str, ...]) -> list[str]:
    """Differences between a table's columns and its contract, in order (J12); empty when they agree."""
    problems = [f"missing:{name}" for name in expected if name not in rows.columns]
    problems += [f"unexpected:{name}" for name in rows.columns if name not in expected]
    if not problems and tuple(rows.columns) != tuple(expected):
        problems.append("order")
    return problems


def check_contract(rows: DataFrame, key: str, required: tuple[str, ...], source: str | None = None) -> DataFrame:
    """Contract errors of keyed records (J12): missing fields, repeated key, label words in the key and, where ``source`` names
    a column, words in it that tell a record's purpose."""
    told = [] if source is None else [F.when(F.contains(F.lower(source), F.lit(word)), F.lit(f"tells:{word}"))
                                      for word in C.SOURCE_WORDS]
    leaked = F.array_compact(F.array(*[F.when(F.contains(F.lower(key), F.lit(word)), F.lit(f"leaks:{word}"))
                                       for word in C.LABEL_WORDS]))
    missing = F.array_compact(F.array(*[F.when(c(name).isNull(), F.lit(f"missing:{name}")) for name in required]))
    repeated = one_per_key(rows.where(c(key).isNotNull()), [key], F.count(F.lit(1)).alias("_rows")).where(
        c("_rows") > 1)
    joined = rows.join(repeated, key, "left")
    twice = F.array_compact(F.array(F.when(c("_rows") > 1, F.lit("repeated_key"))))
    told = F.array_compact(F.array(*told)) if told else F.array().cast("array<string>")
    return joined.withColumn("contract_errors", F.concat(missing, twice, leaked, told)).drop("_rows")


def unknown_fixtures(cases: DataFrame, fixtures: DataFrame, key: str = "fixture") -> DataFrame:
    """Expected cases whose fixture does not exist (J12); a case without a fixture counts."""
    return cases.join(one_per_key(fixtures, [key]), key, "left_anti")
