"""Time the headline queries and print one JSON line.

Folder, cores and repeats come from ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_REPEATS``; ``--all`` times every query,
names as arguments time only those. Each query runs to a sink that keeps nothing; the value is its best run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "news_select_top", "news_ignore_breakdown", "news_insert_if_new", "news_admit_batch", "news_insert_budget",
    "news_state_after_selection", "entry_normalize", "url_canonicalize", "html_sanitize", "title_normalize",
    "text_hash_dedup", "feed_parse", "document_gate", "duplicate_lookup", "invoice_review_reasons", "invoice_audit",
    "lead_validate", "lead_tier_routing", "contact_upsert", "digest_validate", "digest_render", "digest_split",
    "ingest_summary", "failure_streaks", "source_after_fetch", "transition_check", "delivery_progress", "rule_check",
    "unique_check", "secret_scan", "log_event_redact", "stream_dedup", "stream_transitions",
)


def main() -> None:
    from weirgate.plans.registry import all_queries
    from weirgate.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": cpus, "spark.sql.files.maxPartitionBytes": "4m",
        "spark.sql.files.openCostInBytes": "1m", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = [name for name in sys.argv[1:] if not name.startswith("-")]
    names = names or (list(queries) if "--all" in sys.argv else list(HEADLINE))
    queries["news_scores"].run(spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            queries[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
                      "cpus": int(cpus), "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
