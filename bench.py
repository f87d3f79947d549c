"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
Each query runs once to warm up and once timed, into a sink that discards its rows.
The given files are one row group each, which one core reads alone; tables of size have many.
So they are first dealt into two files a core, outside the timing.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from postloom.catalog import load
from postloom.catalog.fixtures import TABLES
from postloom.session import local_session

HEADLINE = [
    "enrich_batch", "skills", "sections", "dedup_sentences", "experience", "longest_per_key", "reconcile",
    "upsert_jobs", "merge_with_deletes", "merge_rows", "stale_jobs", "rekey_plan", "jsonld_fields", "listing_cards", "html_text",
    "applications_with_jobs", "profile_scores", "resume_versions", "failure_streaks", "dedup_ttl", "emit_if_longer",
    "cap_per_board", "search_jobs", "uncovered_hours", "run_gate",
]


def dealt(spark: SparkSession, sf_dir: str, cpus: int) -> str:
    """The tables in files enough for all cores."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for table in TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(2 * cpus).write.parquet(f"{folder}/{table}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, max(cpus, 1))
    queries = load().QUERIES
    folder = dealt(spark, sf_dir, cpus)
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
