"""Counts and summaries; all of them partial aggregates before their shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from postloom.fixed_values import PAGE_FLAGS
from postloom.functions.text import strip
from postloom.operators.groups import top_per_group


def enrichment_stats(enriched: DataFrame) -> DataFrame:
    score = F.col("enrichment_confidence")
    return enriched.agg(
        F.count("*").alias("total"),
        F.avg(score).alias("average"),
        F.count_if(score >= 0.7).alias("high"),
        F.count_if((score >= 0.5) & (score < 0.7)).alias("medium"),
        F.count_if(score < 0.5).alias("low"),
    )


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def board_quality(postings: DataFrame, attempts: DataFrame, order: list[Column], samples: int = 3) -> DataFrame:
    """Rows, rows with text, rows with long text, status and the first titles per board.

    ``attempts`` is (board, ok): PASS has rows, EMPTY was fetched without rows, FAIL was not.
    """
    text = F.coalesce(F.col("description"), F.lit(""))
    counts = postings.groupBy("board").agg(
        F.count("*").alias("jobs"),
        F.count_if(strip(text) != "").alias("with_text"),
        F.count_if(F.length(text) >= 80).alias("long_text"),
    )
    order_struct = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    first = top_per_group(postings.withColumn("_at", order_struct), ["board"], [F.col("_at")], samples)
    titles = first.groupBy("board").agg(
        F.array_sort(F.collect_list(F.struct("_at", "title"))).alias("_s")
    ).select("board", F.transform("_s", lambda s: s["title"]).alias("samples"))
    fetched = attempts.groupBy("board").agg(F.bool_or("ok").alias("ok"))
    jobs = F.coalesce("jobs", F.lit(0))
    return (
        fetched.join(counts, "board", "full_outer")
        .join(titles, "board", "left")
        .select(
            "board",
            jobs.alias("jobs"),
            F.coalesce("with_text", F.lit(0)).alias("with_text"),
            F.coalesce("long_text", F.lit(0)).alias("long_text"),
            F.when(~F.coalesce("ok", F.lit(False)), "FAIL")
            .when(jobs > 0, "PASS")
            .otherwise("EMPTY")
            .alias("status"),
            "samples",
        )
    )


def fetch_report(log: DataFrame) -> DataFrame:
    """Attempts, failures and elapsed seconds per board and outcome."""
    return log.groupBy("board", "outcome").agg(
        F.count("*").alias("n"),
        F.sum("elapsed_s").alias("elapsed_s"),
        F.max("elapsed_s").alias("slowest_s"),
    )


def failed_roles(log: DataFrame, failed: Column) -> DataFrame:
    """Roles of which every search failed; a search failed when all its attempts did."""
    searches = log.groupBy("role", "board").agg(F.bool_and(failed).alias("failed"))
    return (
        searches.groupBy("role")
        .agg(F.bool_and("failed").alias("failed"), F.count("*").alias("searches"))
        .filter("failed")
        .select("role", "searches")
    )


def queue_stats(queue: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows waiting and distinct keys seen, as one row."""
    waiting = queue.agg(F.count("*").alias("n")).select(F.lit("queue_length").alias("metric"), "n")
    marked = seen.agg(F.count_distinct("job_id").alias("n")).select(
        F.lit("processed_count").alias("metric"), "n"
    )
    return waiting.unionByName(marked).agg(
        F.max(F.when(F.col("metric") == "queue_length", F.col("n"))).alias("queue_length"),
        F.max(F.when(F.col("metric") == "processed_count", F.col("n"))).alias("processed_count"),
    )


def run_totals(reconciled: DataFrame) -> DataFrame:
    """Scraped, enriched and upserted rows of a run from its reconciled rows."""
    written = F.col("action").isin("new", "merge", "backfill")
    return reconciled.agg(
        F.count("*").alias("scraped"),
        F.count_if(written).alias("enriched"),
        F.count_distinct(F.when(written, F.col("job_id"))).alias("upserted"),
        F.count_if(F.col("action") == "unchanged").alias("duplicates"),
        F.count_if(F.col("action") == "skipped").alias("skipped"),
    )


def live_totals(reconciled: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and their totals as soon as they have been written: what ``run_totals`` counts without a second pass."""
    seen = Observation(f"run-{uuid.uuid4().hex}")
    action = F.coalesce("action", F.lit(""))
    metrics = {
        "scraped": F.count(F.lit(1)),
        "enriched": F.count_if(action.isin("new", "merge", "backfill")),
        "duplicates": F.count_if(action == "unchanged"),
        "skipped": F.count_if(action == "skipped"),
    }
    return reconciled.observe(seen, *[c.alias(n) for n, c in metrics.items()]), seen


def live_upserts(changes: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows to merge, one per key, and their number once they have been written."""
    seen = Observation(f"upserts-{uuid.uuid4().hex}")
    return changes.observe(seen, F.count("job_id").alias("upserted")), seen


def page_flags(html: Column) -> Column:
    """Challenge words of a page, comma-joined in fixed order; "none" without any."""
    low = F.lower(F.coalesce(html, F.lit("")))
    found = F.filter(F.array(*[F.lit(f) for f in PAGE_FLAGS]), lambda f: F.contains(low, f))
    return F.when(F.size(found) > 0, F.array_join(found, ",")).otherwise("none")
