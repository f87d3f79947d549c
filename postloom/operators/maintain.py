"""Upkeep of the stored table: stale rows, orphan marks, re-keying, text clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.stage import staged
from postloom.functions.text import strip_chrome
from postloom.functions.urls import stable_id


def orphan_marks(seen: DataFrame, jobs: DataFrame) -> DataFrame:
    """Seen marks without a stored row."""
    return seen.join(jobs.select("job_id"), "job_id", "left_anti")


def stale_jobs(jobs: DataFrame, seen: DataFrame, cutoff: Column) -> DataFrame:
    """Rows first scraped before the cutoff and not seen at or after it."""
    recent = seen.filter(F.col("processed_at") >= cutoff).select("job_id")
    return jobs.filter(F.col("date_scrapped") < cutoff).join(recent, "job_id", "left_anti")


def stale_marks(seen: DataFrame, jobs: DataFrame, cutoff: Column) -> DataFrame:
    """Marks to drop: those before the cutoff, and those of stale rows."""
    gone = stale_jobs(jobs, seen, cutoff).select("job_id", F.lit(True).alias("_gone"))
    return (
        seen.join(gone, "job_id", "left")
        .filter((F.col("processed_at") < cutoff) | F.col("_gone"))
        .select(*seen.columns)
    )


def rekey_plan(jobs: DataFrame) -> DataFrame:
    """(job_id, new_id, has_native_id, action) for every stored row.

    Rows of one new id collapse into the one with the longest text (lowest job_id on
    ties): the others are deleted, the winner is renamed unless it has the id already.
    Winners come from a partial aggregate over narrow columns, and one join brings them back.
    """
    native = staged(jobs.select("job_id", "job_source", "url", "job_description"), {"_native": stable_id(F.col("job_source"), F.col("url"))})
    rows = native.select(
        "job_id",
        F.coalesce("_native", "job_id").alias("new_id"),
        F.col("_native").isNotNull().alias("has_native_id"),
        F.length(F.coalesce("job_description", F.lit(""))).alias("_len"),
    )
    winners = rows.groupBy("new_id").agg(F.min(F.struct(-F.col("_len"), F.col("job_id"))).alias("_w"))
    placed = rows.join(winners.select("new_id", F.col("_w.job_id").alias("_winner")), "new_id")
    action = (
        F.when(F.col("job_id") != F.col("_winner"), "delete")
        .when(F.col("job_id") != F.col("new_id"), "rename")
        .otherwise("keep")
    )
    return placed.select("job_id", "new_id", "has_native_id", action.alias("action"))


def rekey_summary(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("action") == "rename").alias("renamed"),
        F.count_if(F.col("action") == "delete").alias("deleted"),
        F.count_if(~F.col("has_native_id")).alias("without_native_id"),
    )


def apply_rekey(jobs: DataFrame, plan: DataFrame) -> DataFrame:
    """The stored table after the plan: losers gone, winners under their new id."""
    kept = plan.filter(F.col("action") != "delete").select("job_id", "new_id")
    return jobs.join(kept, "job_id").withColumn("job_id", F.col("new_id")).select(*jobs.columns)


def apply_rekey_to_marks(seen: DataFrame, plan: DataFrame, now: Column) -> DataFrame:
    """Seen marks after the plan: losers and old ids gone, renamed ids marked now."""
    dropped = plan.filter(F.col("action") != "keep").select("job_id")
    renamed = plan.filter(F.col("action") == "rename").select(
        F.col("new_id").alias("job_id"), now.alias("processed_at")
    )
    left = seen.select("job_id", "processed_at").join(dropped, "job_id", "left_anti")
    return left.join(renamed.select("job_id"), "job_id", "left_anti").unionByName(renamed)


def cleanup_plan(jobs: DataFrame, source: str = "linkedin") -> DataFrame:
    """Rows of a source whose text changes, and is not empty, once furniture is cut."""
    before = F.coalesce(F.col("job_description"), F.lit(""))
    return (
        jobs.filter(F.col("job_source") == source)
        .select("job_id", before.alias("before"), strip_chrome(before).alias("after"))
        .filter((F.col("after") != "") & (F.col("after") != F.col("before")))
    )


def apply_cleanup(jobs: DataFrame, plan: DataFrame) -> DataFrame:
    after = plan.select("job_id", F.col("after").alias("_after"))
    return (
        jobs.join(after, "job_id", "left")
        .withColumn("job_description", F.coalesce("_after", "job_description"))
        .select(*jobs.columns)
    )
