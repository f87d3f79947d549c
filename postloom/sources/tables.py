"""Readers and writers of the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.operators.groups import top_per_group
from postloom.schemas import LOOKUP_COLUMNS, PAGES


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


# --- look-ups ----------------------------------------------------------------


def stored_by_ids(jobs: DataFrame, keys: DataFrame) -> DataFrame:
    """The reconcile columns of the stored rows whose key occurs in ``keys``."""
    return jobs.select(*LOOKUP_COLUMNS).join(keys.select("job_id"), "job_id", "left_semi")


def processed_ids(seen: DataFrame, keys: DataFrame) -> DataFrame:
    return seen.select("job_id").join(keys.select("job_id"), "job_id", "left_semi").distinct()


def job_by_id(jobs: DataFrame, job_id: str) -> DataFrame:
    return jobs.filter(F.col("job_id") == job_id)


# --- merges --------------------------------------------------------------------


def merge_by_key(current: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``current`` with the rows of ``changes`` in place of those of equal key.

    Both sides have one row per key, so a full outer join on it is balanced and
    reads each side once.
    """
    return merge_changes(current, changes.select(*current.columns), key)


def merge_changes(current: DataFrame, changes: DataFrame, key: str, delete: DataFrame | None = None) -> DataFrame:
    """``current`` without the keys of ``delete``, then with ``changes`` merged in.

    Columns that the changes lack keep their stored values, null in new rows; columns that
    only the changes have are added, null in rows they leave alone.  Each side has one row
    per key; null keys in ``delete`` delete nothing.
    """
    if delete is not None:
        current = current.join(delete.select(key), key, "left_anti")
    old = current.select(F.col(key).alias("_old_key"), F.struct(*current.columns).alias("_old"))
    new = changes.select(F.col(key).alias("_new_key"), F.struct(*changes.columns).alias("_new"))
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
    changed = F.col("_new_key").isNotNull()

    def value(name: str) -> Column:
        if name not in changes.columns:
            return F.col("_old")[name]
        if name not in current.columns:
            return F.col("_new")[name]
        return F.when(changed, F.col("_new")[name]).otherwise(F.col("_old")[name])

    names = [*current.columns, *[c for c in changes.columns if c not in current.columns]]
    return both.select(*[value(n).alias(n) for n in names])


def upsert(current: DataFrame, batch: DataFrame, order: list[Column], *, key: str = "job_id", text: str = "job_description") -> DataFrame:
    """Upsert; of several batch rows of one key the longest text counts, the first on ties."""
    length = F.length(F.coalesce(F.col(text), F.lit("")))
    changes = top_per_group(batch, [key], [length.desc(), *order])
    return merge_by_key(current, changes.select(*current.columns), key)


def touch(seen: DataFrame, keys: DataFrame, now: Column) -> DataFrame:
    """Set ``processed_at`` of the given keys to now; null and empty keys are ignored."""
    marks = (
        keys.select("job_id").filter(F.col("job_id") != "").distinct().withColumn("processed_at", now)
    )
    return merge_by_key(seen.select("job_id", "processed_at"), marks, "job_id")


def error_rows(failures: DataFrame, url: Column, message: Column, retries: Column, at: Column) -> DataFrame:
    """Error records for an append-only table."""
    return failures.select(
        url.cast("string").alias("url"),
        message.cast("string").alias("error_message"),
        retries.cast("int").alias("retries"),
        at.cast("timestamp").alias("timestamp"),
    )


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
