"""One batch of scraped rows into the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.operators import reconcile as R
from postloom.operators.enrich import enrich
from postloom.sources.tables import merge_changes


def batch_rows(batch: DataFrame, order: list[Column]) -> DataFrame:
    """Prepared rows worth keeping, the longest of each posting; rows without an id drop out."""
    # Behind a generator: the filter must not copy the making of ids into itself.
    ready = _settled(R.prepare(_settled(batch.filter(R.is_persistable(R.board_of(batch))))))
    return R.longest_per_key(ready.filter(F.col("job_id") != ""), "job_id", "description", order)


def changed_jobs(acted: DataFrame, vocabulary: list[str], now: Column) -> DataFrame:
    """Stored rows to write, of reconciled rows."""
    written = acted.filter(F.col("action").isin("new", "merge", "backfill")).drop("action")
    return R.job_records(enrich(written, vocabulary, now), now)


def changed_marks(acted: DataFrame, now: Column) -> DataFrame:
    """Seen marks to set, of reconciled rows."""
    return acted.filter(F.col("action") != "skipped").select("job_id", now.alias("processed_at")).distinct()


def _settled(rows: DataFrame) -> DataFrame:
    return rows.select(F.inline(F.array(F.struct("*"))))


def store_batch(
    batch: DataFrame, stored: DataFrame, seen: DataFrame, vocabulary: list[str], now: Column, order: list[Column]
) -> DataFrame:
    """The stored table after the batch: prepare, reconcile, enrich and merge as one plan."""
    acted = _settled(R.reconcile(batch_rows(batch, order), stored, seen))
    return merge_changes(stored, changed_jobs(acted, vocabulary, now), "job_id")
