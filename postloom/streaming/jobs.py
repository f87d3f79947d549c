"""Streaming forms of the stateful steps.

Steps with little state (a count per board) run in ``foreachBatch`` on the batch
operators, block by block, and keep their state in one small folder per micro-batch:
batch n reads what batch n - 1 left and overwrites only its own folders, so a repeated
batch gives the same result.  State per key, with timers, is in ``stateful``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postloom.operators import arrivals, report, store
from postloom.operators import reconcile as R
from postloom.sources import keyed

Step = Callable[[DataFrame, int], None]


def _start(stream: DataFrame, step: Step, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if system.exists(folder) else None


# --- store scraped rows as they arrive ----------------------------------------------


def upsert_stream(
    stream: DataFrame, jobs_path: str, seen_path: str, stage: str, vocabulary: list[str], now: Column,
    checkpoint: str, order: list[str],
) -> StreamingQuery:
    """Reconcile, enrich and upsert every micro-batch.

    Only the buckets of the batch's ids are read of both tables.  What to do with each row is
    written under ``stage`` before the first table changes, since both merges depend on the tables
    as they were.  Each merge leaves the batch's number in its table.  A batch that is repeated
    after a failure takes up where it broke off: decisions that a table already rests on are read
    again, not made anew, and a table that has the batch is left alone.

    The totals of each batch are counted while its rows are written (``report.live_totals``) and put
    under ``stage`` as ``totals/batch=<n>``.
    """
    names: list[str] = []

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        if not names:
            # A new checkpoint counts its batches from zero again: it is another stream.
            names.append(json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"])
        this, folder = (names[0], n), f"{stage}/batch={n}"
        if not keyed.merged(spark, jobs_path, this):
            longest = store.batch_rows(batch, [F.col(c) for c in order])
            stored = keyed.rows_of(spark, jobs_path, longest)
            seen = keyed.rows_of(spark, seen_path, longest)
            rows, totals = report.live_totals(R.reconcile(longest, stored, seen))
            rows.write.mode("overwrite").parquet(folder)
            spark.createDataFrame([totals.get]).write.mode("overwrite").json(f"{stage}/totals/batch={n}")
        acted = spark.read.parquet(folder)
        keyed.upsert_into(jobs_path, store.changed_jobs(acted, vocabulary, now), batch=this)
        keyed.upsert_into(seen_path, store.changed_marks(acted, now), batch=this)

    return _start(stream, step, checkpoint)


def enqueue_stream(stream: DataFrame, seen_path: str, queue_path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows whose key is not marked seen yet; one folder per micro-batch.

    Only the buckets of the batch's keys are read of the seen table.
    """

    def step(batch: DataFrame, n: int) -> None:
        seen = keyed.rows_of(batch.sparkSession, seen_path, arrivals.queue_keys(batch))
        arrivals.enqueue_new(batch, seen).write.mode("overwrite").parquet(f"{queue_path}/batch={n}")

    return _start(stream, step, checkpoint)


# --- failure streaks ---------------------------------------------------------------------


def streak_stream(
    stream: DataFrame, out: str, state: str, checkpoint: str, keys: list[str], failed: Column,
    succeeded: Column, limit: int, order: list[str],
) -> StreamingQuery:
    """Streaks and cooldowns per micro-batch under ``out``; one open streak per key under ``state``."""

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        carry = _read_if_there(spark, f"{state}/batch={n - 1}")
        rows = arrivals.failure_streaks(
            batch, keys, failed, succeeded, limit, [F.col(c) for c in order], carry
        )
        rows.write.mode("overwrite").parquet(f"{out}/batch={n}")
        done = spark.read.parquet(f"{out}/batch={n}")
        last = done.groupBy(*keys).agg(F.max_by("streak", F.struct(*order)).alias("streak"))
        if carry is not None:
            last = last.unionByName(carry.join(last.select(*keys), keys, "left_anti"))
        last.write.mode("overwrite").parquet(f"{state}/batch={n}")

    return _start(stream, step, checkpoint)
