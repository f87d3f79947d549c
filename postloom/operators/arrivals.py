"""Rows in arrival order: caps, first occurrences, improvements, streaks, expiring sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import strip
from postloom.functions.urls import queue_id
from postloom.operators.groups import blocks_of, running, top_per_group, written


def cap_per_search(df: DataFrame, keys: list[str], order: list[Column], cap: int) -> DataFrame:
    """The first ``cap`` rows of every search."""
    return top_per_group(df, keys, order, cap)


def first_by_url(df: DataFrame, order: list[Column]) -> DataFrame:
    return top_per_group(df, ["job_url"], order, 1)


def queued_distinct(df: DataFrame) -> DataFrame:
    """One row per (job_id, trimmed text length), the way rows are buffered; rows without id drop out."""
    length = F.length(strip(F.coalesce(F.col("description"), F.lit(""))))
    return df.filter(F.col("job_id") != "").withColumn("text_length", length).dropDuplicates(
        ["job_id", "text_length"]
    )


def emit_if_longer(df: DataFrame, key: str, length: Column, order: list[Column], within: Sequence[str] = ()) -> DataFrame:
    """Rows whose text is longer than that of every earlier row of the key, and of equal ``within``.

    The maximum so far is carried from block to block of a key (``groups.running``).
    """
    # Rows without a key all pass; they are no group.
    keyless = F.coalesce(F.col(key).cast("string"), F.lit("")) == ""
    with_length = df.filter(~keyless).withColumn("_len", length)
    keys = [key, *within]
    seen = running(with_length, keys, order, blocks_of(with_length, keys, order), maxes={"_before": F.col("_len")}, before=True)
    longer = seen.filter(F.col("_before").isNull() | (F.col("_len") > F.col("_before")))
    return longer.select(*df.columns).unionByName(df.filter(keyless))


def emit_if_longer_live(df: DataFrame, key: str, length: Column, at: str, order: list[Column], keep: str) -> DataFrame:
    """As ``emit_if_longer``, but a key without a row for longer than ``keep`` is forgotten and starts anew."""
    keyless = F.coalesce(F.col(key).cast("string"), F.lit("")) == ""
    lived = with_sessions(df.filter(~keyless), at, keep, owners=[key])
    return emit_if_longer(lived, key, length, order, ["session"]).drop("session").unionByName(df.filter(keyless))


def failure_streaks(
    log: DataFrame, keys: list[str], failed: Column, succeeded: Column, limit: int,
    order: list[Column], carry: DataFrame | None = None,
) -> DataFrame:
    """Adds ``streak`` (failures since the last success) and ``cooldown`` on every limit-th of them.

    Failures are counted once up to each row; the count at the last success is the
    running maximum of that count over successes.  Both scans run over the same blocks.
    ``carry`` (keys, streak) continues streaks of an earlier part of the log.
    """
    marked = log.withColumns({"_failed": failed.cast("int"), "_ok": succeeded})
    block = blocks_of(marked, keys, order)
    counted = running(marked, keys, order, block, sums={"_failures": F.col("_failed")})
    since = running(counted, keys, order, block, maxes={"_at_success": F.when(F.col("_ok"), F.col("_failures"))})
    open_streak = F.lit(0)
    if carry is not None:
        since = since.join(carry.select(*keys, F.col("streak").alias("_carry")), keys, "left")
        open_streak = F.coalesce("_carry", F.lit(0))
    streak = F.col("_failures") - F.coalesce("_at_success", -open_streak)
    hit = (F.col("_failed") == 1) & (streak > 0) & (streak % limit == 0)
    return since.withColumns({"streak": streak, "cooldown": hit}).select(
        *log.columns, "streak", "cooldown"
    )


def cooldowns(streaks: DataFrame, keys: list[str], at: str, seconds: int) -> DataFrame:
    """(keys, cooling_from, cooling_until): one interval per row of ``failure_streaks`` that starts a cooldown."""
    until = F.col(at) + F.make_interval(secs=F.lit(seconds))
    return streaks.filter("cooldown").select(*keys, F.col(at).alias("cooling_from"), until.alias("cooling_until"))


def cooling_at(probes: DataFrame, intervals: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Adds ``cooling``: does a cooldown that began at or before the probe's time end after it.

    Probes and starts are read in one order per key, with the latest end so far.  The intervals are
    written once: the blocks are counted, cut and scanned over them.
    """
    intervals = written(intervals, "intervals")
    row = F.struct(*probes.columns)
    asked = probes.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.lit(None).cast("timestamp").alias("_until"), row.alias("_row"))
    begun = intervals.select(*keys, F.col("cooling_from").alias("_t"), F.lit(0).alias("_kind"), F.col("cooling_until").alias("_until"))
    both = asked.unionByName(begun, allowMissingColumns=True)
    order = [F.col("_t"), F.col("_kind")]
    told = running(both, keys, order, blocks_of(both, keys, order), maxes={"_latest": F.col("_until")})
    cooling = F.coalesce(F.col("_latest") > F.col("_t"), F.lit(False))
    return told.filter("_kind = 1").select("_row.*", cooling.alias("cooling"))


def blocked_runs(
    log: DataFrame, keys: list[str], failed: Column, succeeded: Column, limit: int, at: str, order: list[Column]
) -> DataFrame:
    """(keys, blocked_from, blocked_until): from the ``limit``-th failure in a row to the next success (null: none yet)."""
    marked = log.withColumns({"_failed": failed.cast("int"), "_ok": succeeded.cast("int")})
    block = blocks_of(marked, keys, order)
    counted = running(marked, keys, order, block, sums={"_failures": F.col("_failed"), "_successes": F.col("_ok")})
    since = running(counted, keys, order, block, maxes={"_before": F.when(F.col("_ok") == 1, F.col("_failures"))})
    streak = F.col("_failures") - F.coalesce("_before", F.lit(0))
    starts = since.filter((F.col("_failed") == 1) & (streak == limit)).select(*keys, F.col(at).alias("blocked_from"), (F.col("_successes") + 1).alias("_n"))
    # Successes are numbered: the one that ends a run is the next number.
    ends = counted.filter("_ok = 1").select(*keys, F.col(at).alias("blocked_until"), F.col("_successes").alias("_n"))
    return starts.join(ends, [*keys, "_n"], "left").drop("_n")


def listing_stops(
    log: DataFrame, keys: list[str], failed: Column, limit: int, order: list[Column]
) -> DataFrame:
    """First row of every search at which ``limit`` listing pages in a row had failed."""
    streaks = failure_streaks(log, keys, failed, ~failed, limit, order)
    return top_per_group(streaks.filter("cooldown"), keys, order, 1).drop("cooldown")


def ttl_sessions(adds: DataFrame, at: str, ttl: str, last: tuple | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, bucket, session): lifetimes of a set whose expiry is renewed for all members on each add.

    With ``keys`` there is one set for each of them (a user's own), else one in all.
    Buckets are shorter than the TTL, so the set can only expire between two of them:
    one row per non-empty bucket is enough to find the gaps.  The last add before a bucket
    and the number of gaps so far are scans over these rows, cut into blocks (``groups.running``),
    so one set's long history is not one task.  ``last`` is the (time, session) an earlier part
    ended with.
    """
    seconds = seconds_of(ttl)
    width = max(1, seconds // 2)
    time = F.col(at).cast("timestamp")
    times = adds.select(*keys, time.alias("_t"))
    if last is not None:
        times = times.unionByName(adds.sparkSession.createDataFrame([(last[0],)], "_t timestamp"))
    buckets = times.groupBy(*keys, _bucket("_t", width).alias("bucket")).agg(
        F.min("_t").alias("_first"), F.max("_t").alias("_last")
    )
    order = [F.col("bucket")]
    block = blocks_of(buckets, keys, order)
    lived = running(buckets, keys, order, block, maxes={"_before": F.col("_last")}, before=True)
    expired = F.unix_micros("_first") - F.unix_micros("_before") > seconds * 1_000_000
    marked = lived.withColumn("_new", F.coalesce(expired, F.lit(False)).cast("int"))
    start = F.lit(0 if last is None else last[1])
    told = running(marked, keys, order, block, sums={"_ended": F.col("_new")})
    return told.select(*keys, "bucket", (F.col("_ended") + start).alias("session"))


def _bucket(at: str, width: int) -> Column:
    return F.floor(F.unix_seconds(F.col(at).cast("timestamp")) / width)


def seconds_of(ttl: str) -> int:
    number, unit = ttl.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def dedup_within_ttl(
    adds: DataFrame, key: str, at: str, ttl: str, order: list[Column], last: tuple | None = None, owners: Sequence[str] = ()
) -> DataFrame:
    """First row of every key within each lifetime of the seen-set, or of each owner's own set."""
    return top_per_group(with_sessions(adds, at, ttl, last, owners), [*owners, "session", key], order, 1)


def with_sessions(adds: DataFrame, at: str, ttl: str, last: tuple | None = None, owners: Sequence[str] = ()) -> DataFrame:
    """Adds ``session``, the lifetime each row falls in."""
    width = max(1, seconds_of(ttl) // 2)
    sessions = ttl_sessions(adds, at, ttl, last, owners)
    return adds.withColumn("bucket", _bucket(at, width)).join(sessions, [*owners, "bucket"]).drop("bucket")


def queue_keys(df: DataFrame) -> DataFrame:
    """The rows under their key; a row without one gets the queue's own."""
    own = queue_id(F.col("title"), F.col("company"), F.col("location"))
    return df.withColumn("job_id", F.coalesce(F.nullif("job_id", F.lit("")), own))


def enqueue_new(df: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose key is not marked seen."""
    keyed = queue_keys(df)
    return keyed.join(seen.select("job_id"), "job_id", "left_anti")
