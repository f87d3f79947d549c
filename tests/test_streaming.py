"""Streams give what their batch twins give over the same rows."""

import os
import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from postloom.operators import arrivals
from postloom.schemas import JOBS, SEEN
from postloom.operators import store
from postloom.session import STATE_STORE
from postloom.sources import keyed
from postloom.streaming import jobs, stateful

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module", autouse=True)
def few_state_stores(spark):
    """A store per partition and operator: a few will do."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """The events in four files of rising time."""
    folder = str(tmp_path_factory.mktemp("log"))
    rows = spark.read.parquet(EVENTS).select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 4).alias("board"), "user_id",
        F.when(F.col("event_type").isin("error", "signup"), "timeout").otherwise("ok").alias("outcome"), "props",
    )
    week = F.weekofyear("ts")
    for i, w in enumerate(sorted(r[0] for r in rows.select(week).distinct().collect())):
        rows.filter(week == w).coalesce(1).write.parquet(f"{folder}/part{i}")
        for f in Path(f"{folder}/part{i}").glob("*.parquet"):
            shutil.copy(f, f"{folder}/{i}.parquet")
    stream = (
        spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false")
        .parquet(f"{folder}/*.parquet")
    )
    return rows, stream


def ids(df, *columns):
    return sorted(tuple(r) for r in df.select("event_id", *columns).collect())


def test_streaks(spark, log, tmp_path):
    rows, stream = log
    how = dict(keys=["board"], failed=F.col("outcome") == "timeout", succeeded=F.col("outcome") == "ok", limit=3)
    q = jobs.streak_stream(
        stream, f"{tmp_path}/out", f"{tmp_path}/state", f"{tmp_path}/cp", order=["ts", "event_id"],
        **how,
    )
    q.awaitTermination()
    batch = arrivals.failure_streaks(rows, order=[F.col("ts"), F.col("event_id")], **how)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.select("batch").distinct().count() > 2
    assert ids(got, "streak", "cooldown") == ids(batch, "streak", "cooldown")
    assert got.filter("cooldown").count() > 0


DELAY = "7 hours"


def put(frames, folder):
    """Each frame as one file of its own, in the order a stream reads them."""
    folder.mkdir(exist_ok=True)
    for i, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(f"{folder}/part{i}")
        place = shutil.copy(next((folder / f"part{i}").glob("*.parquet")), folder / f"{i:03d}.parquet")
        os.utime(place, (1_000_000_000 + i, 1_000_000_000 + i))
    return frames[0].sparkSession.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*.parquet")


@pytest.fixture(scope="module")
def parts(log):
    """The events in micro-batches that overlap by up to six hours, then a row that lets the watermark pass all of them."""
    rows, _ = log
    arrival = F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(6 * 3600))
    dealt = rows.withColumn("part", F.floor(arrival / (6 * 86400))).cache()
    numbers = sorted(r[0] for r in dealt.select("part").distinct().collect())
    end = rows.limit(1).withColumns({"event_id": F.lit(-1).cast("long"), "ts": F.lit("2030-01-01").cast("timestamp"), "outcome": F.lit("ok")})
    return rows, [*[dealt.filter(F.col("part") == n).drop("part").orderBy(F.xxhash64("event_id", F.lit(1))) for n in numbers], end]


def all_of(df, folder):
    """The rows of a stream but for those of the closing row, and the query."""
    q = df.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").option("path", f"{folder}/out").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in q.recentProgress) > 3
    return df.sparkSession.read.parquet(f"{folder}/out"), q


BY_TIME = ["ts", "event_id"]


@pytest.mark.parametrize("owners, shards, ttl", [(["user_id"], 1, "12 hours"), ([], 4, "2 hours")])
def test_expiring_sets(parts, tmp_path, owners, shards, ttl):
    rows, frames = parts
    stream = put(frames, tmp_path / "in")
    got, _ = all_of(stateful.expiring_set_stream(stream, "board", "ts", ttl, ["event_id"], DELAY, owners, shards), tmp_path)
    got = got.filter("event_id >= 0")
    batch = arrivals.dedup_within_ttl(rows, "board", "ts", ttl, [F.col(c) for c in BY_TIME], owners=owners)
    assert ids(got, "session", "outcome", "ts") == ids(batch.withColumn("session", F.col("session").cast("bigint")), "session", "outcome", "ts")
    assert 1 < got.count() < rows.count()


def test_one_set_of_odd_rows(parts, tmp_path):
    """Members of other types and null, equal times, columns of many types, ids that are null."""
    rows, frames = parts
    odd = lambda df: df.withColumns({
        "ts": F.date_trunc("hour", "ts"), "member": F.when(F.col("user_id") % 5 > 0, F.concat(F.lit("ü"), (F.col("user_id") % 7).cast("string"))),
        "price": F.when(F.col("event_id") % 3 > 0, (F.col("event_id") / 8).cast("decimal(12,2)")), "tags": F.when(F.col("event_id") % 4 > 0, F.array("outcome", F.lit(None))),
        "day": F.when(F.col("event_id") % 2 > 0, F.to_date("ts")), "flag": F.when(F.col("event_id") % 6 > 0, F.col("event_id") % 2 > 0), "big": F.when(F.col("event_id") % 7 > 0, F.col("event_id") + F.lit(2**61)),
    })
    stream = odd(put(frames, tmp_path / "in"))
    got, _ = all_of(stateful.expiring_set_stream(stream, "member", "ts", "4 hours", ["event_id"], DELAY, shards=3), tmp_path)
    batch = arrivals.dedup_within_ttl(odd(rows), "member", "ts", "4 hours", [F.col(c) for c in BY_TIME]).withColumn("session", F.col("session").cast("bigint"))
    told = lambda df: sorted(map(repr, df.filter("event_id >= 0").select(*sorted(batch.columns)).collect()))
    assert told(got) == told(batch) and batch.select("session").distinct().count() >= 5
    assert got.schema["price"].dataType == batch.schema["price"].dataType and batch.filter("member is null").count() > 1


def test_rows_behind_the_watermark_change_nothing(parts, tmp_path):
    """Rows days late neither open a lifetime nor prolong one, and are counted as dropped."""
    rows, frames = parts
    late = rows.filter("ts < '2024-01-05'").withColumn("event_id", F.col("event_id") + 1_000_000)
    assert late.count() > 10
    stream = put([*frames[:-1], late, frames[-1]], tmp_path / "in")
    got, q = all_of(stateful.expiring_set_stream(stream, "board", "ts", "12 hours", ["event_id"], DELAY, ["user_id"]), tmp_path)
    batch = arrivals.dedup_within_ttl(rows, "board", "ts", "12 hours", [F.col(c) for c in BY_TIME], owners=["user_id"])
    assert ids(got.filter("event_id >= 0"), "session") == ids(batch.withColumn("session", F.col("session").cast("bigint")), "session")
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress) > 10


def shuffled(monkeypatch, build):
    """The rows that a keyed stream, built over a table, deals out by key."""
    found, watched = [], stateful._watched

    def noted(rows, at, cut, schema, delay):
        found.append(rows.mapInArrow(stateful._shipped(cut), schema))
        return watched(rows, at, cut, schema, delay)

    monkeypatch.setattr(stateful, "_watched", noted)
    build()
    return found[0]


ODD_ADDS = [
    (i, f"2024-01-01 0{i % 4 * 2}:{i % 7:02d}:00", None if i % 5 == 0 else i % 3, None if i % 4 == 0 else "xyz"[i % 3], "a page of text") for i in range(60)
]


@pytest.mark.parametrize("shards", [1, 3])
def test_adds_of_owners_travel_once(spark, monkeypatch, shards):
    """A shard gets each row once, whether it is a first of its member, an end of its slice or both; null owners and members too."""
    adds = spark.createDataFrame([*ODD_ADDS, *ODD_ADDS[:9]], "i int, ts string, owner int, member string, text string").withColumn("ts", F.to_timestamp("ts")).coalesce(1)
    told = lambda: stateful.expiring_set_stream(adds, "member", "ts", "12 hours", ["i"], DELAY, ["owner"], shards, columns=["i", "member"])
    rows = shuffled(monkeypatch, told)
    assert {"i", "ts", "owner", "member", "_shard", "_member"} <= set(rows.columns) and not {"text", "_home"} & set(rows.columns)
    got = rows.collect()
    slices = {}
    for r in sorted(adds.collect(), key=lambda r: (r.ts, r.i)):
        slices.setdefault((r.owner, r.ts.hour // 6), []).append(r)
    firsts = sorted(i for some in slices.values() for i in {r.member: r.i for r in reversed(some)}.values())
    ends = {i for some in slices.values() for i in (some[0].i, some[-1].i)}
    assert sorted(r.i for r in got if r._member) == firsts
    for shard in range(shards):
        kept = [r for r in got if r._shard == shard]
        assert sorted(r.i for r in kept) == sorted({*ends, *(r.i for r in kept if r._member)})


def test_columns_that_are_told(parts, tmp_path):
    rows, frames = parts
    stream = put(frames, tmp_path / "in")
    got, _ = all_of(stateful.expiring_set_stream(stream, "board", "ts", "12 hours", ["event_id"], DELAY, ["user_id"], 2, columns=["event_id"]), tmp_path)
    batch = arrivals.dedup_within_ttl(rows, "board", "ts", "12 hours", [F.col(c) for c in BY_TIME], owners=["user_id"])
    assert got.columns == ["event_id", "session"]
    assert ids(got.filter("event_id >= 0"), "session") == ids(batch.withColumn("session", F.col("session").cast("bigint")), "session")


def test_texts_that_are_not_told_stay_behind(spark, monkeypatch):
    """Of them the length travels; the time travels once; rows without key or time do not."""
    odd = [*ODD_ADDS, (60, None, 1, "w", "never"), (61, "2024-01-01 03:00:00", 1, "w", None), (62, "2024-01-01 04:00:00", 1, "w", " trimmed\u3000"), (63, "2024-01-01 04:30:00", 1, "w", "short")]
    rows = spark.createDataFrame(odd, "i int, ts string, owner int, key string, text string").withColumn("ts", F.to_timestamp("ts")).coalesce(1)
    rows = rows.withColumn("key", F.when(F.col("i") % 11 == 0, "").otherwise(F.col("key")))
    sent = shuffled(monkeypatch, lambda: stateful.emit_longer_stream(rows, "key", "text", "ts", ["i"], "12 hours", DELAY, columns=["i"]))
    assert sorted(sent.columns) == ["_len", "i", "key", "ts"]
    slices = {}
    for r in sorted(rows.filter("ts is not null and key <> ''").collect(), key=lambda r: (r.ts, r.i)):
        slices.setdefault((r.key, r.ts.hour // 6), []).append((len((r.text or "").strip()), r.i))
    want = set()
    for some in slices.values():
        records = [(length, i) for n, (length, i) in enumerate(some) if all(length > before for before, _ in some[:n])]
        want |= {*records, some[-1]}
    assert sorted((r["_len"], r.i) for r in sent.collect()) == sorted(want) and (7, 62) in want


def test_emit_if_longer(parts, tmp_path):
    """Also a key that comes back after it was forgotten; the state holds no more than the live keys."""
    rows, frames = parts
    varied = lambda df: df.withColumn("text", F.expr("repeat('x', cast((event_id * 7919) % 211 as int))")).withColumn("key", F.when(F.col("event_id") % 9 != 0, F.col("user_id")))
    # Timers set while the watermark passed them go off with the next micro-batch.
    again = frames[-1].withColumns({"event_id": F.lit(-2).cast("long"), "ts": F.lit("2030-02-01").cast("timestamp")})
    stream = varied(put([*frames, again], tmp_path / "in"))
    got, q = all_of(stateful.emit_longer_stream(stream, "key", "text", "ts", ["event_id"], "2 days", DELAY), tmp_path)
    got = got.filter("event_id >= 0")
    batch = arrivals.emit_if_longer_live(varied(rows), "key", F.length("text"), "ts", [F.col(c) for c in BY_TIME], "2 days")
    assert ids(got, "text") == ids(batch, "text")
    for_ever = arrivals.emit_if_longer(varied(rows), "key", F.length("text"), [F.col(c) for c in BY_TIME])
    assert for_ever.count() < got.count() < rows.count()
    # At the end only the closing rows are held: every earlier key has left.
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 4


def test_longer_texts_with_some_columns(parts, tmp_path):
    """Keys and texts that are null or empty too, a member of each slice at equal times, and a time that is told."""
    rows, frames = parts
    odd = lambda df: df.withColumns({
        "ts": F.date_trunc("hour", "ts"), "key": F.when(F.col("event_id") % 9 != 0, F.when(F.col("event_id") % 8 == 0, "").otherwise(F.col("user_id").cast("string"))),
        "text": F.when(F.col("event_id") % 5 > 0, F.expr("repeat('x', cast((event_id * 7919) % 211 as int))")),
    })
    stream = odd(put(frames, tmp_path / "in"))
    got, _ = all_of(stateful.emit_longer_stream(stream, "key", "text", "ts", ["event_id"], "2 days", DELAY, columns=["event_id", "ts"]), tmp_path)
    length = F.length(F.coalesce("text", F.lit("")))
    batch = arrivals.emit_if_longer_live(odd(rows), "key", length, "ts", [F.col(c) for c in BY_TIME], "2 days")
    assert got.columns == ["event_id", "ts"] and ids(got.filter("event_id >= 0"), "ts") == ids(batch, "ts")


def test_cooldowns_end_by_timer(parts, tmp_path):
    rows, frames = parts
    ok, bad = F.col("outcome") == "ok", F.col("outcome") == "timeout"
    stream = put(frames, tmp_path / "in")
    got, _ = all_of(stateful.streak_event_stream(stream, ["board"], bad, ok, 3, "ts", BY_TIME, DELAY, seconds=300, slice_seconds=3600), tmp_path)
    streaks = arrivals.failure_streaks(rows, ["board"], bad, ok, 3, [F.col(c) for c in BY_TIME])
    batch = arrivals.cooldowns(streaks, ["board"], "ts", 300)
    told = sorted((r.board, r.event, r.at) for r in got.collect())
    assert told == sorted([(r.board, "start", r.cooling_from) for r in batch.collect()] + [(r.board, "end", r.cooling_until) for r in batch.collect()])
    assert len(told) > 10


def test_blocked_events(parts, tmp_path):
    rows, frames = parts
    ok, bad = F.col("outcome") == "ok", F.col("outcome") == "timeout"
    # The closing row is a success of its board: leave that event out.
    stream = put(frames, tmp_path / "in")
    got, _ = all_of(stateful.streak_event_stream(stream, ["board"], bad, ok, 2, "ts", BY_TIME, DELAY), tmp_path)
    batch = arrivals.blocked_runs(rows, ["board"], bad, ok, 2, "ts", [F.col(c) for c in BY_TIME]).collect()
    told = sorted((r.board, r.event, r.at) for r in got.filter("at < '2029-01-01'").collect())
    assert told == sorted([(r.board, "start", r.blocked_from) for r in batch] + [(r.board, "end", r.blocked_until) for r in batch if r.blocked_until])
    assert len(told) > 10


def test_upsert_stream(spark, tmp_path):
    columns = ("doc_id long, job_id string, board string, job_url string, title string, company string, location string, "
               "description string, skills array<string>, salary string, posted_date string, employment_type string, "
               "experience_required string")

    def row(i, board, url, text):
        return (i, f"old{i}", board, url, "Data Engineer", "Acme", "Lahore", text, [], "70k - 110k", None, None, None)

    long = "We build data pipelines with Python and SQL for many customers. "
    url = "https://pk.indeed.com/viewjob?jk=abcdef012345"
    parts = [
        [row(1, "indeed", url, "short"), row(2, "rozee", "https://www.rozee.pk/a-1", long), row(3, "linkedin", "", "thin")],
        [row(4, "indeed", url + "&from=x", long * 4), row(5, "rozee", "https://www.rozee.pk/a-1/", "shorter text")],
    ]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, columns).coalesce(1).write.parquet(f"{tmp_path}/raw/part{i}")
        for f in (tmp_path / "raw" / f"part{i}").glob("*.parquet"):
            shutil.copy(f, tmp_path / "raw" / f"{i}.parquet")
    keyed.create_table(spark.createDataFrame([], JOBS), f"{tmp_path}/jobs", buckets=4)
    keyed.create_table(spark.createDataFrame([], SEEN), f"{tmp_path}/seen", buckets=4)
    stream = spark.readStream.schema(spark.createDataFrame([], columns).schema).option("maxFilesPerTrigger", 1).parquet(
        f"{tmp_path}/raw/*.parquet"
    )
    now = F.lit("2026-10-02 12:00:00").cast("timestamp")
    q = jobs.upsert_stream(stream, f"{tmp_path}/jobs", f"{tmp_path}/seen", f"{tmp_path}/stage", ["Python", "SQL"], now, f"{tmp_path}/cp", ["doc_id"])
    q.awaitTermination()
    got = keyed.read_keyed(spark, f"{tmp_path}/jobs").select("url", "skills_required", "job_description").collect()
    assert len(got) == 2
    by_url = {r.url.split("?")[0]: r for r in got}
    assert by_url["https://pk.indeed.com/viewjob"].job_description.startswith("We build data pipelines")
    assert by_url["https://pk.indeed.com/viewjob"].skills_required == ["Python", "SQL"]
    rozee = next(r for u, r in by_url.items() if "rozee" in u)
    assert rozee.skills_required == ["Python", "SQL"]
    assert keyed.read_keyed(spark, f"{tmp_path}/seen").count() == 2
    # The stream leaves what one plan over all rows gives, null ids included.
    empty = spark.createDataFrame([], JOBS)
    batches = [spark.createDataFrame(part, columns) for part in parts]
    once = store.store_batch(batches[0].unionByName(batches[1]), empty, spark.createDataFrame([], SEEN), ["Python", "SQL"], now, [F.col("doc_id")])
    key = ["job_id", "job_description", "skills_required"]
    assert sorted(once.select(key).collect()) == sorted(keyed.read_keyed(spark, f"{tmp_path}/jobs").select(key).collect())


def test_a_batch_that_broke_off_between_the_merges_is_taken_up(spark, tmp_path, monkeypatch):
    """The jobs have the batch, the marks do not: the repeated batch must not decide anew over the jobs it has changed."""
    columns = ("doc_id long, job_id string, board string, job_url string, title string, company string, location string, "
               "description string, skills array<string>, salary string, posted_date string, employment_type string, "
               "experience_required string")
    text = "We build data pipelines with Python and SQL for many customers. "
    row = lambda i: (i, f"id{i}", "rozee", f"https://www.rozee.pk/a-{i}", "Data Engineer", "Acme", "Lahore", text, [], None, None, None, None)
    stream = put([spark.createDataFrame([row(1), row(2)], columns), spark.createDataFrame([row(2), row(3)], columns)], tmp_path / "in")
    now = F.lit("2026-10-02 12:00:00").cast("timestamp")
    keyed.create_table(spark.createDataFrame([], JOBS), f"{tmp_path}/jobs", buckets=2)
    keyed.create_table(spark.createDataFrame([], SEEN), f"{tmp_path}/seen", buckets=2)
    start = lambda: jobs.upsert_stream(stream, f"{tmp_path}/jobs", f"{tmp_path}/seen", f"{tmp_path}/stage", ["Python"], now, f"{tmp_path}/cp", ["doc_id"])
    whole, broken = keyed.upsert_into, []

    def breaks_once(path, changes, **how):
        if path.endswith("seen") and not broken:
            broken.append(path)
            raise OSError("the machine went away")
        whole(path, changes, **how)

    monkeypatch.setattr(keyed, "upsert_into", breaks_once)
    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    assert keyed.read_keyed(spark, f"{tmp_path}/jobs").count() == 2 and keyed.read_keyed(spark, f"{tmp_path}/seen").count() == 0
    start().awaitTermination()
    assert keyed.read_keyed(spark, f"{tmp_path}/jobs").count() == 3 and keyed.read_keyed(spark, f"{tmp_path}/seen").count() == 3
    actions = sorted((r.batch, r.action) for r in spark.read.parquet(f"{tmp_path}/stage/batch=*").withColumn("batch", F.regexp_extract(F.input_file_name(), "batch=(.)", 1)).collect())
    assert actions == [("0", "new"), ("0", "new"), ("1", "new"), ("1", "unchanged")]
    totals = {r.batch: (r.scraped, r.enriched, r.duplicates, r.skipped) for r in spark.read.json(f"{tmp_path}/stage/totals").collect()}
    assert totals == {0: (2, 2, 0, 0), 1: (2, 1, 1, 0)}


def test_queue_stream(spark, tmp_path):
    columns = "job_id string, title string, company string, location string"
    rows = spark.createDataFrame([("a", "t", "c", "l"), ("b", "t", "c", "l"), (None, "t", "c", "l")], columns)
    rows.coalesce(1).write.parquet(f"{tmp_path}/raw")
    keyed.create_table(spark.createDataFrame([("a", None)], SEEN), f"{tmp_path}/seen", buckets=2)
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/raw")
    jobs.enqueue_stream(stream, f"{tmp_path}/seen", f"{tmp_path}/queue", f"{tmp_path}/cp").awaitTermination()
    got = [r.job_id for r in spark.read.parquet(f"{tmp_path}/queue").collect()]
    assert len(got) == 2 and "b" in got and "a" not in got and None not in got


@pytest.mark.parametrize("name", ["seen_per_user", "dedup_ttl"])
def test_queries_bring_the_state_store(spark, tmp_path, name):
    """A session that names another store, as Spark does by default, keeps it."""
    import __spark_entry__

    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=(i * i) % 3000), i % 3, ("error", "view", "signup")[i % 3], 1.0, "") for i in range(24)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, other)
    try:
        found = __spark_entry__.queries()
        streamed = sorted(map(tuple, found[f"{name}_stream"](spark, str(tmp_path)).collect()))
        assert streamed == sorted(map(tuple, found[name](spark, str(tmp_path)).collect())) and streamed
        assert spark.conf.get(STATE_STORE) == other
    finally:
        spark.conf.set(STATE_STORE, before)
