"""The keyed processors over a state store that counts its calls, each of which is a message to the JVM."""

import pickle
import random
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row

from postloom.session import PARTITIONS, STATE_STORE, keyed_state
from postloom.streaming import stateful

KEY = ("k",)


class Store:
    """One key's state and timers."""

    def __init__(self):
        self.calls, self.timers, self.maps, self.most = 0, set(), {}, 0

    def called(self):
        self.calls += 1

    def getMapState(self, name, *_):
        return Map(self, self.maps.setdefault(name, {}))

    def getValueState(self, name, *_):
        return Value(self, self.maps.setdefault(name, {}))

    def registerTimer(self, due):
        self.called()
        self.timers.add(due)
        self.most = max(self.most, len(self.timers))

    def deleteTimer(self, due):
        self.called()
        self.timers.remove(due)


class Map:
    def __init__(self, store, values):
        self.store, self.values = store, values

    def containsKey(self, key):
        self.store.called()
        return key in self.values

    def getValue(self, key):
        self.store.called()
        return self.values[key]

    def updateValue(self, key, value):
        self.store.called()
        self.values[key] = value

    def removeKey(self, key):
        self.store.called()
        del self.values[key]

    def clear(self):
        self.store.called()
        self.values.clear()


class Value(Map):
    def exists(self):
        return self.containsKey(())

    def get(self):
        return self.getValue(())

    def update(self, value):
        self.updateValue((), value)


def fed(processor, batches):
    """What the processor tells of micro-batches (rows, watermark in ms after them), and its store."""
    store, told = Store(), []
    processor.init(store)
    for rows, watermark in batches:
        now = SimpleNamespace(getCurrentWatermarkInMs=lambda w=watermark: w)
        if rows:
            told += processor.handleInputRows(KEY, iter(rows), now)
        for due in sorted(t for t in store.timers if t <= watermark):
            told += processor.handleExpiredTimer(KEY, now, SimpleNamespace(getExpiryTimeInMs=lambda d=due: d))
            store.timers.discard(due)
    return told, store


END = 10**12


def log(n, seconds, members, seed=1):
    """Rows in no order, a few of them after long gaps."""
    draw, us, rows = random.Random(seed), 0, []
    for i in range(n):
        us += draw.randrange(seconds * 1_000_000) + (30 * seconds * 1_000_000 if draw.random() < 0.02 else 0)
        rows.append(Row(i=i, _us=us, m=draw.randrange(members), _len=draw.randrange(60), _member=True))
    draw.shuffle(rows)
    return rows


def dealt(rows, parts, delay_us):
    """Micro-batches of rising time that overlap within the delay."""
    draw = random.Random(2)
    late = sorted(rows, key=lambda r: r["_us"] + draw.randrange(delay_us))
    size = -(-len(rows) // parts)
    batches, top = [], 0
    for start in range(0, len(rows), size):
        part = late[start : start + size]
        top = max([top, *(r["_us"] for r in part)])
        batches.append((part, max(0, (top - delay_us) // 1000)))
    return [*batches, ([], END)]


def lifetimes(rows, ttl_us):
    session, last, out = 0, None, []
    for r in sorted(rows, key=lambda r: (r["_us"], r["i"])):
        session += last is not None and r["_us"] - last > ttl_us
        last = r["_us"]
        out.append((session, r))
    return out


@pytest.mark.parametrize("pack, members", [(500, 100_000), (3, 2)])
@pytest.mark.parametrize("parts", [1, 7])
def test_expiring_set_in_packs(monkeypatch, pack, members, parts):
    monkeypatch.setattr(stateful, "_PACK", pack)
    monkeypatch.setattr(stateful, "_RUN", 7 * pack)
    monkeypatch.setattr(stateful, "_MEMBERS", members)
    rows = log(900, 60, 12)
    seen, want = set(), []
    for session, r in lifetimes(rows, 600_000_000):
        if (session, r["m"]) not in seen:
            want.append((r["i"], session))
        seen.add((session, r["m"]))
    told, store = fed(stateful._ExpiringSet(["i"], "m", ["i"], 600), dealt(rows, parts, 300_000_000))
    assert [(r["i"], r["session"]) for r in told] == want and len(want) > 50
    assert not store.timers and not store.maps["held"] and not store.maps["seen"] and not store.maps["index"]


@pytest.mark.parametrize("pack", [500, 3])
@pytest.mark.parametrize("parts", [1, 7])
def test_longer_only_in_packs(monkeypatch, pack, parts):
    monkeypatch.setattr(stateful, "_PACK", pack)
    monkeypatch.setattr(stateful, "_RUN", 7 * pack)
    rows = log(900, 60, 12)
    best, want = {}, []
    for session, r in lifetimes(rows, 600_000_000):
        if r["_len"] > best.get(session, -1):
            best[session] = r["_len"]
            want.append(r["i"])
    told, store = fed(stateful._LongerOnly(["i"], ["i"], 600), dealt(rows, parts, 300_000_000))
    assert [r["i"] for r in told] == want and len(want) > 30
    assert not store.timers and not store.maps["held"] and not store.maps["best"] and not store.maps["index"]


@pytest.mark.parametrize("name", ["set", "longer"])
def test_held_rows_have_what_the_step_needs(name):
    """Neither the timestamp beside the microseconds nor a column that is not told."""
    make = {"set": lambda at=None: stateful._ExpiringSet(["i"], "m", ["i"], 600, at), "longer": lambda at=None: stateful._LongerOnly(["i"], ["i"], 600, at)}[name]
    rows, epoch = [*log(300, 60, 12), Row(i=-1, _us=-1, m=5, _len=3, _member=True)], datetime(1970, 1, 1, tzinfo=timezone.utc)
    zone = timezone(timedelta(hours=5, minutes=45))
    timed = [Row(text="long", at=(epoch + timedelta(microseconds=r["_us"])).astimezone(zone), i=r["i"], m=r["m"], _len=r["_len"], _member=True) for r in rows]
    told, _ = fed(make(), [(rows, 0), ([], END)])
    again, _ = fed(make("at"), [(timed, 0), ([], END)])
    assert told == again and told[0]["i"] == -1
    _, store = fed(make("at"), [(timed, -10_000_000)])
    for (held,) in store.maps["held"].values():
        fields, values = pickle.loads(held)
        assert set(fields) == {"_us", "i", *(["m", "_member"] if name == "set" else ["_len"])} and not any(isinstance(v, datetime) for v in values[0])


def test_packs_of_other_fields_are_read():
    """State that was written when whole rows were held."""
    rows = log(300, 60, 12)
    told, _ = fed(stateful._LongerOnly(["i"], ["i"], 600), [(rows, 0), ([], END)])
    processor, store = stateful._LongerOnly(["i"], ["i"], 600), Store()
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: END)
    processor.init(store)
    list(processor.handleInputRows(KEY, iter(rows), now))
    for number in store.maps["held"]:
        store.maps["held"][number] = (pickle.dumps((rows[0].__fields__, [tuple(r) for r in rows])),)
    assert [*processor.handleExpiredTimer(KEY, now, None)] == told and len(store.maps["held"]) == 0


@pytest.mark.parametrize("name", ["set", "longer"])
def test_calls_do_not_grow_with_the_slices(name):
    """2,000 rows in more than a thousand slices: a few calls, and one timer at a time."""
    make = {"set": lambda: stateful._ExpiringSet(["i"], "m", ["i"], 60), "longer": lambda: stateful._LongerOnly(["i"], ["i"], 60)}[name]
    rows = log(2000, 60, 2000)
    assert len({r["_us"] // 30_000_000 for r in rows}) > 1000
    told, store = fed(make(), [(rows, 0), ([], END)])
    assert len(told) > 100 and store.calls < 40 and store.most == 1


def test_cooldowns_that_are_over_need_no_timer():
    slices = [Row(_slice=i, _lead=[i * 60_000_000 + j for j in range(3)], _first=i * 60_000_000 + 10, _events=[], _tail=0) for i in range(200)]
    told, store = fed(stateful._Streaks(["k"], 3, 30), [(slices, 150 * 60_000)])
    # A batch before the watermark passes the rest, whose ends wait for their timers.
    assert sum(r["event"] == "end" for r in told) == 150 and sum(r["event"] == "start" for r in told) == 200
    assert len(store.timers) == 50 and store.calls < 160
    told, store = fed(stateful._Streaks(["k"], 3, 30), [(slices, 150 * 60_000), ([], END)])
    assert sorted(r["_us"] for r in told if r["event"] == "end") == [r["_us"] + 30_000_000 for r in sorted((r for r in told if r["event"] == "start"), key=lambda r: r["_us"])]
    assert not store.timers and not store.maps["until"]


def test_keyed_state_has_no_more_partitions_than_cores(spark):
    before = spark.conf.get(PARTITIONS), spark.conf.get(STATE_STORE)
    try:
        spark.conf.set(PARTITIONS, "200")
        with keyed_state(spark):
            assert int(spark.conf.get(PARTITIONS)) == max(8, spark.sparkContext.defaultParallelism)
        assert spark.conf.get(PARTITIONS) == "200"
        spark.conf.set(PARTITIONS, "2")
        with keyed_state(spark):
            assert spark.conf.get(PARTITIONS) == "2"
    finally:
        spark.conf.set(PARTITIONS, before[0])
    assert (spark.conf.get(PARTITIONS), spark.conf.get(STATE_STORE)) == before


LAYOUT = stateful._Layout(["i", "m", "at"], [pa.int64(), pa.string(), pa.timestamp("us", tz="UTC")], "at")


def flat(rows, width_us, per_pack=5):
    """The rows packed slice by slice, as the cut before the shuffle does, a few of them in each."""
    slices = {}
    for r in rows:
        slices.setdefault(r["_us"] // width_us, []).append(r)
    packs = []
    for some in slices.values():
        for start in range(0, len(some), per_pack):
            part = some[start : start + per_pack]
            us = np.array([r["_us"] for r in part])
            batch = pa.RecordBatch.from_arrays([pa.array([r["i"] for r in part]), pa.array([r["m"] and str(r["m"]) for r in part], pa.string())], names=["i", "m"])
            values = LAYOUT.packed(LAYOUT.flat(batch, us), np.array([0, len(part)]), iter([(int(us.min()), int(us.max()))]))
            packs += [Row(_rows=v) for v in values]
    return packs


def told_rows(told):
    out = []
    for row in told:
        rows = LAYOUT.unpacked([row["_rows"]])
        sessions = np.frombuffer(pa.decompress(row["_session"], 8 * len(rows.records), "lz4_raw", asbytes=True), "<i8")
        out += zip(LAYOUT.column("i", rows).to_pylist(), sessions.tolist())
    return out


@pytest.mark.parametrize("chunk, bucket, pack", [(200_000, 50_000, 500), (7, 2, 3)])
@pytest.mark.parametrize("parts", [1, 7])
def test_set_of_flat_rows(monkeypatch, chunk, bucket, pack, parts):
    """Lifetimes, members (a null is one) and what is left in the state, whatever is worked on at once."""
    monkeypatch.setattr(stateful, "_CHUNK", chunk)
    monkeypatch.setattr(stateful, "_BUCKET", bucket)
    monkeypatch.setattr(stateful, "_PACK", pack)
    monkeypatch.setattr(stateful, "_RUN", 7 * pack)
    rows = [Row(i=r["i"], _us=r["_us"], m=r["m"] or None) for r in log(900, 60, 12)]
    seen, want = set(), []
    for session, r in lifetimes(rows, 600_000_000):
        if (session, r["m"]) not in seen:
            want.append((r["i"], session))
        seen.add((session, r["m"]))
    batches = [(flat(some, 300_000_000), watermark) for some, watermark in dealt(rows, parts, 300_000_000)]
    told, store = fed(stateful._FlatSet(LAYOUT, "m", ["i"], 600), batches)
    assert told_rows(told) == want and len(want) > 50
    assert not store.timers and not store.maps["held"] and not store.maps["seen"] and not store.maps["index"]


def test_calls_do_not_grow_with_the_members():
    """20,000 members of one lifetime, told and then seen again: a few calls of the store."""
    first = [Row(i=i, _us=i * 1000, m=i + 1) for i in range(20_000)]
    again = [Row(i=20_000 + i, _us=60_000_000 + i * 1000, m=i + 1) for i in range(20_001)]
    told, store = fed(stateful._FlatSet(LAYOUT, "m", ["i"], 60), [(flat(first, 30_000_000, 2000), 30_000), (flat(again, 30_000_000, 2000), 70_000)])
    assert [i for i, _ in told_rows(told)] == list(range(20_000)) and store.calls < 60
    told, store = fed(stateful._FlatSet(LAYOUT, "m", ["i"], 60), [(flat(first, 30_000_000, 2000), 30_000), (flat(again, 30_000_000, 2000), END)])
    assert [i for i, _ in told_rows(told)] == [*range(20_000), 40_000] and store.calls < 60


def test_flat_rows_come_back():
    """Values of all kinds, with nulls, over several packs."""
    columns = {
        "at": pa.array([5, 1, 3], pa.timestamp("us", tz="UTC")), "s": pa.array(["ä", None, ""]), "d": pa.array([Decimal("1.50"), None, Decimal("-2.25")], pa.decimal128(9, 2)),
        "l": pa.array([[1, None], None, []], pa.list_(pa.int32())), "b": pa.array([True, None, False]), "f": pa.array([0.5, None, -0.0]), "big": pa.array([2**62 + 1, None, -1]),
        "day": pa.array([date(2024, 1, 2), None, date(1969, 1, 1)]), "ntz": pa.array([7, None, -7], pa.timestamp("us")), "raw": pa.array([b"\x00\xff", b"", None]), "tiny": pa.array([1, None, -1], pa.int8()),
        **{f"n{i}": pa.array([None, i, None], pa.int32()) for i in range(9)},
    }
    layout = stateful._Layout(list(columns), [c.type for c in columns.values()], "at")
    rows = layout.flat(pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)), np.array([5, 1, 3]))
    packs = list(layout.packed(rows, np.array([0, 2, 2, 3]), iter([(1, 5), (2, 2), (3, 3)])))
    back = layout.unpacked(packs)
    for name, values in columns.items():
        assert layout.column(name, back).to_pylist() == values.to_pylist() and layout.column(name, back).type == values.type, name
    assert layout.in_order(back, ["s"]).tolist() == [1, 2, 0]
