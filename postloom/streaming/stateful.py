"""Keyed state with event-time timers.

Rows of a key are held until the watermark has passed their slice of time and are then
worked on in event order, so the result does not depend on how rows were dealt out to
micro-batches, and equals that of the batch operator over the whole log.  A row later than
the watermark's delay is dropped by Spark before it gets here: it may neither open a
lifetime nor prolong one.  State leaves by timers.

Slices are short enough that nothing can expire within one, so before the shuffle Arrow
batches keep, of each key and slice, only the rows that may matter.

Every call of the state store is a message to the JVM.  So rows are held in packs, a key has one
timer at a time, and what a key knows is read and written once for all slices that the watermark has passed.
Every row that reaches a processor is taken apart in Python, too.  So where a few keys have all rows (one set in
all), rows travel as compressed bytes, one value for each slice and batch, and are worked on as arrays.

The streams need the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

import heapq
import pickle
import struct
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from postloom.functions.text import strip
from postloom.operators.arrivals import seconds_of

_LOCAL_FUNCTIONS = sys.modules[__name__]


def _shipped(thing):
    """Ship this module's classes and functions with the query, whatever is installed on the workers."""
    cloudpickle.register_pickle_by_value(_LOCAL_FUNCTIONS)
    return thing


# Rows of a key sorted by time at once, and rows of such a run in one value of the state store (by ``InOrder.weight``).
_RUN, _PACK = 20_000, 500

_EPOCH, _MICROSECOND = datetime(1970, 1, 1, tzinfo=timezone.utc), timedelta(microseconds=1)


def _values_at(places: Sequence[int]) -> Callable[[tuple], tuple]:
    """A function that gives the values at some places of a tuple as a tuple."""
    return itemgetter(*places) if len(places) > 1 else itemgetter(slice(places[0], places[0] + 1))


class InOrder(StatefulProcessor):
    """Holds rows and hands over slices of time, each sorted, once the watermark has passed them.

    Rows carry ``_us``, their event time in microseconds, or ``at``, a timestamp.  ``width`` is the length of a slice in seconds.
    They are held as plain tuples of the ``fields``, ``_us`` first: a ``Row`` searches its names at every look into it,
    and columns that no step needs are not kept.
    Rows come in runs; of a run sorted by time every pack is a value of its own, and the index says with which
    slice it begins.  So of a long log only packs that overlap are in memory together.
    """

    def __init__(self, needed: Sequence[str], order: Sequence[str], width: int, at: str | None = None):
        self.fields = ["_us", *[c for c in dict.fromkeys([*needed, *order]) if c != "_us"]]
        self.sorted_by = itemgetter(0, *[self.fields.index(c) for c in order])
        self.width, self.at = width * 1_000_000, at

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "pack bigint", "rows binary")
        self.index = handle.getValueState("index", "due bigint, packs binary")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        due, packs = self._indexed()
        for run in self._portions(self._plain(rows), _RUN):
            packs += self._hold(run, packs)
        # A timer due by now goes off after this, with all that has come.
        self._wake(due, self._end(min(packs)[0]) if due is None else min(due, self._end(min(packs)[0])), packs)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        _, packs = self._indexed()
        self.recall()
        for number, rows in self._passed(packs, now * 1000 // self.width - 1):
            rows.sort(key=self.sorted_by)
            yield from self.step(key, number, rows, timerValues)
        ends = [t for t in (self.keep(now), self._end(min(packs)[0]) if packs else None) if t is not None]
        self._wake(None, min(ends, default=None), packs)

    def _plain(self, rows: Iterator[Row]) -> Iterator[tuple]:
        """The ``fields`` of rows, all of one schema."""
        for n, row in enumerate(rows):
            if not n:
                time, values_of = row.__fields__.index(self.at or "_us"), _values_at([row.__fields__.index(c) for c in self.fields[1:]])
            values = tuple(row)
            us = values[time] if self.at is None else (values[time] - _EPOCH) // _MICROSECOND
            yield (us, *values_of(values))

    def _places(self, columns: Sequence[str]) -> list[int]:
        return [self.fields.index(c) for c in columns]

    def _indexed(self) -> tuple[int | None, list[tuple[int, int]]]:
        """When the key's timer goes off, and its packs as (first slice, number)."""
        if not self.index.exists():
            return None, []
        due, packs = self.index.get()
        return due, pickle.loads(packs)

    def _wake(self, was: int | None, due: int | None, packs: list[tuple[int, int]]) -> None:
        """Notes the packs and moves the key's timer from ``was`` to ``due``."""
        if due is None:
            self.index.clear()
            return
        if was is not None and was != due:
            self.handle.deleteTimer(was)
        if was != due:
            self.handle.registerTimer(due)
        self.index.update((due, pickle.dumps(packs)))

    def _hold(self, rows: list[tuple], packs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Writes rows into new packs."""
        rows.sort(key=itemgetter(0))
        free = max((number for _, number in packs), default=-1) + 1
        new = []
        for number, pack in enumerate(self._portions(rows, _PACK), free):
            self.held.updateValue((number,), (pickle.dumps((self.fields, pack)),))
            new.append((pack[0][0] // self.width, number))
        return new

    def _passed(self, packs: list[tuple[int, int]], last: int) -> Iterator[tuple[int, list[tuple]]]:
        """(slice, its rows) up to the slice ``last``, in order; then ``packs`` are those of the later rows."""
        packs.sort(reverse=True)
        rows: dict[int, list[tuple]] = {}
        slices: list[int] = []
        while True:
            if packs and packs[-1][0] <= (min(slices[0], last) if slices else last):
                pack = (packs.pop()[1],)
                fields, values = pickle.loads(self.held.getValue(pack)[0])
                self.held.removeKey(pack)
                if fields != self.fields:
                    # A pack of before a change of the fields.
                    values = map(_values_at([fields.index(c) for c in self.fields]), values)
                for row in values:
                    number = row[0] // self.width
                    if number not in rows:
                        heapq.heappush(slices, number)
                    rows.setdefault(number, []).append(row)
            elif slices and slices[0] <= last:
                number = heapq.heappop(slices)
                yield number, rows.pop(number)
            else:
                break
        if rows:
            packs += self._hold([row for number in slices for row in rows[number]], packs)

    def _portions(self, rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
        held, weight = [], 0
        for row in rows:
            held.append(row)
            weight += self.weight(row)
            if weight >= size:
                yield held
                held, weight = [], 0
        if held:
            yield held

    def weight(self, row: tuple) -> int:
        """How many rows one counts for where they are held."""
        return 1

    def _end(self, number: int) -> int:
        """The first millisecond after a slice."""
        return (number + 1) * self.width // 1000

    def recall(self) -> None:
        """Reads what the key knows, before its slices come."""

    def step(self, key, number: int, rows: list[tuple], timerValues) -> Iterator[Row]:
        raise NotImplementedError

    def keep(self, now: int) -> int | None:
        """The watermark has passed ``now`` (milliseconds), and all slices up to it are done: keeps what the key
        knows, and says when that ends."""
        return None

    def close(self) -> None:
        pass


def _watched(stream: DataFrame, at: str, cut: Callable | None, schema: T.StructType | None, delay: str) -> DataFrame:
    """``stream`` with ``_us``, cut down batch by batch, under a watermark."""
    rows = stream if cut is None else stream.mapInArrow(_shipped(cut), schema)
    return rows.withWatermark(at, delay)


def _gathered(batches: Iterator[pa.RecordBatch], most_rows: int = 200_000, most_bytes: int = 32_000_000) -> Iterator[pa.RecordBatch]:
    """Fewer and larger batches: the larger, the fewer rows are left of each key and slice."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= most_rows or size >= most_bytes:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows, size = [], 0, 0
    if rows:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _frame(batch: pa.RecordBatch, at: str, columns: Sequence[str]) -> pd.DataFrame:
    """Some columns of a batch, and ``_us``, the time ``at`` in microseconds."""
    f = pa.Table.from_batches([batch]).select(list(dict.fromkeys(columns))).to_pandas(types_mapper=pd.ArrowDtype)
    f["_us"] = batch.column(at).cast(pa.timestamp("us", tz="UTC")).cast(pa.int64()).to_numpy(zero_copy_only=False)
    return f


# --- a seen-set that expires ---------------------------------------------------------------


# Members that a lifetime has in memory before they go to the state store.
_MEMBERS = 100_000


class _ExpiringSet(InOrder):
    def __init__(self, columns: Sequence[str], member: str, order: Sequence[str], ttl: int, at: str | None = None):
        super().__init__([*columns, member, "_member"], order, max(1, ttl // 2), at)
        self.columns, self.member, self.ttl = list(columns), member, ttl * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.told, self.values_of = Row(*self.columns, "session"), _values_at(self._places(self.columns))
        self.life = handle.getValueState("life", "session bigint, last bigint, kept boolean")
        self.seen = handle.getMapState("seen", "member string", "there boolean")

    def recall(self):
        # ``kept``: are members of this lifetime in the state store; ``known``: members that need not be looked up there.
        self.session, self.last, self.kept = self.life.get() if self.life.exists() else (0, None, False)
        self.known, self.new = set(), set()

    def step(self, key, number, rows, timerValues):
        if self.last is not None and rows[0][0] - self.last > self.ttl:
            self.session += 1
            self._forget()
        member, is_member = self._places([self.member, "_member"])
        for row in rows:
            if not row[is_member] or (name := repr(row[member])) in self.known or name in self.new:
                continue
            if self.kept and self.seen.containsKey((name,)):
                if len(self.known) < _MEMBERS:
                    self.known.add(name)
                continue
            self.new.add(name)
            if len(self.new) >= _MEMBERS:
                self._write()
            yield self.told(*self.values_of(row), self.session)
        self.last = rows[-1][0]

    def keep(self, now):
        if self.last is None:
            return None
        due = self._end((self.last + self.ttl) // self.width)
        if over := now >= due:
            self._forget()
        else:
            self._write()
        self.life.update((self.session, self.last, self.kept))
        return None if over else due

    def _forget(self) -> None:
        if self.kept:
            self.seen.clear()
        self.kept = False
        self.known, self.new = set(), set()

    def _write(self) -> None:
        for name in self.new:
            self.seen.updateValue((name,), (True,))
        self.kept, self.new = self.kept or bool(self.new), set()


# Rows worked on at once, members in one value of the state store, and bytes of a held row that count as one row.
_CHUNK, _BUCKET, _ROW_BYTES = 200_000, 50_000, 2000


def _is_bytes(kind: pa.DataType) -> bool:
    return pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)


def _bytes_and_ends(values: pa.Array) -> tuple[bytes, np.ndarray]:
    """The values of a large binary array without nulls end to end, and where each ends, from 0 on."""
    if not len(values):
        return b"", np.zeros(1, dtype=np.int64)
    ends = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    return data[ends[0] : ends[-1]].to_pybytes() if data is not None else b"", ends - ends[0]


@dataclass
class _Flat:
    """Rows as fixed-width records and, for each column of other types, the bytes of its values end to end."""

    records: np.ndarray
    tails: list[pa.Array]

    def take(self, places: np.ndarray) -> _Flat:
        return _Flat(self.records[places], [t.take(pa.array(places)) for t in self.tails])


class _Layout:
    """How rows of the given columns become ``_Flat``, and back.

    Numbers, dates and times are fields of the record.  Strings and bytes have their length there; values of any
    other type are pickled.  ``_us`` stands for the column of times, ``at``.
    """

    def __init__(self, columns: Sequence[str], types: Sequence[pa.DataType], at: str):
        self.columns, self.types, self.at = list(columns), dict(zip(columns, types)), at
        self.kept = [c for c in columns if c != at]
        self.tails = [c for c in self.kept if self._width(c) is None]
        fields = [(str(i), self._width(c) or "<u4") for i, c in enumerate(self.kept)]
        self.dtype = np.dtype([("us", "<i8"), *fields, ("null", "u1", (-(-max(1, len(self.kept)) // 8),))])
        self.head = f"<{3 + len(self.tails)}q"

    def _width(self, column: str) -> str | None:
        kind = self.types[column]
        if pa.types.is_boolean(kind):
            return "u1"
        if pa.types.is_integer(kind) or pa.types.is_floating(kind):
            return np.dtype(kind.to_pandas_dtype()).str
        if pa.types.is_timestamp(kind) or pa.types.is_duration(kind) or pa.types.is_date64(kind):
            return "<i8"
        return "<i4" if pa.types.is_date32(kind) else None

    def _bytes_of(self, column: str, values: pa.Array) -> pa.Array:
        if _is_bytes(self.types[column]):
            return pc.fill_null(values.cast(pa.large_binary()), b"")
        return pa.array([b"" if v is None else pickle.dumps(v) for v in values.to_pylist()], pa.large_binary())

    def flat(self, batch: pa.RecordBatch, us: np.ndarray) -> _Flat:
        records, tails = np.zeros(batch.num_rows, self.dtype), []
        records["us"] = us
        nulls = np.zeros((batch.num_rows, max(1, len(self.kept))), dtype=bool)
        for i, c in enumerate(self.kept):
            values = batch.column(c)
            nulls[:, i] = values.is_null().to_numpy(zero_copy_only=False)
            if (width := self._width(c)) is None:
                tails.append(self._bytes_of(c, values))
                records[str(i)] = pc.binary_length(tails[-1]).to_numpy(zero_copy_only=False)
            else:
                if not (pa.types.is_integer(values.type) or pa.types.is_floating(values.type)):
                    values = values.cast(pa.uint8() if width == "u1" else pa.int32() if width == "<i4" else pa.int64())
                records[str(i)] = pc.fill_null(values, 0).to_numpy(zero_copy_only=False)
        records["null"] = np.packbits(nulls, axis=1)
        return _Flat(records, tails)

    def packed(self, rows: _Flat, bounds: np.ndarray, times: Iterator[tuple[int, int]]) -> Iterator[bytes]:
        """The rows between each two bounds as one value: two times, their number, the sizes of tails, and the
        records byte by byte of all rows, with the tails behind, compressed."""
        width, codec = self.dtype.itemsize, pa.Codec("lz4_raw")
        planes = rows.records.view(np.uint8).reshape(-1, width)
        tails = [_bytes_and_ends(t) for t in rows.tails]
        for begin, end, (first, last) in zip(bounds[:-1].tolist(), bounds[1:].tolist(), times):
            parts = [data[ends[begin] : ends[end]] for data, ends in tails]
            head = struct.pack(self.head, first, last, end - begin, *map(len, parts))
            yield head + codec.compress(b"".join([planes[begin:end].T.tobytes(), *parts]), asbytes=True) if end > begin else head

    def unpacked(self, values: Sequence[bytes]) -> _Flat:
        """The rows of all values."""
        width, codec, skip = self.dtype.itemsize, pa.Codec("lz4_raw"), struct.calcsize(self.head)
        heads = [struct.unpack_from(self.head, v) for v in values]
        records, at = np.empty((sum(h[2] for h in heads), width), dtype=np.uint8), 0
        tails: list[list[bytes]] = [[] for _ in self.tails]
        for value, (_, _, n, *sizes) in zip(values, heads):
            if not n:
                continue
            data = codec.decompress(value[skip:], n * width + sum(sizes), asbytes=True)
            records[at : at + n] = np.frombuffer(data, np.uint8, n * width).reshape(width, n).T
            at, place = at + n, n * width
            for tail, size in zip(tails, sizes):
                tail.append(data[place : place + size])
                place += size
        records, found = records.reshape(-1).view(self.dtype), []
        for c, parts in zip(self.tails, tails):
            ends = np.cumsum(records[str(self.kept.index(c))], dtype=np.int64)
            offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64).tobytes())
            found.append(pa.Array.from_buffers(pa.large_binary(), len(records), [None, offsets, pa.py_buffer(b"".join(parts))]))
        return _Flat(records, found)

    def stored(self, column: str, rows: _Flat) -> pa.Array:
        """A column as it is kept: numbers, or the bytes of values."""
        if column == self.at:
            return pa.array(np.ascontiguousarray(rows.records["us"]))
        i = self.kept.index(column)
        null = np.unpackbits(rows.records["null"], axis=1)[:, i].astype(bool)
        if column in self.tails:
            values = rows.tails[self.tails.index(column)]
            return pc.if_else(pa.array(null), pa.scalar(None, pa.large_binary()), values) if null.any() else values
        return pa.array(np.ascontiguousarray(rows.records[str(i)]), mask=null)

    def column(self, column: str, rows: _Flat) -> pa.Array:
        kind, values = self.types[column], self.stored(column, rows)
        if column in self.tails and not _is_bytes(kind):
            return pa.array([None if v is None else pickle.loads(v) for v in values.to_pylist()], kind)
        return values.cast(kind)

    def in_order(self, rows: _Flat, order: Sequence[str]) -> np.ndarray:
        """Places of the rows by time and ``order``."""
        return _in_order(rows.records["us"], lambda places: [self.column(c, rows.take(places)) for c in order])


def _in_order(us: np.ndarray, ties: Callable[[np.ndarray], list[pa.Array]]) -> np.ndarray:
    """Places by time; ``ties`` gives the further columns of order of some places, asked only for those of equal time."""
    places = np.argsort(us, kind="stable")
    equal = us[places][1:] == us[places][:-1]
    if equal.any():
        tied = np.flatnonzero(np.concatenate([[False], equal]) | np.concatenate([equal, [False]]))
        some = places[tied]
        further = ties(some)
        if all(v.null_count == 0 and pa.types.is_integer(v.type) for v in further):
            places[tied] = some[np.lexsort([*[v.to_numpy(zero_copy_only=False) for v in reversed(further)], us[some]])]
            return places
        columns = [pd.Series(us[some]), *[v.to_pandas(types_mapper=pd.ArrowDtype) for v in further]]
        frame = pd.concat(columns, axis=1, keys=range(len(columns)))
        places[tied] = some[frame.sort_values(list(frame.columns), kind="stable").index.to_numpy()]
    return places


def _first_of_each(group: np.ndarray, values: pa.Array) -> np.ndarray:
    """Places, in order, at which a value comes for the first time in its group."""
    found = values.dictionary_encode(null_encoding="encode")
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, first = np.unique(group.astype(np.int64) * max(1, len(found.dictionary)) + codes, return_index=True)
    return np.sort(first)


class _FlatSet(InOrder):
    """``_ExpiringSet`` over rows that hold the adds of a slice, and its first and last time, in ``_rows`` (``_Layout.packed``).

    Members of the lifetime are kept in buckets by their hash, which split as it grows.
    """

    def __init__(self, layout: _Layout, member: str, order: Sequence[str], ttl: int):
        super().__init__(["_last", "_n", "_rows"], [], max(1, ttl // 2))
        self.layout, self.member, self.by, self.ttl = layout, member, list(order), ttl * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.life = handle.getValueState("life", "session bigint, last bigint, members bigint, buckets bigint")
        self.seen = handle.getMapState("seen", "bucket bigint", "members binary")

    def weight(self, row):
        return 1 + len(row[3]) // _ROW_BYTES

    def _plain(self, rows):
        for row in rows:
            yield (*struct.unpack_from(self.layout.head, row["_rows"])[:3], row["_rows"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        _, packs = self._indexed()
        self.session, self.last, self.members, self.buckets = self.life.get() if self.life.exists() else (0, None, 0, 1)
        held, slices, size = [], [], 0
        for number, rows in self._passed(packs, now * 1000 // self.width - 1):
            held += rows
            slices += [number] * len(rows)
            size += sum(n for _, _, n, _ in rows)
            if size >= _CHUNK or len(held) >= _CHUNK:
                yield from self._told(held, np.array(slices))
                held, slices, size = [], [], 0
        if held:
            yield from self._told(held, np.array(slices))
        ends = [t for t in (self.keep(now), self._end(min(packs)[0]) if packs else None) if t is not None]
        self._wake(None, min(ends, default=None), packs)

    def _told(self, held: list[tuple], slices: np.ndarray) -> Iterator[Row]:
        """The first adds among the rows of some slices in a run; ``slices`` are those of the rows, in order."""
        numbers, begin = np.unique(slices, return_index=True)
        first = np.minimum.reduceat(np.array([us for us, _, _, _ in held]), begin)
        last = np.maximum.reduceat(np.array([at for _, at, _, _ in held]), begin)
        # No gap within a slice is longer than the time to live.
        before = np.concatenate([[first[0] if self.last is None else self.last], last[:-1]])
        session = np.cumsum(first - before > self.ttl)
        rows = self.layout.unpacked([packed for _, _, _, packed in held])
        rows = rows.take(self.layout.in_order(rows, self.by))
        of_row = session[np.searchsorted(numbers, rows.records["us"] // self.width)]
        names = self.layout.stored(self.member, rows)
        new = _first_of_each(of_row, names)
        lived = of_row[new] == 0
        if lived.any() and self.members:
            lived[lived] = self._known(names.take(pa.array(new[lived])))
            new = new[~lived]
        if session[-1]:
            self._forget()
        self._add(names.take(pa.array(new[of_row[new] == session[-1]])))
        if len(new):
            sessions = pa.compress((self.session + of_row[new]).astype("<i8").tobytes(), "lz4_raw", asbytes=True)
            yield Row(_rows=next(self.layout.packed(rows.take(new), np.array([0, len(new)]), iter([(0, 0)]))), _session=sessions)
        self.session, self.last = self.session + int(session[-1]), int(last[-1])

    def _by_bucket(self, names: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        if not len(names):
            return
        values = names.to_numpy(zero_copy_only=False) if names.null_count == 0 else pc.fill_null(names, b"" if pa.types.is_large_binary(names.type) else 0).to_numpy(zero_copy_only=False)
        bucket = (pd.util.hash_array(values, categorize=False) & np.uint64(self.buckets - 1)).astype(np.int64)
        places = np.argsort(bucket, kind="stable")
        found, begin = np.unique(bucket[places], return_index=True)
        yield from zip(found.tolist(), np.split(places, begin[1:]))

    def _known(self, names: pa.Array) -> np.ndarray:
        known = np.zeros(len(names), dtype=bool)
        for bucket, places in self._by_bucket(names):
            if self.seen.containsKey((bucket,)):
                there = pickle.loads(self.seen.getValue((bucket,))[0])
                known[places] = pc.is_in(names.take(pa.array(places)), value_set=there).to_numpy(zero_copy_only=False)
        return known

    def _add(self, names: pa.Array) -> None:
        self.members += len(names)
        while self.members > self.buckets * _BUCKET:
            # A bucket splits into itself and one more.
            self.buckets *= 2
            for bucket in range(self.buckets // 2):
                if self.seen.containsKey((bucket,)):
                    there = pickle.loads(self.seen.getValue((bucket,))[0])
                    self.seen.removeKey((bucket,))
                    for part, places in self._by_bucket(there):
                        self.seen.updateValue((part,), (pickle.dumps(there.take(pa.array(places))),))
        for bucket, places in self._by_bucket(names):
            some = names.take(pa.array(places))
            if self.seen.containsKey((bucket,)):
                some = pa.concat_arrays([pickle.loads(self.seen.getValue((bucket,))[0]), some])
            self.seen.updateValue((bucket,), (pickle.dumps(some),))

    def _forget(self) -> None:
        if self.members:
            self.seen.clear()
        self.members, self.buckets = 0, 1

    def keep(self, now):
        if self.last is None:
            return None
        due = self._end((self.last + self.ttl) // self.width)
        if over := now >= due:
            self._forget()
        self.life.update((self.session, self.last, self.members, self.buckets))
        return None if over else due


def _one_set_stream(marked: DataFrame, columns: list[str], member: str, at: str, ttl: int, order: list[str], delay: str, shards: int) -> DataFrame:
    """``expiring_set_stream`` without owners: adds travel as bytes, all of a slice, shard and batch together."""
    width = max(1, ttl // 2) * 1_000_000
    order = [c for c in order if c != at]
    layout = _Layout(columns, [to_arrow_type(marked.schema[c].dataType) for c in columns], at)
    schema = T.StructType([T.StructField(at, T.TimestampType()), T.StructField("_shard", T.IntegerType()), T.StructField("_rows", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, 500_000):
            us = batch.column("_us").to_numpy(zero_copy_only=False)
            places = _in_order(us, lambda some: [batch.column(c).take(pa.array(some)) for c in order])  # noqa: B023
            numbers, begin, of_row = np.unique(us[places] // width, return_index=True, return_inverse=True)
            first, last = us[places][begin], us[places][np.append(begin[1:], len(places)) - 1]
            names = batch.column(member if member != at else "_us").take(pa.array(places))
            new = _first_of_each(of_row, names)
            cell = batch.column("_home").to_numpy(zero_copy_only=False)[places[new]].astype(np.int64) * len(numbers) + of_row[new]
            new = places[new[np.argsort(cell, kind="stable")]]
            ends = np.concatenate([[0], np.cumsum(np.bincount(cell, minlength=shards * len(numbers)))])
            # Cells of a shard and slice, also those without a member: all shards learn of all adds.
            rows, times = layout.flat(batch.take(pa.array(new)), us[new]), list(zip(first.tolist(), last.tolist()))
            for shard in range(shards):
                packs = pa.array(layout.packed(rows, ends[shard * len(numbers) : (shard + 1) * len(numbers) + 1], iter(times)), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(last).cast(pa.timestamp("us", tz="UTC")), pa.array(np.full(len(packs), shard, dtype=np.int32)), packs], names=[at, "_shard", "_rows"])

    kept = _watched(marked, at, cut, schema, delay)
    told = "_rows binary, _session binary"
    found = kept.groupBy("_shard").transformWithState(_shipped(_FlatSet(layout, member, order, ttl)), told, "Append", "EventTime")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, sessions in zip(batch.column("_rows"), batch.column("_session")):
                rows = layout.unpacked([packed.as_py()])
                sessions = np.frombuffer(pa.decompress(sessions.as_py(), 8 * len(rows.records), "lz4_raw", asbytes=True), "<i8")
                yield pa.RecordBatch.from_arrays([*[layout.column(c, rows) for c in columns], pa.array(sessions)], names=[*columns, "session"])

    return found.mapInArrow(_shipped(rows_of), T.StructType([*[marked.schema[c] for c in columns], T.StructField("session", T.LongType())]))


def _firsts_and_ends(batch: pa.RecordBatch, sent: Sequence[str], owners: Sequence[str], member: str, at: str, order: Sequence[str], width: int, shards: int) -> Iterator[pa.RecordBatch]:
    """For each shard the first row of its members in every slice of an owner, and the first and last row of the slice; a row that is both goes once."""
    f = _frame(batch, at, [*owners, member, "_home", *order])
    f["_slice"] = f["_us"] // width
    f = f.sort_values(["_us", *order], kind="stable")
    of_slice = [*owners, "_slice"]
    first = ~f.duplicated([*of_slice, member]).to_numpy()
    end = ~(f.duplicated(of_slice) & f.duplicated(of_slice, keep="last")).to_numpy()
    home, places = f["_home"].to_numpy(dtype="int64"), f.index.to_numpy()
    for shard in range(shards):
        is_member = first & (home == shard)
        kept = is_member | end
        rows = batch.select(list(sent)).take(pa.array(places[kept], pa.int64()))
        extra = [pa.array(np.full(rows.num_rows, shard, dtype=np.int32)), pa.array(is_member[kept])]
        yield pa.RecordBatch.from_arrays([*rows.columns, *extra], schema=pa.schema([*rows.schema, ("_shard", pa.int32()), ("_member", pa.bool_())]))


def expiring_set_stream(
    stream: DataFrame, member: str, at: str, ttl: str, order: Sequence[str], delay: str, owners: Sequence[str] = (), shards: int = 1,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The first row of each member within each lifetime of a set that every add keeps alive, and ``session``, the lifetime's number.

    One set per owner, or one in all.  Equals ``arrivals.dedup_within_ttl`` over all rows that were not
    later than ``delay``; rows come out once the watermark has passed them.  State: an owner's members until
    the set expires, then two numbers.  A set with much traffic is spread over ``shards`` tasks by its
    members: of each slice the first and last add go to all of them, so all tell the same lifetimes.
    Without owners a late row counts if a row of its slice and batch is not late; one of a slice that is over never does.
    Of the rows ``columns`` are told (all); one that neither they nor the set need does not travel.
    """
    ttl_seconds = seconds_of(ttl)
    width = max(1, ttl_seconds // 2) * 1_000_000
    columns, owners, order = list(stream.columns if columns is None else columns), list(owners), list(order)
    needed = [c for c in stream.columns if c in {*columns, *owners, member, at, *order}]
    marked = stream.select(*needed).withColumn("_home", F.pmod(F.xxhash64(F.col(member)), F.lit(shards)).cast("int"))
    marked = marked.withColumn(at, F.col(at).cast("timestamp")).filter(F.col(at).isNotNull())
    if not owners:
        marked = marked.withColumn("_us", F.unix_micros(at))
        return _one_set_stream(marked, needed, member, at, ttl_seconds, order, delay, shards).select(*columns, "session")
    schema = T.StructType([*[marked.schema[c] for c in needed], T.StructField("_shard", T.IntegerType()), T.StructField("_member", T.BooleanType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            yield from _firsts_and_ends(batch, needed, owners, member, at, order, width, shards)

    kept = _watched(marked, at, cut, schema, delay)
    out = T.StructType([*[kept.schema[c] for c in columns], T.StructField("session", T.LongType())])
    processor = _shipped(_ExpiringSet(columns, member, order, ttl_seconds, at))
    return kept.groupBy(*owners, "_shard").transformWithState(processor, out, "Append", "EventTime")


# --- emit only longer texts ----------------------------------------------------------


class _LongerOnly(InOrder):
    def __init__(self, columns: Sequence[str], order: Sequence[str], keep: int, at: str | None = None):
        super().__init__([*columns, "_len"], order, max(1, keep // 2), at)
        self.columns, self.forget = list(columns), keep * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.told, self.values_of = Row(*self.columns), _values_at(self._places(self.columns))
        self.best = handle.getValueState("best", "length bigint, last bigint")

    def recall(self):
        self.longest, self.last = self.best.get() if self.best.exists() else (-1, None)

    def step(self, key, number, rows, timerValues):
        if self.last is not None and rows[0][0] - self.last > self.forget:
            self.longest = -1
        (length,) = self._places(["_len"])
        for row in rows:
            if row[length] > self.longest:
                self.longest = row[length]
                yield self.told(*self.values_of(row))
        self.last = rows[-1][0]

    def keep(self, now):
        if self.last is None:
            return None
        due = self._end((self.last + self.forget) // self.width)
        if now >= due:
            self.best.clear()
            return None
        self.best.update((self.longest, self.last))
        return due


def emit_longer_stream(
    stream: DataFrame, key: str, text: str, at: str, order: Sequence[str], keep: str, delay: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows whose text is longer than any earlier text of the key in its lifetime.

    A key that has no row for longer than ``keep`` is forgotten; when it comes back, it starts anew and
    its first row passes.  Equals ``arrivals.emit_if_longer_live``.  State: two numbers per live key.
    Rows without a key all pass, at once; rows without a time are dropped.
    Of the rows ``columns`` are told (all); of a text that is not among them only the length travels.
    """
    keep_seconds = seconds_of(keep)
    width = max(1, keep_seconds // 2) * 1_000_000
    columns, order = list(stream.columns if columns is None else columns), list(order)
    marked = stream.withColumn(at, F.col(at).cast("timestamp")).filter(F.col(at).isNotNull()).withColumn(
        "_len", F.length(strip(F.coalesce(F.col(text), F.lit("")))).cast("long")
    )
    keyless = F.coalesce(F.col(key).cast("string"), F.lit("")) == ""
    keyed = marked.filter(~keyless).select(*[c for c in stream.columns if c in {*columns, key, at, *order}], "_len")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            f = _frame(batch, at, [key, "_len", *order])
            f["_slice"] = f["_us"] // width
            f["_len"] = f["_len"].astype("int64")
            f = f.sort_values(["_us", *order], kind="stable")
            group = [f[key], f["_slice"]]
            record = f["_len"] > f["_len"].groupby(group).cummax().groupby(group).shift(fill_value=-1)
            last = ~f.duplicated([key, "_slice"], keep="last")
            yield batch.take(pa.array(f.index[record | last].to_numpy(), pa.int64()))

    kept = _watched(keyed, at, cut, keyed.schema, delay)
    out = T.StructType([kept.schema[c] for c in columns])
    longer = kept.groupBy(key).transformWithState(_shipped(_LongerOnly(columns, order, keep_seconds, at)), out, "Append", "EventTime")
    return longer.unionByName(marked.filter(keyless).select(*columns))


# --- cooldowns and blocked runs ---------------------------------------------------------------

_EVENT = "struct<us: bigint, event: string>"


def _events(failures: int, at: int, limit: int, repeats: bool) -> bool:
    """Does the ``failures``-th failure in a row start something."""
    return failures % limit == 0 if repeats else failures == limit


class _SliceOfStreaks(InOrder):
    """What a slice of a key's log says whatever came before it, and what still depends on that.

    One row per slice: the failures before its first success, the time of that success, the events after it, and the
    failures since its last success.
    """

    def __init__(self, keys: Sequence[str], order: Sequence[str], width: int, limit: int, repeats: bool):
        super().__init__([*keys, "_ok"], order, width)
        self.keys, self.limit, self.repeats = list(keys), limit, repeats

    def step(self, key, number, rows, timerValues):
        lead, first, events, streak = [], None, [], 0
        (ok,) = self._places(["_ok"])
        for row in rows:
            if row[ok]:
                if first is None:
                    first = row[0]
                elif not self.repeats and streak >= self.limit:
                    events.append(Row(us=row[0], event="end"))
                streak = 0
            elif first is None:
                lead.append(row[0])
            else:
                streak += 1
                if _events(streak, row[0], self.limit, self.repeats):
                    events.append(Row(us=row[0], event="start"))
        # Slices go on as of now: their own time has passed.
        now = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms").to_pydatetime()
        yield Row(**{k: rows[0][p] for k, p in zip(self.keys, self._places(self.keys))}, _slice=number, _at=now, _lead=lead, _first=first, _events=events, _tail=streak)


class _Streaks(StatefulProcessor):
    """Carries the streak of a key from slice to slice; a timer ends what lasts a set time."""

    def __init__(self, keys: Sequence[str], limit: int, seconds: int | None):
        self.keys, self.limit, self.seconds = list(keys), limit, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.streak = handle.getValueState("streak", "n bigint")
        self.until = handle.getMapState("until", "ms bigint", "ends array<bigint>")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentWatermarkInMs()
        streak = self.streak.get()[0] if self.streak.exists() else 0
        waiting: dict[int, list[int]] = {}
        for row in sorted(rows, key=lambda r: r["_slice"]):
            told = []
            for us in row["_lead"]:
                streak += 1
                if _events(streak, us, self.limit, self.seconds is not None):
                    told.append((us, "start"))
            if row["_first"] is not None:
                if self.seconds is None and streak >= self.limit:
                    told.append((row["_first"], "end"))
                streak = row["_tail"]
            told += [(e["us"], e["event"]) for e in row["_events"]]
            for us, event in told:
                yield Row(**dict(zip(self.keys, key)), event=event, _us=us)
                if self.seconds is not None:
                    end = us + self.seconds * 1_000_000
                    if (due := end // 1000 + 1) <= now:
                        # Its timer would go off at once.
                        yield Row(**dict(zip(self.keys, key)), event="end", _us=end)
                    else:
                        waiting.setdefault(due, []).append(end)
        self.streak.update((streak,))
        for due, ends in waiting.items():
            held = list(self.until.getValue((due,))[0]) if self.until.containsKey((due,)) else []
            self.until.updateValue((due,), ([*held, *ends],))
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        due = (expiredTimerInfo.getExpiryTimeInMs(),)
        for us in self.until.getValue(due)[0]:
            yield Row(**dict(zip(self.keys, key)), event="end", _us=us)
        self.until.removeKey(due)

    def close(self) -> None:
        pass


def streak_event_stream(
    stream: DataFrame, keys: Sequence[str], failed: Column, succeeded: Column, limit: int, at: str, order: Sequence[str], delay: str,
    seconds: int | None = None, slice_seconds: int = 60,
) -> DataFrame:
    """(keys, event, at): when something starts and ends that failures in a row bring about.

    With ``seconds``, a cooldown starts at every ``limit``-th failure in a row and a timer ends it so many
    seconds later (``arrivals.cooldowns``).  Without, a key is blocked from its ``limit``-th failure in a
    row until its next success (``arrivals.blocked_runs``).

    Rows of a key meet slice by slice first, each slice on its own task, and send one row on: a key with much
    of the log is spread over its slices, and only failures that no success of their slice precedes travel.
    """
    keys, order = list(keys), list(order)
    marked = stream.select(*keys, F.col(at).cast("timestamp").alias("_at"), *[c for c in order if c != at], succeeded.alias("_ok"), failed.alias("_failed"))
    marked = marked.filter((F.col("_ok") | F.col("_failed")) & F.col("_at").isNotNull())
    us = F.unix_micros("_at")
    marked = marked.drop("_failed").withColumns({"_us": us, "_slice": F.floor(us / (slice_seconds * 1_000_000))})
    marked = marked.withWatermark("_at", delay)
    fields = [marked.schema[k] for k in keys]
    told = T.StructType(
        [*fields, T.StructField("_slice", T.LongType()), T.StructField("_at", T.TimestampType()), T.StructField("_lead", T.ArrayType(T.LongType())), T.StructField("_first", T.LongType()),
         T.StructField("_events", T.ArrayType(T._parse_datatype_string(_EVENT))), T.StructField("_tail", T.LongType())]
    )
    summary = _SliceOfStreaks(keys, [c for c in order if c != at], slice_seconds, limit, seconds is not None)
    slices = marked.groupBy(*keys, "_slice").transformWithState(_shipped(summary), told, "Append", "EventTime", eventTimeColumnName="_at")
    out = T.StructType([*fields, T.StructField("event", T.StringType()), T.StructField("_us", T.LongType())])
    events = slices.groupBy(*keys).transformWithState(_shipped(_Streaks(keys, limit, seconds)), out, "Append", "EventTime")
    return events.select(*keys, "event", F.timestamp_micros("_us").alias("at"))
