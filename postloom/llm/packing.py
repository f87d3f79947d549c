"""Best-fit packing of token sequences.

Documents are cut into pieces of at most ``capacity`` tokens, and pieces are put into
sequences of that capacity, largest first, each into the fullest sequence that still
takes it.  It runs in bulk-synchronous supersteps:

1. Documents and gaps are range-sorted by size.  Sizes are integers up to the capacity, so
   a range is a run of equal sizes: (size, first rank, count).  Documents get their rank
   in the run on the executors, from counts per task.
2. A superstep takes the next run of documents, sweeps the gap runs upwards from its
   successor (the smallest gap that takes it), and gives both sides of a match by rank:
   rank r of the documents goes to sequence (r // q) of the gap run, q to a sequence.
3. Gap runs are updated (split where ranks ended) and the next superstep begins; documents
   that no gap takes open sequences.

The runs are bounded by the capacity, never by the number of documents: a sweep over a
gap run leaves less than half of the gap, and a superstep splits one run in three at most,
so there are at most 4 * capacity runs and 50 * capacity matches, whatever the input.
Documents themselves never leave the executors: each finds its match by (size, rank).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.bpe import PIECE_BYTES, encoder
from postloom.llm.shared import numbered, python_batches, staged
from postloom.llm.words import pieces as text_pieces

CAPACITY = 4096
_PIECES = "uid bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_RANKS = 1 << 48  # above any rank; sizes stand over it in one search key


def token_pieces(docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document: its ids, then ``end``, cut every ``capacity`` ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, end).encode
        for batch in batches:
            for some in text_pieces(batch, limit=PIECE_BYTES):
                ids, counts = encode(some.column("text"))
                ids = ids.astype("<u4", copy=False)
                per_doc = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), per_doc)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
                start = piece * capacity
                length = np.minimum(capacity, counts[row] - start)
                begin = (np.cumsum(counts) - counts)[row] + start
                crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(begin.tolist(), length.tolist())]
                taken = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [some.column("uid").take(taken), some.column("doc_id").take(taken), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"],
                )

    python_batches(docs.sparkSession)
    return numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, _PIECES)


def matches(counts: np.ndarray, capacity: int) -> np.ndarray:
    """The supersteps over runs.  ``counts[s]``: documents of size s.

    Rows (size, first rank, q, first sequence, offset): documents of this size and these
    ranks on go to this sequence and the following ones, q to each, from this offset on.
    """
    out: list[tuple[int, int, int, int, int]] = []
    sizes: list[int] = []  # gap sizes that occur, ascending
    runs: dict[int, list[tuple[int, int]]] = {}  # gap size: runs of (first sequence, count)
    opened = 0

    def keep(gap: int, first: int, count: int) -> None:
        if count and gap:
            if gap not in runs:
                runs[gap] = []
                insort(sizes, gap)
            runs[gap].append((first, count))

    for size in range(capacity, 0, -1):
        left, rank = int(counts[size]), 0
        while left:
            at = bisect_left(sizes, size)
            if at == len(sizes):
                fresh = -(-left // (capacity // size))
                keep(capacity, opened, fresh)
                opened += fresh
                continue
            gap = sizes[at]
            first, count = runs[gap].pop()
            if not runs[gap]:
                del runs[gap], sizes[at]
            q = gap // size
            full = min(count, left // q)
            if full:
                out.append((size, rank, q, first, capacity - gap))
                keep(gap - q * size, first, full)
                rank, left, first, count = rank + full * q, left - full * q, first + full, count - full
            if left and count:
                out.append((size, rank, left, first, capacity - gap))
                keep(gap - left * size, first, 1)
                left, first, count = 0, first + 1, count - 1
            keep(gap, first, count)
    return np.array(out, dtype=np.int64).reshape(-1, 5)


def ranked(sized: DataFrame) -> DataFrame:
    """Adds ``rank`` from 0 within equal ``length``; ``part`` says which task staged a row.

    Numbers within (length, part) plus what earlier parts hold: no group is larger than
    what one task wrote, so a size that a third of all rows share is no hot key.
    """
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = sized.groupBy("length", "part").count()
    offsets = held.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "part").orderBy("uid", "piece")
    numbered_rows = sized.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered_rows.join(offsets, ["length", "part"]).withColumn("rank", F.col("before") + F.col("inside")).drop("before", "inside")


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows of ``uid, piece, length`` (1 to capacity).

    Ties and repeated rows are packed one by one; an empty table gives an empty one.
    """
    sized = staged(rows.withColumn("part", F.spark_partition_id()), "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in sized.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    plan = matches(counts, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared = sized.sparkSession.sparkContext.broadcast(plan)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, first, q, sequence, offset = shared.value.T
        keys = size * _RANKS + first
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            at = np.searchsorted(keys, length * _RANKS + rank, side="right") - 1
            behind = rank - first[at]
            frame["sequence_id"] = sequence[at] + behind // q[at]
            frame["offset"] = offset[at] + behind % q[at] * length
            yield frame.drop(columns=["rank"])

    out = ranked(sized).drop("part")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.drop("rank").schema)
    return out.mapInPandas(place, f"{fields}, sequence_id bigint, offset bigint")


def packed_documents(docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """Where each piece of each document lies.

    Needs columns doc_id and text; others are ignored, whatever their names.  Null text is
    empty: the document is its end id alone.  Null or repeated doc_ids: each row is a
    document of its own.  Columns: uid, doc_id, piece, start, length, ids_crc32, sequence_id,
    offset.
    """
    return pack(token_pieces(docs, tokenizer, end, capacity), capacity)
