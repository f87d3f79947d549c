"""Ranked lexical search with hashed max-sketches.

The impact of a term on a document grows with its count in it and, for one document, with
nothing else.  So a document is folded into a sketch of hashed cells, each with the greatest
count of the terms that fall into it: whatever the corpus statistics are, the impact of that
count bounds the impact of every term of the cell.  Items are looked up in batches: the
impacts of a batch of sketches times the weights of a block of items gives an upper bound of
every score.  Rescoring goes down the bounds, on whole texts and true counts, until the
bound of what is left falls under the score an item's last place already has.

Two passes per block of items.  The first reads sketches only: the documents with each
item's greatest bounds are rescored, which gives every item a score and id that its last place
cannot fall below.  The second reads sketches and texts and rescores whatever can still reach
that.  Each task keeps its best places per item, so what is shuffled follows the number of
tasks and items, not the documents.

Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.operators.groups import top_per_group
from postloom.llm.shared import key_filter, numbered, python_batches, small, staged
from postloom.llm.words import Words, in_filter, lists, owner, pieces, words_of

PLACES = 20
CELL_BITS = 16  # cells of a sketch as a power of two, up to 16
ITEMS = 256  # items of a block, on average
TERMS = 1 << 15  # terms of a block, on average; an item of more is a block of its own
_STEP = 256  # documents rescored between two looks at the thresholds
_LAST = np.iinfo(np.int64).max


def _counted(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of each text's distinct terms, in order of text and hash."""
    text = owner(w.first, np.arange(len(w.hashes)))
    order = np.lexsort((w.hashes, text))
    text, hashes = text[order], w.hashes[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    begins = np.flatnonzero(new)
    return text[begins], hashes[begins], np.diff(np.append(begins, len(hashes)))


def item_terms(items: DataFrame) -> DataFrame:
    """item (a number per row), item_id, hash, times: the distinct terms of each item that has any."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                text, hashes, times = _counted(words_of(some.column("text")))
                rows = [some.column(c).take(pa.array(text)) for c in ("item", "item_id")]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(hashes.view(np.int64)), pa.array(times)], names=["item", "item_id", "hash", "times"])

    rows = numbered(items, F.col("item_id").cast("bigint").alias("item_id"), "text").withColumnRenamed("uid", "item")
    return rows.mapInArrow(scan, "item bigint, item_id bigint, hash bigint, times bigint")


def sketches(docs: DataFrame, asked: Broadcast, bits: int = CELL_BITS) -> DataFrame:
    """uid, doc_id, text, n_terms, the sketch (cells, their greatest counts), and the hashes among the asked terms.

    A cell is the leading ``bits`` bits of a term's hash, so cells come in order; both columns are
    little-endian arrays of 16 and 32 bits.  ``asked`` is a Bloom filter.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                w = words_of(some.column("text"))
                text, hashes, counts = _counted(w)
                n = some.num_rows
                known = in_filter(asked.value, hashes)
                hits = lists(pa.array(hashes[known].view(np.int64)), np.bincount(text[known], minlength=n))
                cell = (hashes >> np.uint64(64 - bits)).astype("<u2")
                new = np.ones(len(cell), dtype=bool)
                new[1:] = (cell[1:] != cell[:-1]) | (text[1:] != text[:-1])
                begins = np.flatnonzero(new)
                tops = np.maximum.reduceat(counts, begins) if begins.size else counts
                held = np.concatenate([[0], np.cumsum(np.bincount(text[begins], minlength=n))])
                cells, tops = cell[begins].tobytes(), tops.astype("<u4").tobytes()
                packed = [pa.array([data[a * size : b * size] for a, b in zip(held[:-1].tolist(), held[1:].tolist())], pa.binary()) for data, size in ((cells, 2), (tops, 4))]
                yield pa.RecordBatch.from_arrays(
                    [some.column("uid"), some.column("doc_id"), some.column("text"), pa.array(np.diff(w.first).astype(np.int64)), *packed, hits],
                    names=["uid", "doc_id", "text", "n_terms", "cells", "tops", "hits"],
                )

    python_batches(docs.sparkSession)
    rows = numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(scan, "uid bigint, doc_id bigint, text string, n_terms bigint, cells binary, tops binary, hits array<bigint>")


@dataclass
class Block:
    """Some items as matrices: a row per term or per cell that any of them holds, a column per item."""

    items: np.ndarray
    terms: np.ndarray
    term_weights: np.ndarray
    cells: np.ndarray
    cell_weights: np.ndarray
    n_docs: int
    n_terms: int
    # What an item's last place has at least: score and document.
    least: np.ndarray
    least_doc: np.ndarray


def _block(rows: list, n_docs: int, n_terms: int, bits: int) -> Block:
    """From (item, hash, times, df); terms in no document weigh on nothing."""
    items, column = np.unique(np.array([r[0] for r in rows], dtype=np.int64), return_inverse=True)
    hashes = np.array([r[1] for r in rows], dtype=np.int64).view(np.uint64)
    weights = np.array([r[2] * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r[3] + 1))) for r in rows], dtype=np.float64)
    terms, term = np.unique(hashes, return_inverse=True)
    cells, cell = np.unique((hashes >> np.uint64(64 - bits)).astype(np.int64), return_inverse=True)
    by_term, by_cell = np.zeros((len(terms), len(items))), np.zeros((len(cells), len(items)))
    np.add.at(by_term, (term, column), weights)
    np.add.at(by_cell, (cell, column), weights)
    return Block(items, terms, by_term, cells, by_cell, n_docs, n_terms, np.zeros(len(items)), np.full(len(items), -1, dtype=np.int64))


def _impacts(block: Block, docs: np.ndarray, rows: np.ndarray, counts: np.ndarray, n: np.ndarray, width: int) -> np.ndarray:
    """Documents by rows of a weight matrix: the impact of each count. ``n`` are the lengths of the documents."""
    m = 75 + (25 * n * block.n_docs) // block.n_terms
    out = np.zeros((len(n), width))
    out[docs, rows] = (1_000_000_000 * counts) // (1000 * counts + 12 * m[docs])
    return out


def _bounds(block: Block, some: pa.RecordBatch) -> np.ndarray:
    """Upper bound of the score of each document for each item.

    Whole numbers: exact up to 2**53, that is for items of up to 300,000 terms; the slack is for longer ones.
    """
    cells = some.column("cells").to_pylist()
    sizes = np.array([len(c) // 2 for c in cells], dtype=np.int64)
    cell = np.frombuffer(b"".join(cells), dtype="<u2").astype(np.int64)
    tops = np.frombuffer(b"".join(some.column("tops").to_pylist()), dtype="<u4").astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    row = np.minimum(np.searchsorted(block.cells, cell), len(block.cells) - 1)
    held = block.cells[row] == cell
    n = some.column("n_terms").to_numpy(zero_copy_only=False)
    scores = _impacts(block, doc[held], row[held], tops[held], n, len(block.cells)) @ block.cell_weights
    return np.where(scores < 2.0**53, scores, scores * (1 + 2.0**-30))


def _exact(block: Block, texts: pa.Array) -> np.ndarray:
    """The score of each text for each item."""
    w = words_of(texts)
    row = np.minimum(np.searchsorted(block.terms, w.hashes), len(block.terms) - 1)
    held = np.flatnonzero(block.terms[row] == w.hashes)
    keys, counts = np.unique(owner(w.first, held) * len(block.terms) + row[held], return_counts=True)
    return _impacts(block, keys // len(block.terms), keys % len(block.terms), counts, np.diff(w.first).astype(np.int64), len(block.terms)) @ block.term_weights


class _Best:
    """The best places of each item so far: score, then smallest doc_id (null last), then row."""

    def __init__(self, block: Block, places: int):
        self.block, self.places = block, places
        self.least, self.least_doc = block.least.copy(), block.least_doc.copy()
        self.rows = [np.zeros(0, dtype) for dtype in (np.int64, np.float64, np.int64, np.int64)]  # item column, score, doc, uid

    def leading(self, scores: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, item column) of the reachable scores that are among the greatest here, ties included."""
        able = self.reachable(scores, doc)
        if len(scores) > self.places:
            able &= scores >= np.partition(scores, -self.places, axis=0)[-self.places]
        return np.nonzero(able)

    def reachable(self, scores: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Which (document, item) may still get a place; the document now in the last place may."""
        return (scores > self.least) | ((scores == self.least) & (scores > 0) & (doc[:, None] <= self.least_doc))

    def add(self, column: np.ndarray, score: np.ndarray, doc: np.ndarray, uid: np.ndarray) -> None:
        rows = [np.concatenate(pair) for pair in zip(self.rows, (column, score, doc, uid))]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        rows = [r[order] for r in rows]
        begins = np.searchsorted(rows[0], np.arange(len(self.block.items)))
        kept = np.arange(len(order)) - begins[rows[0]] < self.places
        self.rows = [r[kept] for r in rows]
        begins = np.searchsorted(self.rows[0], np.arange(len(self.block.items) + 1))
        full = np.flatnonzero(np.diff(begins) == self.places)
        last = begins[full + 1] - 1
        score, doc = self.rows[1][last], self.rows[2][last]
        better = (score > self.least[full]) | ((score == self.least[full]) & (doc < self.least_doc[full]))
        self.least[full[better]], self.least_doc[full[better]] = score[better], doc[better]

    def found(self) -> pa.RecordBatch:
        column, score, doc, uid = self.rows
        ids = pa.array(doc, mask=doc == _LAST)
        arrays = [pa.array(self.block.items[column]), ids, pa.array(uid), pa.array(score.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, names=["item", "doc_id", "uid", "score"])


_FOUND = "item bigint, doc_id bigint, uid bigint, score bigint"


def _ids(some: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return pc.fill_null(some.column("doc_id"), _LAST).to_numpy(zero_copy_only=False), some.column("uid").to_numpy(zero_copy_only=False)


def _slices(block: Block, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose matrices stay within 32 MB."""
    rows = max(1, (4 << 20) // max(1, len(block.cells), len(block.terms), len(block.items)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def greatest_bounds(index: DataFrame, block: Broadcast, places: int) -> DataFrame:
    """Per task the documents with the greatest bounds of each item; reads no texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(block.value, places)
        for batch in batches:
            for some in _slices(block.value, batch):
                bounds = np.floor(_bounds(block.value, some))
                doc, uid = _ids(some)
                row, column = best.leading(bounds, doc)
                best.add(column, bounds[row, column], doc[row], uid[row])
        yield best.found()

    return index.select("uid", "doc_id", "n_terms", "cells", "tops").mapInArrow(scan, _FOUND)


def rescored(index: DataFrame, block: Broadcast, places: int) -> DataFrame:
    """Per task the best places of each item by true scores, going down the bounds."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block.value
        best = _Best(held, places)
        for batch in batches:
            for some in _slices(held, batch):
                bounds, (doc, uid) = _bounds(held, some), _ids(some)
                texts = some.column("text")
                left = np.flatnonzero(best.reachable(bounds, doc).any(axis=1))
                left = left[np.argsort(-(bounds[left] - best.least).max(axis=1), kind="stable")]
                while left.size:
                    now, left = left[:_STEP], left[_STEP:]
                    scores = _exact(held, texts.take(pa.array(now)))
                    row, column = best.leading(scores, doc[now])
                    best.add(column, scores[row, column], doc[now[row]], uid[now[row]])
                    left = left[best.reachable(bounds[left], doc[left]).any(axis=1)]
        yield best.found()

    return index.select("uid", "doc_id", "n_terms", "cells", "tops", "text").mapInArrow(scan, _FOUND)


def _order() -> list:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("uid")]


def _placed(found: DataFrame, places: int) -> DataFrame:
    return top_per_group(found, ["item"], _order(), places)


def ranked(docs: DataFrame, items: DataFrame, places: int = PLACES, bits: int = CELL_BITS) -> DataFrame:
    """The ``places`` documents of the greatest score of each item: item, item_id, rank, doc_id, score.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are ignored.  Terms are
    runs of digits, letters and non-ASCII characters, A-Z lower-cased.  Equal scores rank by
    ascending doc_id, null last; scores of 0 have no place.  Null and empty texts have no
    terms: such documents are found by no item, and such items find nothing.  Null or repeated ids:
    each row is a document or item of its own.  Empty tables give no rows.

    Items are worked on in blocks of about ``ITEMS`` items and ``TERMS`` terms, each broadcast; the
    documents are read twice per block, texts once.
    """
    spark = docs.sparkSession
    asked = staged(item_terms(items), "items")
    index = staged(sketches(docs, key_filter(asked.select("hash")), bits), "sketches")
    n_docs, n_terms = index.filter("n_terms > 0").agg(F.count("*"), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    known = index.select(F.explode("hits").alias("hash")).groupBy("hash").agg(F.count("*").alias("df"))
    weighed = _in_blocks(staged(asked.join(known, "hash"), "item-weights"))
    numbers = sorted(r["block"] for r in weighed.select("block").distinct().collect())
    found = spark.createDataFrame([], _FOUND)
    for number in numbers:
        rows = weighed.filter(F.col("block") == number).select("item", "hash", "times", "df").collect()
        found = found.union(_of_block(index, _block(rows, n_docs, n_terms, bits), places))
    names = asked.groupBy("item").agg(F.first("item_id").alias("item_id"))
    by_score = Window.partitionBy("item").orderBy(*_order())
    return found.withColumn("rank", F.row_number().over(by_score)).join(names, "item").select("item", "item_id", "rank", "doc_id", "score")


def _in_blocks(weighed: DataFrame) -> DataFrame:
    """Adds ``block``: few enough items and terms for the matrices of one block, an item's terms together."""
    n_items, n_weights = weighed.agg(F.count_distinct("item"), F.count("*")).first()
    blocks = max(1, math.ceil(n_items / ITEMS), math.ceil(n_weights / TERMS))
    sizes = weighed.groupBy("item").agg(F.count("*").alias("n"))
    dealt = F.when(F.col("n") > TERMS, -1 - F.col("item")).otherwise(F.pmod(F.xxhash64("item"), F.lit(blocks)))
    return staged(weighed.join(sizes.select("item", dealt.alias("block")), "item"), "item-blocks")


def _of_block(index: DataFrame, block: Block, places: int) -> DataFrame:
    """The best places of a block's items."""
    context = index.sparkSession.sparkContext
    first = context.broadcast(block)
    highest = staged(_placed(greatest_bounds(index, first, places), places), "bounds").select("uid").distinct()
    sure = _placed(rescored(index.join(small(highest), "uid", "left_semi"), first, places), places)
    order = F.struct(-F.col("score"), F.coalesce("doc_id", F.lit(_LAST)))
    last = sure.groupBy("item").agg(F.count("*").alias("n"), F.max_by(F.struct("score", "doc_id"), order).alias("last"))
    column = {item: i for i, item in enumerate(block.items.tolist())}
    for r in last.filter(F.col("n") == places).collect():  # at most a row per item of the block
        i = column[r["item"]]
        block.least[i] = r["last"]["score"]
        block.least_doc[i] = _LAST if r["last"]["doc_id"] is None else r["last"]["doc_id"]
    return staged(_placed(rescored(index, context.broadcast(block), places), places), "ranked")
