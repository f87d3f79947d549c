"""Benchmark decontamination by winnowed fingerprints.

Of every window of consecutive k-gram hashes the smallest (the rightmost on ties) is kept,
in items and documents alike.  With windows of ``span - k + 1`` grams, any ``span`` equal words
on both sides hold a fingerprint at the same place, so none is missed.  Equal fingerprints
are joined, each hit is extended word by word as far as a span through it can reach, and
only spans of equal words count: hashes propose, words decide.

An item of fewer words than ``span`` is one window; its single fingerprint is the hash of all
its words, looked up among all document grams of that length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postloom.llm.shared import held, key_filter, numbered, python_batches, small, staged, without
from postloom.llm.words import Words, gram_hashes, in_filter, lists, owner, pieces, words_of

SPAN = 13
GRAM = 8
_HIT = "hits array<struct<hash: bigint, size: int, whole: boolean, place: int, lead: int, context: string>>"


def winnowed(w: Words, gram: int, span: int) -> np.ndarray:
    """Word places of the fingerprints: minima of all windows that lie within one text."""
    grams = gram_hashes(w.hashes, gram)
    width = span - gram + 1
    if len(grams) < width:
        return np.zeros(0, dtype=np.int64)
    starts = np.arange(len(grams) - width + 1)
    starts = starts[starts + span <= w.first[owner(w.first, starts) + 1]]
    windows = np.lib.stride_tricks.sliding_window_view(grams, width)[:, ::-1]
    return np.unique(starts + width - 1 - np.argmin(windows[starts], axis=1))


def _hits(w: Words, gram: int, span: int, short: list[int], only: bytes | None) -> pa.Array:
    """Fingerprints of each text: hash, words, if a whole item or winnowed, place in the text, and the words around."""
    found = [(winnowed(w, gram, span), gram, False)]
    for size in short:
        places = np.arange(max(0, len(w.hashes) - size + 1))
        found.append((places[places + size <= w.first[owner(w.first, places) + 1]], size, True))
    place, size, whole, hashes = [], [], [], []
    for places, n, is_whole in found:
        values = gram_hashes(w.hashes, n)[places] if places.size else np.zeros(0, np.uint64)
        if only is not None:
            kept = in_filter(only, values)
            places, values = places[kept], values[kept]
        place.append(places)
        size.append(np.full(len(places), n, dtype=np.int32))
        whole.append(np.full(len(places), is_whole))
        hashes.append(values)
    place, size, whole, hashes = np.concatenate(place), np.concatenate(size), np.concatenate(whole), np.concatenate(hashes)
    order = np.argsort(place, kind="stable")
    place, size, whole, hashes = place[order], size[order], whole[order], hashes[order]
    text = owner(w.first, place)
    reach = np.where(whole, 0, span - gram)  # a span through the gram goes no further
    low = np.maximum(w.first[text], place - reach)
    high = np.minimum(w.first[text + 1], place + size + reach)
    context = [w.joined(a, b) for a, b in zip(low.tolist(), high.tolist())]
    rows = pa.StructArray.from_arrays(
        [pa.array(hashes.view(np.int64)), pa.array(size), pa.array(whole), pa.array((place - w.first[text]).astype(np.int32)), pa.array((place - low).astype(np.int32)), pa.array(context, pa.string())],
        names=["hash", "size", "whole", "place", "lead", "context"],
    )
    return lists(rows, np.bincount(text, minlength=len(w.first) - 1))


def fingerprinted(texts: DataFrame, gram: int, span: int, short: list[int], only: Broadcast | None) -> DataFrame:
    """uid, id, n_words and fingerprints of rows (uid, id, text); with ``only``, those that the filter may hold."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                w = words_of(some.column("text"))
                hits = _hits(w, gram, span, short, only.value if only else None)
                counts = pa.array(np.diff(w.first).astype(np.int64))
                yield pa.RecordBatch.from_arrays([some.column("uid"), some.column("id"), counts, hits], names=["uid", "id", "n_words", "hits"])

    python_batches(texts.sparkSession)
    return texts.mapInArrow(scan, f"uid bigint, id bigint, n_words bigint, {_HIT}")


def _normalised(items: DataFrame) -> DataFrame:
    """uid, item_id and the words of each item that has any, joined by spaces."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = words_of(batch.column("text"))
            text = [w.joined(a, b) for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist())]
            counts = pa.array(np.diff(w.first).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("item_id"), counts, pa.array(text, pa.string())], names=["uid", "item_id", "n_words", "text"])

    rows = numbered(items, F.col("item_id").cast("bigint").alias("item_id"), "text")
    return rows.mapInArrow(scan, "uid bigint, item_id bigint, n_words bigint, text string").filter("n_words > 0")


def _equal_spans(pairs: DataFrame, span: int) -> DataFrame:
    """Each candidate extended over equal words; spans that reach ``span`` words (or a whole short item)."""

    def extend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for uid, kind, place, size, whole, lead, context, i_lead, i_context in zip(f["uid"], f["kind"], f["place"], f["size"], f["whole"], f["lead"], f["context"], f["i_lead"], f["i_context"]):
                d, i = context.split(" "), i_context.split(" ")
                if d[lead : lead + size] != i[i_lead : i_lead + size]:
                    continue
                left = 0
                while left < min(lead, i_lead) and d[lead - left - 1] == i[i_lead - left - 1]:
                    left += 1
                right = size
                while lead + right < len(d) and i_lead + right < len(i) and d[lead + right] == i[i_lead + right]:
                    right += 1
                if left + right >= (size if whole else span):
                    out.append((uid, kind, place - left, place + right))
            yield pd.DataFrame(out, columns=["uid", "kind", "start", "end"])

    return pairs.mapInPandas(extend, "uid bigint, kind bigint, start bigint, end bigint").distinct()


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``contaminated_rows`` of documents.  Needs doc_id and text; other columns are ignored.

    Null or repeated doc_ids: each row is a document of its own.
    """
    return contaminated_rows(numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text"), items, span, gram)


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns they came with."""
    rows = held(docs)
    return without(rows, contaminated_rows(rows, items).filter("contaminated"), docs.columns)


def contaminated_rows(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per row (uid, doc_id, text) the words inside any benchmark window, and the items whose windows occur.

    ``items`` needs item_id and text; other columns are ignored.  Null and empty texts have no
    words: n_words 0, nothing hit; items without words match nothing.  Repeated item_ids count
    once, an item without an id hits words but is not counted.  Empty tables: no rows, or no
    hits.  Columns: uid, doc_id, n_words, n_hit, n_items, items_sha256, contaminated.
    """
    short_gram = min(gram, span)
    named = staged(_normalised(items), "items")
    kinds = named.groupBy("text").agg(F.min("uid").alias("kind"), F.min("n_words").alias("n_words"))
    # At most span - 1 lengths.
    short = sorted(r["n_words"] for r in named.filter(F.col("n_words") < span).select("n_words").distinct().collect())
    texts = kinds.select("kind", "n_words", "text")
    long_items = fingerprinted(texts.filter(F.col("n_words") >= span).select(F.col("kind").alias("uid"), F.col("kind").alias("id"), "text"), short_gram, span, [], None)
    prints = long_items.select(F.col("uid").alias("kind"), F.explode("hits").alias("h"))
    for size in short:
        rows = texts.filter(F.col("n_words") == size).select(F.col("kind").alias("uid"), F.col("kind").alias("id"), "text")
        whole = fingerprinted(rows, short_gram, span, [size], None)
        prints = prints.union(whole.select(F.col("uid").alias("kind"), F.explode("hits").alias("h")))
    prints = staged(
        prints.select("kind", "h.hash", F.col("h.size").alias("i_size"), F.col("h.whole").alias("i_whole"), F.col("h.lead").alias("i_lead"), F.col("h.context").alias("i_context")).distinct(),
        "item-prints",
    )
    only = key_filter(prints.select("hash"))
    rows = docs.select("uid", F.col("doc_id").alias("id"), "text")
    scanned = staged(fingerprinted(rows, short_gram, span, short, only), "doc-prints")
    hits = scanned.select("uid", F.explode("hits").alias("h")).select("uid", "h.*")
    pairs = hits.join(small(prints, 20_000), "hash").filter((F.col("size") == F.col("i_size")) & (F.col("whole") == F.col("i_whole")))
    spans = staged(_equal_spans(pairs, span), "spans")

    in_order = Window.partitionBy("uid").orderBy("start", "end")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(reached, F.lit(0))))
    covered = spans.select("uid", "start", "end").distinct().withColumn("new", new).groupBy("uid").agg(F.sum("new").alias("n_hit"))
    members = named.join(kinds.select("text", "kind"), "text").select("kind", F.col("item_id").cast("string").alias("item"))
    matched = (
        spans.select("uid", "kind").distinct().join(members, "kind").groupBy("uid")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    n_hit, listed = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return (
        scanned.select("uid", F.col("id").alias("doc_id"), "n_words")
        .join(covered, "uid", "left")
        .join(matched, "uid", "left")
        .select(
            "uid", "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("bigint").alias("n_items"),
            F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
            ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )
