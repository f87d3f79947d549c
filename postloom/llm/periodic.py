"""Periodic runs of words by a descending-LCP Kruskal over suffix classes.

A run of period q and length L is a pair of suffixes q apart whose longest common prefix
(LCP) is L - q.  Suffixes are sorted, neighbours in that order are united by decreasing LCP,
and every class keeps its positions in order.  When two classes meet at LCP l, positions
that become neighbours in the united class and lie at most l apart are the seed of a run:
the stretch from the first of them has their distance as its period.  With at least two
periods in l, no position of the class can lie between two that are the smallest period
apart, so every run is seeded exactly once by its first word and no seed has a longer period
than its stretch.

A run of ``least`` words and ``times`` periods needs an LCP of ``least * (times - 1) / times``
words, so texts without two equal grams of that many words are passed over.  Such grams are
compared by hash; whatever a hash proposes is decided by the words.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions.text import let
from postloom.llm.shared import numbered, python_batches
from postloom.llm.words import gram_hashes, hash_runs, lists, mix, owner, pieces, text_bytes

LEAST = 24  # words of a run at least
TIMES = 3  # periods of a run at least

_INSIDE = np.ones(256, dtype=bool)
_INSIDE[[0x20, *range(0x09, 0x0E)]] = False
_RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs without ASCII white space), and where each text's words begin."""
    data, offsets = text_bytes(texts)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    inside = _INSIDE[data]
    joined = np.zeros(len(data) + 1, dtype=bool)  # a word goes on from place i - 1 to place i
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[offsets] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    ends = np.flatnonzero(inside & ~joined[1:]) + 1
    return hash_runs(padded, starts, ends), np.searchsorted(starts, offsets)


def _repeating(hashes: np.ndarray, first: np.ndarray, gram: int) -> np.ndarray:
    """Numbers of the texts that may hold one gram of words twice."""
    places = np.arange(max(0, len(hashes) - gram + 1))
    text = owner(first, places)
    places = places[places + gram <= first[text + 1]]
    text = owner(first, places)
    keys = mix(gram_hashes(hashes, gram)[places] ^ mix(text.astype(np.uint64)))
    order = np.argsort(keys)
    again = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    return np.unique(text[order[again]])


def _suffix_order(ids: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share their first words with another one, in order, and whether each shares them with the one before.

    How many words: the greatest power of two up to ``reach``.  Doubling; a suffix that is alone in its
    group keeps its rank and is not sorted again.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    values = ids[order]
    begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    sizes = np.diff(np.append(begins, n))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(begins, sizes)
    live = order[np.repeat(sizes, sizes) > 1]
    deep, group, compared = (live, rank[live], 1) if reach < 2 else (None, None, 1)
    while live.size:
        after = live + compared
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        first = rank[live]
        sort = np.lexsort((second, first))
        live, first, second = live[sort], first[sort], second[sort]
        new_old = np.concatenate([[True], first[1:] != first[:-1]])
        new = new_old | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(live))
        rank[live] = first + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(new_old, at, 0))
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(live)))
        live = live[np.repeat(sizes, sizes) > 1]
        compared *= 2
        if deep is None and 2 * compared > reach:
            deep, group = live, rank[live]
    if deep is None:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    sort = np.argsort(rank[deep])
    deep, group = deep[sort], group[sort]
    same = np.zeros(len(deep), dtype=bool)
    same[1:] = group[1:] == group[:-1]
    return deep, same


def _common(ids: list[int], order: list[int], same: list[bool]) -> list[int]:
    """LCP of each suffix with the one before it in ``order`` (0 where ``same`` says there is none)."""
    n, before, lcp = len(ids), {}, {}
    for place, shared, previous in zip(order[1:], same[1:], order):
        if shared:
            before[place] = previous
    h, last = 0, -2
    for i in sorted(before):
        j = before[i]
        h = max(0, h - 1) if i == last + 1 else 0
        while i + h < n and j + h < n and ids[i + h] == ids[j + h]:
            h += 1
        lcp[i], last = h, i
    return [lcp.get(i, 0) for i in order]


def runs_of(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of ids, in order of start and period."""
    reach = -(-least * (times - 1) // times)
    deep, same = _suffix_order(ids, max(1, reach))
    if not deep.size:
        return []
    ids, order = ids.tolist(), deep.tolist()
    lcp = _common(ids, order, same.tolist())
    edges = sorted(((l, i) for i, l in enumerate(lcp) if l >= reach), reverse=True)
    parent = list(range(len(order)))
    held: list[list[int] | None] = [[p] for p in order]

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []

    def seed(i: int, j: int, l: int) -> None:
        q = j - i
        if (times - 1) * q <= l and l + q >= least and (i == 0 or ids[i - 1] != ids[j - 1]):
            out.append((i, l + q, q))

    for l, e in edges:
        a, b = root(e - 1), root(e)
        if len(held[a]) < len(held[b]):
            a, b = b, a
        large, small = held[a], held[b]
        parent[b], held[b] = a, None
        where = [bisect(large, x) for x in small]
        for k, (x, at) in enumerate(zip(small, where)):
            # Neighbours in the united set, one from each side.
            if at and (k == 0 or where[k - 1] < at):
                seed(large[at - 1], x, l)
            if at < len(large) and (k + 1 == len(small) or where[k + 1] > at):
                seed(x, large[at], l)
        if len(small) == 1:
            large.insert(where[0], small[0])
        else:
            large += small
            large.sort()  # two sorted runs
    return sorted(out, key=lambda r: (r[0], r[2]))


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run holds after its first period."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per document all runs of words with a smallest period, and the text with each run cut to its first period.

    A word is a run of characters without ASCII white space.  A run has at least ``least`` words
    and ``times`` periods and is as long as its period lasts.  Columns: uid, doc_id, n_words,
    runs (array of start, length, period by start and period; word numbers), collapsed (kept
    words joined by one space).  ``docs`` needs doc_id and text; other columns are ignored.
    Null and empty texts: no words, no runs, empty text.  Null or repeated doc_ids: each row is a
    document of its own.  An empty table gives no rows.  A text is worked on whole, in memory in
    proportion to its words; nothing is shuffled.
    """
    gram = max(1, -(-least * (times - 1) // times))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                texts = some.column("text")
                hashes, first = _spaced(texts)
                words = [(t or "").encode().split() for t in texts.to_pylist()]
                found: list[list[tuple[int, int, int]]] = [[] for _ in words]
                for text in _repeating(hashes, first, gram).tolist():
                    known: dict[bytes, int] = {}
                    ids = np.array([known.setdefault(w, len(known)) for w in words[text]], dtype=np.int64)
                    found[text] = runs_of(ids, least, times)
                counts = np.array([len(f) for f in found], dtype=np.int64)
                flat = np.array([r for f in found for r in f], dtype=np.int64).reshape(-1, 3)
                runs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"])
                collapsed = [b" ".join(_kept(w, f) if f else w).decode() for w, f in zip(words, found)]
                n_words = pa.array([len(w) for w in words], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column("uid"), some.column("doc_id"), n_words, lists(runs, counts), pa.array(collapsed, pa.string())],
                    names=["uid", "doc_id", "n_words", "runs", "collapsed"],
                )

    python_batches(docs.sparkSession)
    rows = numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(scan, f"uid bigint, doc_id bigint, n_words bigint, runs array<{_RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; then the smallest start, then period (null without runs)."""

    def better(a: Column, b: Column) -> Column:
        return a.isNotNull() & (a["length"] * b["period"] >= b["length"] * a["period"])

    # Runs come by start and period: of equal ones the earlier stays.
    return F.aggregate(runs, F.lit(None).cast(_RUN), lambda best, r: F.when(better(best, r), best).otherwise(r))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document (by crc32 of its id) turns periodic from some word on.

    h is the crc32 of the decimal doc_id and g its tenth.  Where h % 10 = 0, the n words from a = g % n on
    repeat with period 1 + (n - a) div (3 + g % 8).  Documents without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def periodic(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        source = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.concat_ws(" ", source)

    planted = let(words, lambda w: F.when(F.size(w) > 0, periodic(w)).otherwise(F.lit("")))
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))
