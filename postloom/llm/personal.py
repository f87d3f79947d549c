"""Personal data: exact patterns as seeds, and what bootstrapped contexts find beside them.

Seeds are emails, IP addresses, card and phone numbers that match a fixed pattern and its
checks.  Whatever else looks like an identifier of one of these kinds (an address with a
written-out "at", a number without its plus, a card number with a wrong digit) is a
candidate: by itself it means nothing.

The words before and after each seed and candidate, one to three on either side, are lexical
patterns.  Patterns and values form a bipartite graph, which is scored in rounds.  The
confidence of a pattern in a kind is the share of all places of its words, in all texts, that
stand next to a value of that kind, each value weighed by its score (seeds have 1); places
next to a candidate of that shape, known to be neither, count ``OPEN`` against it, all other
places fully.  The score of a value is the chance that its most confident patterns on both
sides are not both wrong.  So a pattern learnt from seeds finds new values, and these
support further patterns.  A pattern needs ``SUPPORT`` different values: a copied text,
however often copied, supports nothing.

Only patterns with that support can ever count, so the graph is cut to them before the first
round, and only their words are counted over the texts.  Words and values are 64-bit hashes.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.shared import key_filter, numbered, python_batches, small, staged
from postloom.llm.words import Words, gram_hashes, in_filter, lists, owner, pieces, words_of

KINDS = ("email", "ip", "card", "phone")
SIZES = (1, 2, 3)  # words of a pattern
SUPPORT = 3  # different values a pattern needs
LEAST = 0.5  # confidence from which a pattern counts
OPEN = 0.5  # what a candidate of unknown kind counts against a pattern
KNOWN = 0.85  # score from which a value counts wherever it stands
ROUNDS = 3

_EMAIL, _IP, _CARD, _PHONE = range(4)
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A part stands whole or not at all, so matching never goes back over it.
_DOMAIN_RE = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP_RE = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD_RE = re.compile(rb"[0-9](?:[ -]?[0-9])+")
_PHONE_RE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGITS = bytes(b for b in range(256) if not 48 <= b <= 57)

# Shapes of candidates.
_LOOSE_LOCAL = frozenset(_LOCAL | set(range(128, 256)))
_AT_RE = re.compile(rb"@| ?[(\[] ?(?:at|AT) ?[)\]] ?")
_LOOSE_DOMAIN_RE = re.compile(rb"[A-Za-z0-9\x80-\xff_-]+(?:(?:\.| ?[(\[] ?(?:dot|DOT) ?[)\]] ?)[A-Za-z0-9\x80-\xff_-]+)*")
_NUMBER_RE = re.compile(rb"\(?[0-9](?:[ ().\-/]{0,2}[0-9])+")
_COLONS_RE = re.compile(rb"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![0-9A-Za-z:])")

_DIGIT_WORD = np.uint64(xxhash.xxh64_intdigest(b"0"))


def _luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = (d - 48) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: bytes) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN_RE.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find(b"@", max(end, at + 1))


def _octet(part: bytes) -> bool:
    part = part.lstrip(b"0")
    return len(part) < 4 and int(part or b"0") <= 255


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, end) in bytes, by kind and place; leftmost and non-overlapping within a kind."""
    out = [(_EMAIL, *span) for span in _emails(text)]
    out += [(_IP, *m.span()) for m in _IP_RE.finditer(text) if all(map(_octet, m[0].split(b".")))]
    for m in _CARD_RE.finditer(text):
        digits = m[0].translate(None, _NO_DIGITS)
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((_CARD, *m.span()))
    for m in _PHONE_RE.finditer(text) if b"+" in text else ():
        if 9 <= len(m[0].translate(None, _NO_DIGITS)) <= 15:
            out.append((_PHONE, *m.span()))
    return out


def _shaped(text: bytes) -> Iterator[tuple[int, int, int]]:
    """(start, end, kinds as bits) of what looks like an identifier."""
    end = 0
    for m in _AT_RE.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOOSE_LOCAL:
            start -= 1
        domain = _LOOSE_DOMAIN_RE.match(text, m.end()) if start < m.start() else None
        if domain:
            end = domain.end()
            yield start, end, 1 << _EMAIL
    if text.count(b":") > 2:
        for m in _COLONS_RE.finditer(text):
            if m[0].strip(b":"):
                yield *m.span(), 1 << _IP
    for m in _NUMBER_RE.finditer(text):
        n = len(m[0].translate(None, _NO_DIGITS))
        kinds = (1 << _CARD) * (12 <= n <= 19) | (1 << _PHONE) * (7 <= n <= 15) | (1 << _IP) * (re.fullmatch(rb"[0-9]+(\.[0-9]+){3}", m[0]) is not None)
        if kinds:
            yield *m.span(), kinds


def candidates(text: bytes, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kinds) of shapes that overlap neither a base span nor each other."""
    starts: list[int] = []  # disjoint stretches, in order
    ends: list[int] = []
    for start, end in sorted((s, e) for _, s, e in base):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    out = []
    for start, end, kinds in _shaped(text):
        at = bisect_left(starts, end)
        if at == 0 or ends[at - 1] <= start:
            out.append((start, end, kinds))
            starts.insert(at, start)
            ends.insert(at, end)
    return sorted(out)


def _value(part: bytes) -> int:
    """One number for the ways to write a value: the digits of numbers, else the lower-cased text."""
    digits = part.translate(None, _NO_DIGITS)
    number = not re.search(rb"[A-Za-z@:\x80-\xff]", part)
    return xxhash.xxh64_intdigest(digits if number else part.lower()) - (1 << 63)


def _context_words(texts: pa.Array) -> Words:
    """Words whose hash is one and the same for all that hold a digit."""
    w = words_of(texts)
    digits = np.concatenate([[0], np.cumsum((w.low >= 48) & (w.low <= 57))])
    w.hashes[digits[w.ends] > digits[w.starts]] = _DIGIT_WORD
    return w


_SPAN = "struct<kind: int, start: int, end: int, kinds: int, value: bigint, left: array<bigint>, right: array<bigint>>"


def found_spans(docs: DataFrame) -> DataFrame:
    """uid, doc_id and per document its base spans and candidates with the patterns they stand in.

    ``kind`` is -1 for candidates, whose possible kinds are the bits of ``kinds``; places are in code points.
    ``left`` and ``right`` hold the hash of the 1, 2 and 3 words before and after, as far as there are so many.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                texts = some.column("text")
                w = _context_words(texts)
                n = some.num_rows
                raw = [(t or "").encode() for t in texts.to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
                points = np.concatenate([[0], np.cumsum((np.frombuffer(b"".join(raw), np.uint8) & 0xC0) != 0x80)])
                grams = {k: gram_hashes(w.hashes, k) for k in SIZES}
                rows, counts = [], np.zeros(n, dtype=np.int64)
                digits = np.concatenate([[0], np.cumsum((w.low >= 48) & (w.low <= 57))])
                some_digit = digits[offsets[1:]] > digits[offsets[:-1]]
                for i in range(n):
                    text = raw[i]
                    if not (some_digit[i] or b"@" in text or b"(" in text or b"[" in text):
                        continue
                    base = base_spans(text)
                    spans = [(k, s, e, 1 << k) for k, s, e in base] + [(-1, s, e, kinds) for s, e, kinds in candidates(text, base)]
                    counts[i] = len(spans)
                    low, high, at = int(w.first[i]), int(w.first[i + 1]), int(offsets[i])
                    for kind, s, e, kinds in spans:
                        before = low + int(np.searchsorted(w.ends[low:high], at + s, side="right"))
                        after = low + int(np.searchsorted(w.starts[low:high], at + e))
                        left = [int(grams[k][before - k].view(np.int64)) for k in SIZES if before - k >= low]
                        right = [int(grams[k][after].view(np.int64)) for k in SIZES if after + k <= high]
                        begin = int(points[at])
                        rows.append((kind, int(points[at + s]) - begin, int(points[at + e]) - begin, kinds, _value(text[s:e]), left, right))
                fields = list(zip(*rows)) or [()] * 7
                types = [pa.int32()] * 4 + [pa.int64()] + [pa.list_(pa.int64())] * 2
                names = ["kind", "start", "end", "kinds", "value", "left", "right"]
                spans = pa.StructArray.from_arrays([pa.array(f, t) for f, t in zip(fields, types)], names=names)
                yield pa.RecordBatch.from_arrays([some.column("uid"), some.column("doc_id"), lists(spans, counts)], names=["uid", "doc_id", "spans"])

    python_batches(docs.sparkSession)
    rows = numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(scan, f"uid bigint, doc_id bigint, spans array<{_SPAN}>")


def _places(docs: DataFrame, asked: Broadcast) -> DataFrame:
    """gram, n: how often the words of the asked patterns stand in the texts; each piece of text sends its counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                w = _context_words(some.column("text"))
                found = []
                for k in SIZES:
                    hashes = gram_hashes(w.hashes, k)
                    place = np.flatnonzero(in_filter(asked.value, hashes))
                    found.append(hashes[place[place + k <= w.first[owner(w.first, place) + 1]]])
                grams, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])

    return docs.select("text").mapInArrow(scan, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


def _stands_in(spans: DataFrame, *columns: str) -> DataFrame:
    """A row per span and pattern: the given columns, ``is_left`` and ``gram``."""
    side = lambda name, left: F.transform(name, lambda g: F.struct(F.lit(left).alias("is_left"), g.alias("gram")))
    return spans.select(*columns, F.explode(F.concat(side("left", True), side("right", False))).alias("p")).select(*columns, "p.*")


_PATTERN = ["is_left", "gram"]


def _pattern_scores(edges: DataFrame, values: DataFrame, contexts: DataFrame) -> DataFrame:
    """is_left, gram, kind, confidence, support of the patterns that count."""
    earned = F.col("n") * F.col("score")
    told = edges.join(values, "value").groupBy(*_PATTERN, "kind").agg(
        F.sum(earned).alias("weight"), F.sum(F.when(F.col("seed"), 0.0).otherwise(earned)).alias("earned"),
        F.count_if(F.col("score") >= LEAST).alias("support"),
    )
    unknown = F.element_at("open", F.col("kind") + 1) - F.col("earned")
    confidence = F.least(F.round(F.col("weight") / (F.col("n") - OPEN * unknown), 6), F.lit(1.0))
    told = told.join(contexts, _PATTERN).withColumn("confidence", confidence)
    return told.filter((F.col("support") >= SUPPORT) & (F.col("confidence") >= LEAST)).select(*_PATTERN, "kind", "confidence", "support")


def _value_scores(edges: DataFrame, patterns: DataFrame, seeds: DataFrame) -> DataFrame:
    """value, kind, score: seeds keep theirs, other values have that of their patterns."""
    held = small(patterns.select(*_PATTERN, "kind", "confidence"))
    told = edges.filter("not seed").join(held, _PATTERN).filter(F.col("kinds").bitwiseAND(_bit("kind")) != 0)
    wrong = lambda side: 1 - F.coalesce(F.max(F.when(side, F.col("confidence"))), F.lit(0.0))
    score = F.round(1 - wrong(F.col("is_left")) * wrong(~F.col("is_left")), 6)
    return told.groupBy("value", "kind").agg(score.alias("score")).unionByName(seeds)


def _bit(kind: str) -> Column:
    return F.element_at(F.array(*[F.lit(1 << k) for k in range(len(KINDS))]), F.col(kind) + 1)


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(documents, patterns).

    Documents: uid, doc_id, base and found (arrays of kind, start, end by kind and place; kinds as
    numbers of ``KINDS``, places in code points, end exclusive).  ``base`` holds what the fixed
    patterns match, ``found`` what contexts add; these overlap no base span.  A candidate is added with
    the kind of its most confident pattern, or as a known value, if it has the shape of that kind.
    Patterns: is_left, gram (hash of the words), kind, confidence, support.

    ``docs`` needs doc_id and text; other columns are ignored.  Null and empty texts hold nothing.
    Null or repeated doc_ids: each row is a document of its own.  An empty table gives no rows.
    """
    found = staged(found_spans(docs), "spans")
    spans = found.select("uid", F.posexplode("spans").alias("at", "s")).select("uid", "at", "s.*")
    seeds = staged(spans.filter("kind >= 0").select("value", "kind", F.lit(1.0).alias("score")).distinct(), "seeds")
    known = seeds.select("value", F.lit(True).alias("seed")).distinct()
    edges = _stands_in(spans, "value", "kinds").groupBy(*_PATTERN, "value").agg(F.count("*").alias("n"), F.bit_or("kinds").alias("kinds"))
    edges = staged(edges.join(known, "value", "left").withColumn("seed", F.coalesce("seed", F.lit(False))), "edges")
    unknown = lambda kind: F.sum(F.when(~F.col("seed") & (F.col("kinds").bitwiseAND(1 << kind) != 0), F.col("n")).otherwise(0))
    contexts = edges.groupBy(*_PATTERN).agg(F.count("*").alias("values"), F.array(*[unknown(k) for k in range(len(KINDS))]).alias("open"))
    contexts = staged(contexts.filter(F.col("values") >= SUPPORT).drop("values"), "contexts")
    edges = staged(edges.join(contexts, _PATTERN, "left_semi"), "supported-edges")
    asked = key_filter(contexts.select(F.col("gram").alias("hash")).distinct())
    contexts = staged(contexts.join(_places(docs, asked), "gram"), "places")
    values = seeds
    for _ in range(max(1, rounds)):
        patterns = staged(_pattern_scores(edges, values, contexts), "patterns")
        values = staged(_value_scores(edges, patterns, seeds), "values")

    open_spans = spans.filter("kind < 0").drop("kind")
    by_context = _stands_in(open_spans, "uid", "at", "kinds").join(small(patterns), _PATTERN).select("uid", "at", "kinds", "kind", "confidence")
    known = small(values.filter(F.col("score") >= KNOWN).select("value", "kind", F.col("score").alias("confidence")))
    by_value = open_spans.join(known, "value").select("uid", "at", "kinds", "kind", "confidence")
    told = by_context.unionByName(by_value).filter(F.col("kinds").bitwiseAND(_bit("kind")) != 0)
    order = F.struct(F.col("confidence"), -F.col("kind"))
    named = told.groupBy("uid", "at").agg(F.max_by("kind", order).alias("kind"))
    # One row per document with anything added, as many numbers as it has spans.
    added = named.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("at", "kind"))).alias("kind_at"))
    place = lambda kind, s: F.struct(kind.alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = F.array_sort(F.transform(F.filter("spans", lambda s: s["kind"] >= 0), lambda s: place(s["kind"], s)))
    numbers = F.transform("spans", lambda s, i: place(F.try_element_at("kind_at", i), s))
    extra = F.array_sort(F.filter(numbers, lambda s: s["kind"].isNotNull()))
    documents = found.join(added, "uid", "left").select(
        "uid", "doc_id", base.alias("base"), F.coalesce(extra, F.array().cast("array<struct<kind: int, start: int, end: int>>")).alias("found")
    )
    return documents, patterns


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end by kind and place, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(F.array_sort(spans), one), ",")
