"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are taken as lower-cased letters with one gap between words; n-grams of 1 to 3
characters are hashed into buckets.  The weight of an n-gram is its share of the text's
n-grams times its inverse document frequency.  Follow-the-regularised-leader learns a weight
vector per language under an elastic net: L1 keeps most weights at zero, L2 the rest small.
A temperature, fitted on sampled documents the weights have not seen, turns scores into
probabilities.

Document frequencies are counted over all training documents.  Weights are learned from at
most SAMPLE documents a language, drawn by a hash of the doc_id.  Features are made on the
executors, so that a long text reaches the driver as counts, at most one per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.llm.shared import python_batches, small, staged
from postloom.llm.words import pieces
from postloom.operators.groups import top_per_group

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
ORDERS = 3
SAMPLE = 400
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 2e-3, 1e-4
SCALE = 20.0  # of the features: shares are small numbers
UNKNOWN = "und"
CERTAIN = 0.5  # least score of a document that the pipeline keeps
_GAP = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point its lower-case letter, or a gap."""
    return np.array([ord(chr(i).lower()[0]) if chr(i).isalpha() else _GAP for i in range(0x110000)], dtype=np.uint32)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    return (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)


def grams(texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Per order the n-grams' buckets and each text's bounds in them; and whether each text has a letter (null: none).

    A gap stands before the first word and after each that does not end the text; no n-gram reaches over a text's end.
    """
    strings = texts.to_pylist()
    lengths = np.fromiter((len(s or "") + 1 for s in strings), dtype=np.int64, count=len(strings))
    raw = "".join("\n" + (s or "") for s in [*strings, ""])
    codes = _letters()[np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    first = np.concatenate([[0], np.cumsum(lengths)])
    letter = codes != _GAP
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[first] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    bounds = before[first]
    seen = np.concatenate([[0], np.cumsum(letter)])
    has = np.diff(seen[first]) > 0
    codes = codes[keep]
    out, value = [], _mixed(codes + np.uint32(0x9E3779B9))
    for order in range(1, ORDERS + 1):
        if order > 1:
            value = _mixed(value[:-1] * np.uint32(0x01000193) ^ codes[order - 1 :])
        # The last order - 1 n-grams of a text would reach into the next one.
        text_end = np.maximum(bounds[1:] - (order - 1), bounds[:-1])
        inside = np.zeros(len(value) + 1, dtype=np.int32)
        np.add.at(inside, bounds[:-1], 1)
        np.add.at(inside, text_end, -1)
        inside = np.cumsum(inside[:-1]) > 0
        count = np.concatenate([[0], np.cumsum(text_end - bounds[:-1])])
        out.append(((value[inside] >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), count))
    return out, has


@dataclass
class Model:
    """weights: bucket x language, with frequencies and temperature already in them."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        orders, has = grams(texts)
        n = len(has)
        if not self.languages or not n:
            return [UNKNOWN] * n, np.zeros(n)
        total, size = np.zeros((n, len(self.languages))), np.zeros(n)
        for buckets, bounds in orders:
            size += np.diff(bounds)
            some = np.flatnonzero(np.diff(bounds) > 0)
            if some.size:
                total[some] += np.add.reduceat(self.weights[buckets], bounds[some], axis=0, dtype=np.float64)
        scores = total / np.maximum(size, 1)[:, None] + self.bias
        chance = np.exp(scores - scores.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        names = [self.languages[i] if h else UNKNOWN for i, h in zip(best.tolist(), has.tolist())]
        return names, np.where(has, chance.max(axis=1), 0.0)


def held_out(doc_id: Column) -> Column:
    """The documents no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts.  At most BUCKETS rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for some in pieces(batch):
                orders, _ = grams(some.column("text"))
                for i in range(some.num_rows):
                    seen = np.zeros(BUCKETS, dtype=bool)
                    for buckets, bounds in orders:
                        seen[buckets[bounds[i] : bounds[i + 1]]] = True
                    found += seen
                n += some.num_rows
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(found[at], n))], names=["bucket", "n"])

    counts = texts.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out, n = np.zeros(BUCKETS), 0
    for row in counts:
        if row["bucket"] < 0:
            n = row["n"]
        else:
            out[row["bucket"]] = row["n"]
    return out, n


def examples(docs: DataFrame, sample: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, buckets, shares) of at most ``sample`` documents a language, in the order of a hash."""
    draw = F.xxhash64("doc_id", F.xxhash64("text"))
    # The least ``sample`` hashes of a language lie, but for a chance below 1e-100, among the 4 * sample
    # expected under this bound: no task sorts more than those.
    # Repeated rows have one draw and count once, so that copies neither narrow the bound nor fill the sample.
    counts = docs.groupBy("lang").agg((4.0 * sample / F.approx_count_distinct(draw)).alias("share"))
    low = (draw.cast("double") + 2.0**63) / 2.0**64
    near = docs.select("lang", draw.alias("draw"), low.alias("low")).join(small(staged(counts, "languages")), "lang").filter(F.col("low") < F.col("share"))
    drawn = top_per_group(near.select("lang", "draw").distinct(), ["lang"], [F.col("draw")], sample)
    chosen = docs.select("lang", "text", draw.alias("draw")).join(F.broadcast(staged(drawn, "sample")), ["lang", "draw"], "left_semi")
    # One row per draw; each task keeps one before the shuffle.
    chosen = chosen.groupBy("lang", "draw").agg(F.first("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                orders, has = grams(some.column("text"))
                at, share = [], []
                for i in range(some.num_rows):
                    values = np.concatenate([b[c[i] : c[i + 1]] for b, c in orders])
                    found, times = np.unique(values, return_counts=True)
                    at.append(found.astype("<i4").tobytes())
                    share.append((times / len(values)).astype("<f4").tobytes())
                rows = pa.RecordBatch.from_arrays([some.column("lang"), some.column("draw"), pa.array(at, pa.binary()), pa.array(share, pa.binary())], names=["lang", "draw", "at", "share"])
                yield rows.filter(pa.array(has))

    found = chosen.select("lang", "draw", "text").mapInArrow(count, "lang string, draw bigint, at binary, share binary").collect()
    found.sort(key=lambda r: (r["draw"], r["lang"]))
    return [(r["lang"], np.frombuffer(r["at"], dtype="<i4"), np.frombuffer(r["share"], dtype="<f4").astype(np.float64)) for r in found]


def follow_the_leader(rows: list[tuple[int, np.ndarray, np.ndarray]], n_languages: int, epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-Proximal; the row after the last bucket is the bias."""
    lead = np.zeros((BUCKETS + 1, n_languages))
    squares = np.zeros_like(lead)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(epochs):
        for label, at, value in rows:
            at, value = np.append(at, BUCKETS), np.append(value, 1.0)
            z, n = lead[at], squares[at]
            w = weights(z, n)
            score = value @ w
            chance = np.exp(score - score.max())
            chance /= chance.sum()
            chance[label] -= 1.0
            slope = value[:, None] * chance
            grown = n + slope * slope
            lead[at] = z + slope - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * w
            squares[at] = grown
    return weights(lead, squares)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The factor on the scores with the best likelihood, from a grid of powers."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        s = scores * t
        s = s - s.max(axis=1, keepdims=True)
        right = s[np.arange(len(labels)), labels]
        total = np.log(np.exp(s).sum(axis=1))
        # No score may claim more than the sample can show: the right answer counts (n + 1) / (n + 2).
        sure = (len(labels) + 1) / (len(labels) + 2)
        rest = (s.sum(axis=1) - right) / max(1, s.shape[1] - 1)
        return float((total - sure * right - (1 - sure) * rest).mean())

    return min((2.0 ** (p / 4) for p in range(-16, 33)), key=lambda t: (loss(t), t))


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of rows (doc_id, text, lang); rows without text, language or doc_id, and held-out ones, are left out.

    Memory follows BUCKETS times the number of languages.  Without rows the model knows none.
    """
    python_batches(docs.sparkSession)
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select("doc_id", "text", "lang")
    seen, n = frequencies(known)
    inverse = np.log((1 + n) / (1 + seen)) + 0.1
    found = examples(known, sample)
    languages = sorted({lang for lang, _, _ in found})
    number = {lang: i for i, lang in enumerate(languages)}
    rows = [(number[lang], at, share * inverse[at] * SCALE) for lang, at, share in found]
    apart = rows[::5]
    weights = follow_the_leader([r for i, r in enumerate(rows) if i % 5 or len(rows) < 5], len(languages))
    if apart and len(languages) > 1:
        scores = np.array([np.append(value, 1.0) @ weights[np.append(at, BUCKETS)] for _, at, value in apart])
        weights = weights * temperature(scores, np.array([r[0] for r in apart]))
    return Model(languages, (weights[:-1] * (inverse * SCALE)[:, None]).astype(np.float32), weights[-1])


def predictions(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a struct column ``language``: lang_pred and score, from the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "lang_pred string, score double"

    @F.arrow_udf(kind)
    def predict(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        names, scores = [], []
        for some in pieces(batch):
            found, score = shared.value.predict(some.column("text"))
            names += found
            scores.append(score)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]))], names=["lang_pred", "score"])

    return docs.withColumn("language", predict(F.col("text")))


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Language of every document, learned from those that are not held out.

    Needs doc_id, text and lang; other columns are ignored.  Null texts and texts without a
    letter are "und" with score 0.  A null doc_id is not held out and not learned from.  Of rows that
    repeat, one is learned from.  An empty table gives no rows.
    Columns: doc_id, held_out, lang_pred, score.
    """
    model = train(docs, sample)
    rows = docs.select(F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return predictions(rows, model).select(F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "language.lang_pred", "language.score")


def identified_documents(docs: DataFrame, sample: int = SAMPLE, certain: float = CERTAIN) -> DataFrame:
    """The documents with a known language at a score of at least ``certain``, with the columns they came with."""
    model = train(docs, sample)
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("rest"), "text")
    kept = predictions(rows, model).filter((F.col("language.lang_pred") != UNKNOWN) & (F.col("language.score") >= certain))
    return kept.select(*[F.col("text") if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns])
