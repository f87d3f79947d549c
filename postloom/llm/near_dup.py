"""Near-duplicate classes of texts by DartMinHash.

A text is a weighted set of five-word shingles.  Darts are thrown at each element's region
[0, weight) x [0, rank limit): their ranks are the arrivals of a Poisson process that is seeded
by the element, so all texts throw the same darts at a shared element.  A text keeps the
darts below its own limit (about k ln k + 2k of them, however many elements it has) and,
per coordinate, the earliest; texts without a dart for some coordinate double their limit.
Coordinates of two texts agree with the probability of their weighted Jaccard similarity.

Signatures are cut into bands; texts that share a band meet in a bucket.  Exact copies have
been folded before, and a bucket links every member to one leader only, the same one across
buckets, so a group of n near copies costs n links and not n * n.  Each link is checked on the
shingles themselves.  Buckets whose members are still in several components are linked
again to other leaders, a few times at most.

What these rounds leave is found exactly: texts in buckets that still span several components
are joined on their rarest shingles.  Two sets at the similarity or above share an element of
their prefixes in any order of all elements, here rarest first.  Lengths and places spare pairs
that cannot be similar.  The first round takes for each shingle only the text with the fewest
rarer ones (the origin of edited copies), the next ones more and more texts, the last one all,
so that no pair of different components is left untested.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.shared import held, numbered, python_batches, small, staged, without
from postloom.llm.words import Words, gram_hashes, lists, mix, pieces, words_of

SHINGLE = 5
SIMILAR = 0.8
# A pair at similarity 0.8 shares no band with probability (1 - 0.8 ** 6) ** 40 = 5e-6; one at 0.3 shares one with 3 %.
BANDS, ROWS = 40, 6
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_PHI = np.uint64(0x9E3779B97F4A7C15)
# Bits by which leaders are chosen: the smallest member number after xor.
_MASKS = [0x2C5A7B3F1E9D4860, 0x6A09E667F3BCC908, 0x3C6EF372FE94F82B, 0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179]

_CELL_BITS = 22
# Texts tested against all others of a rare shingle: first the one with the fewest rarer ones, then one of so many, last all.
_TAKEN = [None, 64, 8, 1]


def shingles(w: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted within it: (hashes, text of each, times found).

    A text of fewer words than ``size``, but not none, is one shingle.
    """
    counts = np.diff(w.first)
    place = np.arange(max(0, len(w.hashes) - size + 1))
    text = np.searchsorted(w.first, place, side="right") - 1
    inside = place + size <= w.first[text + 1]
    hashes, text = gram_hashes(w.hashes, size)[inside], text[inside]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if short.size:
            hashes = np.concatenate([hashes, gram_hashes(w.hashes, n)[w.first[short]]])
            text = np.concatenate([text, short])
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return hashes[first], text[first], np.diff(np.append(first, len(hashes)))


def dart_signatures(elements: np.ndarray, text: np.ndarray, weights: np.ndarray, n_texts: int, k: int) -> np.ndarray:
    """One row of k numbers per text: the earliest dart of each coordinate; texts without elements keep all ones.

    A weight is cut into layers of height one; a dart in the top layer counts if it lies below
    the weight.
    """
    layers = np.ceil(weights).astype(np.int64)
    each = np.repeat(np.arange(len(elements)), layers)
    layer = np.arange(len(each)) - np.repeat(np.cumsum(layers) - layers, layers)
    seeds = mix(elements[each] ^ mix(layer.astype(np.uint64) * _PHI + np.uint64(1)))
    height = np.minimum(1.0, weights[each] - layer)
    owner = text[each]
    total = np.bincount(text, weights=weights, minlength=n_texts)
    out = np.full((n_texts, k), _EMPTY, dtype=np.uint64)
    limit = (k * math.log(k) + 2 * k) / np.maximum(total, 1e-9)
    todo = total > 0
    while todo.any():
        chosen = np.flatnonzero(todo[owner])
        seed, top, of = seeds[chosen], height[chosen], owner[chosen]
        rank, throw = np.zeros(len(chosen)), 0
        while len(seed):
            throw += 1
            dart = mix(seed + np.uint64(throw * int(_PHI) & int(_EMPTY)))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53)
            near = rank <= limit[of]
            seed, top, of, rank, dart = seed[near], top[near], of[near], rank[near], dart[near]
            name = mix(dart ^ _PHI)
            # Weight position from other bits; the top layer may be cut.
            hit = ((mix(name) >> np.uint64(11)).astype(np.float64) * 2.0**-53) < top
            packed = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (name >> np.uint64(32))
            np.minimum.at(out.reshape(-1), (of * k + (name % np.uint64(k)).astype(np.int64))[hit], packed[hit])
        todo = todo & (out == _EMPTY).any(axis=1)
        limit = np.where(todo, limit * 2, limit)
    return out


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _PHI, parts.shape[:2])
    for r in range(rows):
        key = mix((key ^ parts[:, :, r]) * _PHI + np.uint64(r + 1))
    return key


_SCANNED = "uid bigint, doc_id bigint, n_words bigint, key_a bigint, key_b bigint, n_shingles int, bands array<bigint>, shingles binary"


def signed(rows: DataFrame, bands: int = BANDS, band_rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """Of rows (uid, doc_id, text): a key of all words (null without words), band keys, and the shingles.

    ``weighted`` takes how often a shingle occurs as its weight, else 1.  Shingles are kept as
    sorted 32-bit numbers; in texts of 100,000 words about one in 100,000 falls together
    with another.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in pieces(batch):
                w = words_of(some.column("text"))
                n = len(w.first) - 1
                hashes, text, times = shingles(w)
                weights = times.astype(np.float64) if weighted else np.ones(len(hashes))
                signatures = dart_signatures(hashes, text, weights, n, bands * band_rows)
                counts = np.bincount(text, minlength=n)
                has = counts > 0
                keys = band_keys(signatures[has], bands, band_rows)
                # 32 high bits keep the order, so the numbers stay sorted.
                short = (hashes >> np.uint64(32)).astype("<u4").tobytes()
                bounds = np.concatenate([[0], np.cumsum(counts)]) * 4
                digest = [xxhash.xxh3_128_digest(w.hashes[a:b].tobytes()) if b > a else b"\0" * 16 for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist())]
                key = np.frombuffer(b"".join(digest), dtype="<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("uid"), some.column("doc_id"), pa.array(np.diff(w.first).astype(np.int64)),
                        pa.array(key[:, 0].copy(), mask=~has), pa.array(key[:, 1].copy(), mask=~has), pa.array(counts.astype(np.int32)),
                        lists(pa.array(keys.reshape(-1).view(np.int64)), np.where(has, bands, 0)),
                        pa.array([short[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary()),
                    ],
                    names=["uid", "doc_id", "n_words", "key_a", "key_b", "n_shingles", "bands", "shingles"],
                )

    python_batches(rows.sparkSession)
    return rows.mapInArrow(scan, _SCANNED)


def similar_pairs(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) whose shingles have a Jaccard similarity of at least ``similar``; ``sets``: uid, n_shingles, shingles."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, dtype="<u4"), np.frombuffer(y, dtype="<u4")
                both = np.sort(np.concatenate([np.unique(x), np.unique(y)]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(common >= similar * (len(x) + len(y) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Of the texts only those that stand in a pair travel.
    asked = pairs.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    sets = sets.join(small(staged(asked, "asked")), "uid", "left_semi")
    one = sets.select(F.col("uid").alias("a"), F.col("n_shingles").alias("n_a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("uid").alias("b"), F.col("n_shingles").alias("n_b"), F.col("shingles").alias("y"))
    both = pairs.join(one, "a").join(two, "b")
    both = both.filter((F.least("n_a", "n_b") >= similar * F.greatest("n_a", "n_b") - 1e-9))
    python_batches(pairs.sparkSession)
    return both.select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of links (a, b).

    Labels go to neighbours and then jump to the label of the label; each pass is staged.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = staged(both, "links")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "labels")
    while True:
        heard = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("heard"))
        best = labels.join(heard, F.col("node") == F.col("a")).select("node", F.col("root").alias("old"), F.least("root", "heard").alias("near"))
        up = labels.select(F.col("node").alias("near"), F.col("root").alias("far"))
        jumped = best.join(up, "near", "left").select("node", F.least("near", F.coalesce("far", "near")).alias("root"), "old")
        jumped = staged(jumped, "labels")
        labels = jumped.select("node", "root")
        if not jumped.filter("root <> old").limit(1).count():
            return labels


def _led(crowded: DataFrame, mask: int) -> DataFrame:
    """uid and the leader of its bucket, where they differ."""
    lead = crowded.groupBy("key").agg(F.min(F.col("uid").bitwiseXOR(F.lit(mask))).alias("lead"))
    return crowded.join(lead, "key").select("uid", F.col("lead").bitwiseXOR(F.lit(mask)).alias("leader")).filter("uid <> leader")


def _pairs(led: DataFrame) -> DataFrame:
    return led.select(F.least("uid", "leader").alias("a"), F.greatest("uid", "leader").alias("b")).distinct()


def _cells(sets: DataFrame) -> Broadcast:
    """How often shingles occur, by their first _CELL_BITS bits; 16 bits each, so bounded whatever the number of texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _CELL_BITS, dtype=np.int64)
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), dtype="<u4")
            total += np.bincount(x >> np.uint32(32 - _CELL_BITS), minlength=len(total))
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total[cell])], names=["cell", "n"])

    python_batches(sets.sparkSession)
    counts = sets.select("shingles").mapInArrow(scan, "cell int, n bigint").groupBy("cell").agg(F.least(F.sum("n"), F.lit(65535)).cast("int").alias("n"))
    found = counts.filter("n > 1").toArrow()
    cells = np.ones(1 << _CELL_BITS, dtype="<u2")
    cells[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return sets.sparkSession.sparkContext.broadcast(cells.tobytes())


def prefixes(sets: DataFrame, similar: float) -> DataFrame:
    """The rarest shingles of each set, as many as one at ``similar`` cannot miss all: key, uid, place in the order, size of the set.

    The order is the same for all sets: by the count of the cell, then by number.  Shingles
    that occur once are left out but keep their places.
    """
    cells = _cells(sets)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.frombuffer(cells.value, dtype="<u2")
        for batch in batches:
            keys, places, kept, sizes = [np.zeros(0, dtype=np.uint32)], [np.zeros(0, dtype=np.int64)], [], []
            for x in batch.column("shingles").to_pylist():
                x = np.unique(np.frombuffer(x, dtype="<u4"))
                of = count[x >> np.uint32(32 - _CELL_BITS)]
                first = np.lexsort((x, of))[: len(x) - math.ceil(similar * len(x) - 1e-9) + 1]
                place = np.flatnonzero(of[first] > 1)
                keys.append(x[first[place]])
                places.append(place)
                kept.append(len(place))
                sizes.append(len(x))
            uids = batch.column("uid").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(keys).astype(np.int64)), pa.array(np.repeat(uids, kept)),
                    pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.repeat(np.array(sizes, dtype=np.int32), kept)),
                ],
                names=["key", "uid", "place", "n"],
            )

    python_batches(sets.sparkSession)
    return sets.select("uid", "shingles").mapInArrow(scan, "key bigint, uid bigint, place int, n int")


def _rooted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (key, uid, ...) with their roots, of keys that span several components."""
    named = rows.join(labels, F.col("uid") == F.col("node"), "left").select(*rows.columns, F.coalesce("root", "uid").alias("root"))
    named = staged(named, "named")
    split = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("key")
    return named.join(split, "key", "left_semi")


def _rest(crowded: DataFrame, sets: DataFrame, similar: float, tested: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
    """``labels`` after all pairs of different components that share a bucket have been tested or cannot be similar."""
    asked = staged(_rooted(crowded, labels).select("uid").distinct(), "open")
    if not asked.limit(1).count():
        return labels
    keyed = prefixes(sets.join(small(asked), "uid", "left_semi"), similar)
    keyed = staged(keyed, "prefixes")
    shared = keyed.groupBy("key").agg(F.count("*").alias("k")).filter("k > 1").select("key")
    keyed = staged(keyed.join(shared, "key", "left_semi"), "prefixes")
    for one_of in _TAKEN:
        rows = staged(_rooted(keyed, labels), "open")
        if one_of is None:
            heads = rows.groupBy("key").agg(F.min(F.struct("place", "uid", "n", "root")).alias("h")).select("key", "h.*")
        else:
            heads = rows.filter(F.pmod(F.xxhash64("uid"), F.lit(one_of)) == 0)
        heads = heads.select(F.col("key").alias("h_key"), F.col("uid").alias("leader"), F.col("place").alias("h_place"), F.col("n").alias("h_n"), F.col("root").alias("other"))
        enough = F.least("n", "h_n") >= similar * F.greatest("n", "h_n") - 1e-9
        # Of the first element that both have on, so many can be equal.
        enough &= F.least(F.col("n") - F.col("place"), F.col("h_n") - F.col("h_place")) >= similar / (1 + similar) * (F.col("n") + F.col("h_n")) - 1e-9
        met = (F.col("key") == F.col("h_key")) & (F.col("root") != F.col("other")) & enough
        if one_of == 1:
            met &= F.col("uid") < F.col("leader")
        fresh = staged(_pairs(rows.join(heads, met)).join(tested, ["a", "b"], "left_anti"), "pairs")
        found = staged(similar_pairs(fresh, sets, similar), "similar")
        tested = tested.union(fresh)
        if found.limit(1).count():
            links = links.union(found)
            labels = components(links)
    return labels


def near_duplicates(rows: DataFrame, similar: float = SIMILAR, bands: int = BANDS, band_rows: int = ROWS, weighted: bool = False) -> DataFrame:
    """The class of every row of (uid, doc_id, text); uids are distinct.

    Texts of equal words are one; different texts are linked at a Jaccard similarity of their
    five-word shingles of ``similar`` or more, and linked texts share a class.  Texts without
    words (null, empty, marks only) are each alone.  Columns: uid, doc_id, class_id (the
    smallest doc_id of the class; null if it has none), class_size, stays (one row of each
    class: the smallest uid).
    """
    scanned = staged(signed(rows, bands, band_rows, weighted), "signed")
    keyed = scanned.filter(F.col("key_a").isNotNull())
    first = staged(keyed.groupBy("key_a", "key_b").agg(F.min("uid").alias("rep")), "copies")
    reps = first.select(F.col("rep").alias("uid"))
    banded = keyed.join(reps, "uid", "left_semi")
    in_bands = banded.select("uid", F.explode("bands").alias("key"))
    shared = in_bands.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    crowded = staged(in_bands.join(shared, "key", "left_semi"), "buckets")
    sets = scanned.select("uid", "n_shingles", "shingles")

    tested = staged(_pairs(_led(crowded, _MASKS[0])), "pairs")
    links = staged(similar_pairs(tested, sets, similar), "similar")
    labels = components(links)
    for mask in _MASKS[1:]:
        open_rows = _rooted(crowded, labels)
        roots = open_rows.select("uid", "root").distinct()
        led = _led(open_rows.select("key", "uid"), mask)
        led = led.join(roots, "uid").join(roots.select(F.col("uid").alias("leader"), F.col("root").alias("other")), "leader").filter("root <> other")
        fresh = staged(_pairs(led).join(tested, ["a", "b"], "left_anti"), "pairs")
        found = staged(similar_pairs(fresh, sets, similar), "similar")
        if not found.limit(1).count():
            tested = tested.union(fresh)
            break
        tested, links = tested.union(fresh), links.union(found)
        labels = components(links)
    labels = _rest(crowded, sets, similar, tested, links, labels)

    of_rep = first.join(labels, F.col("rep") == F.col("node"), "left").select("key_a", "key_b", F.coalesce("root", "rep").alias("root"))
    narrow = scanned.select("uid", "doc_id", "key_a", "key_b")
    rooted = narrow.join(staged(of_rep, "roots"), ["key_a", "key_b"], "left").select("uid", "doc_id", F.coalesce("root", "uid").alias("root"))
    rooted = staged(rooted, "rooted")
    of_class = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min("uid").alias("stay"))
    of_class = staged(of_class, "classes")
    return rooted.join(of_class, "root").select("uid", "doc_id", "class_id", "class_size", (F.col("uid") == F.col("stay")).alias("stays"))


def document_classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """``near_duplicates`` of documents.  Needs doc_id and text; other columns are ignored.

    Null or repeated doc_ids: each row is a document of its own.  An empty table: no rows.
    """
    return near_duplicates(numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text"), similar)


def one_of_each(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One document of each class, with the columns it came with."""
    rows = held(docs)
    gone = near_duplicates(rows.select("uid", "doc_id", "text"), similar).filter(~F.col("stays"))
    return without(rows, gone, docs.columns)
