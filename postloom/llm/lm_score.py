"""Stupid-backoff scores of documents from n-gram counts of the whole corpus.

S(w | context) is the count of context and w over the count of context where that was seen
in another document, else 0.4 times S with a shorter context; a lone word has its share of
all words.  Counts leave the scored document itself out, so no text vouches for itself.

Texts are dealt into blocks of a few megabytes.  To the JVM a block is one compressed value,
and files of blocks have row groups of a few blocks, so that its memory does not depend on how
much a task is given.  A block explodes into its distinct n-grams with their counts, split by
hash into parts; a part joins the requests of all blocks, sums up its share of the count tables
and answers each block in the order asked.  Blocks then look up their words and sum per
document.  A frequent n-gram is one entry per block, however often it occurs, and parts grow
in number, not in size, with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.shared import python_batches, staged
from postloom.llm.words import Words, gram_hashes, mix, owner, pieces, text_bytes, words_of

ORDER = 2
BACKOFF = 0.4
BLOCK_BYTES = 4 << 20
PART_BYTES = 16 << 20  # of text per part of the count tables
_LOW = np.uint64((1 << 48) - 1)
# Fewest tasks that write the blocks, if the documents come in as many.
MIN_FILES = 32
# Parquet looks at the size of pages and row groups after every block, not only after each hundred.
_CHECKS = {f"parquet.{kind}.size.row.check.{end}": "1" for kind in ("page", "block") for end in ("min", "max")}
_ROW_GROUPS = {**_CHECKS, "parquet.block.size": str(4 * BLOCK_BYTES), "parquet.enable.dictionary": "false", "compression": "uncompressed"}


def _blocks(docs: DataFrame) -> DataFrame:
    """block, docs (``_packed``), n_words and n_bytes: runs of rows of about BLOCK_BYTES."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for some in pieces(batch, limit=BLOCK_BYTES):
                texts = some.column("text")
                data, _ = text_bytes(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([_packed(some)], pa.binary()), pa.array([len(words_of(texts).starts)]), pa.array([len(data)])],
                    names=["block", "docs", "n_words", "n_bytes"],
                )
                number += 1

    python_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # Few files: where Hadoop has no native library, each forks children that look as large as their JVM.
    rows = rows.coalesce(max(MIN_FILES, 4 * docs.sparkSession.sparkContext.defaultParallelism))
    return staged(rows.mapInArrow(deal, "block bigint, docs binary, n_words bigint, n_bytes bigint"), "blocks", _ROW_GROUPS)


def _packed(docs: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(docs)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as rows:
        return rows.read_next_batch()


def _grams(w: Words, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n up to ``order``: hashes of all n-grams within one text, and the word each ends at."""
    out = []
    for n in range(1, order + 1):
        place = np.arange(max(0, len(w.hashes) - n + 1))
        place = place[place + n <= w.first[owner(w.first, place) + 1]] if place.size else place
        out.append((gram_hashes(w.hashes, n)[place], place + n - 1))
    return out


def _asked(grams: list[tuple[np.ndarray, np.ndarray]], parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in ascending order, which one each n-gram is, their counts, and where each part begins.

    The part is taken from the high bits, so parts are runs of the order.
    """
    every = np.concatenate([h for h, _ in grams])
    hashes, index, counts = np.unique(every, return_inverse=True, return_counts=True)
    part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return hashes, index, counts, np.searchsorted(part, np.arange(parts + 1))


def _squeezed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _numbers(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=kind)


def _requests(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """block, part, the low 48 bits of the hashes asked for, and their counts in the block."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, docs in zip(batch.column("block").to_pylist(), batch.column("docs")):
                hashes, _, counts, first = _asked(_grams(words_of(_unpacked(docs.as_buffer()).column("text")), order), parts)
                low = (hashes & _LOW).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                asked = np.flatnonzero(np.diff(first))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(asked), block)), pa.array(asked.astype(np.int32)),
                        pa.array([low[first[p] : first[p + 1]].tobytes() for p in asked], pa.binary()),
                        pa.array([_squeezed(counts[first[p] : first[p + 1]].astype("<u8")) for p in asked], pa.binary()),
                    ],
                    names=["block", "part", "hashes", "counts"],
                )

    return blocks.select("block", "docs").mapInArrow(ask, "block bigint, part int, hashes binary, counts binary")


def _answers(requests: DataFrame) -> DataFrame:
    """block, part and the corpus counts of what was asked, in the same order."""

    def count(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        asked = [np.frombuffer(h, dtype=np.uint8).reshape(-1, 6) for h in frame["hashes"]]
        wide = np.zeros((sum(map(len, asked)), 8), dtype=np.uint8)
        wide[:, :6] = np.concatenate(asked)
        _, index = np.unique(wide.reshape(-1).view("<u8"), return_inverse=True)
        counts = np.concatenate([_numbers(c, "<u8") for c in frame["counts"]])
        # Sums stay whole in a float up to 2**53.
        totals = np.bincount(index, weights=counts).astype("<u8")[index]
        bounds = np.cumsum([0, *map(len, asked)])
        answers = [_squeezed(totals[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        return pd.DataFrame({"block": frame["block"], "part": frame["part"], "totals": answers})

    return requests.groupBy("part").applyInPandas(count, "block bigint, part int, totals binary")


def scores_of(texts: pa.Array, totals: np.ndarray, n_words: int, order: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(words, sum of natural logs of S) of each text, given the corpus counts of the block's n-grams."""
    w = words_of(texts)
    grams = _grams(w, order)
    _, index, _, _ = _asked(grams, parts)
    n = len(w.hashes)
    text = owner(w.first, np.arange(n))
    others = np.zeros((order + 1, n))  # counts in other documents of the n-gram that ends at each word
    at = 0
    for size, (hashes, end) in enumerate(grams, 1):
        _, same, own = np.unique(mix(hashes ^ mix(text[end].astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
        others[size][end] = totals[index[at : at + len(end)]] - own[same]
        at += len(end)
    size_of = np.diff(w.first)
    left = np.maximum(1, n_words - size_of)[text]
    score = np.log(np.maximum(1, others[1]) / left)
    for size in range(2, order + 1):
        context = np.concatenate([[0], others[size - 1][:-1]])  # of the words before
        seen = others[size] > 0
        score = np.where(seen, np.log(np.maximum(others[size], 1) / np.maximum(context, 1)), np.log(BACKOFF) + score)
    # A text's first words have shorter contexts: nothing to back off from.
    for size in range(2, order + 1):
        early = np.arange(n) - w.first[text] < size - 1
        score = np.where(early, score - np.log(BACKOFF), score)
    return size_of, np.bincount(text, weights=score, minlength=len(size_of))


def backoff_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Words and score of every document against all others.

    Needs doc_id and text; other columns are ignored.  Null and empty texts have no words:
    log_score 0, mean null.  Null or repeated doc_ids: each row is a document of its own, also
    against its copies.  Columns: doc_id, n_words, log_score, mean_log_score.
    """
    blocks = _blocks(docs)
    size = blocks.agg(F.sum("n_words").alias("words"), F.sum("n_bytes").alias("bytes")).first()
    n_words = size["words"] or 0
    parts = max(1, -(-(size["bytes"] or 0) // PART_BYTES))
    answers = _answers(_requests(blocks, order, parts))

    def score(key: tuple, held: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out = []
        totals = [_numbers(t, "<u8") for t in told.sort_values("part")["totals"]]
        totals = np.concatenate(totals) if totals else np.zeros(0)
        for docs in map(_unpacked, held["docs"]):
            size_of, total = scores_of(docs.column("text"), totals, n_words, order, parts)
            ids = pd.array(docs.column("doc_id").to_pylist(), dtype="Int64")
            out.append(pd.DataFrame({"doc_id": ids, "n_words": size_of, "log_score": total}))
        return pd.concat(out) if out else pd.DataFrame({"doc_id": [], "n_words": [], "log_score": []})

    scored = blocks.select("block", "docs").groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(score, "doc_id bigint, n_words bigint, log_score double")
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
