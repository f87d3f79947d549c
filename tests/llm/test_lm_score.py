from collections import Counter
from math import log

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cases import no_docs, odd_docs, pairs, some_docs, words
from postloom.llm import lm_score


def plain_scores(docs, order):
    texts = [words(t) for _, t in docs]
    grams = lambda w: Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    own = [grams(w) for w in texts]
    every = Counter()
    for c in own:
        every.update(c)
    n_all = sum(map(len, texts))
    out = []
    for (doc_id, _), w, mine in zip(docs, texts, own):
        other = lambda g: every[g] - mine[g]  # noqa: E731, B023

        def s(g):
            if len(g) == 1:
                return log(max(1, other(g)) / max(1, n_all - len(w)))  # noqa: B023
            if other(g) > 0:
                return log(other(g) / max(1, other(g[:-1])))
            return log(0.4) + s(g[1:])

        out.append((doc_id, len(w), sum(s(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w)))))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_scores(spark, monkeypatch, make, order):
    monkeypatch.setattr(lm_score, "PART_BYTES", 100_000)
    docs = make(spark).repartition(3)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    got = sorted(((r.doc_id, r.n_words, r.log_score) for r in lm_score.backoff_scores(docs, order).collect()), key=key)
    want = sorted(plain_scores(pairs(docs), order), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_blocks_are_compressed_values_in_small_row_groups(spark):
    """What reads or writes blocks holds a few of them, however many a task is given."""
    text = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f" {i}")), 512) for i in range(120)])
    docs = spark.range(0, 3200, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    blocks = lm_score._blocks(docs)
    [path] = blocks.inputFiles()
    found = pq.ParquetFile(path.removeprefix("file://")).metadata
    groups = [found.row_group(i) for i in range(found.num_row_groups)]
    assert sum(g.num_rows for g in groups) == blocks.count() >= 12 and len(groups) > 1
    assert max(g.total_byte_size for g in groups) < 24 << 20
    assert dict(blocks.dtypes)["docs"] == "binary" and blocks.agg(F.sum("n_bytes")).first()[0] == 3200 * 120 * 128
    back = [lm_score._unpacked(bytes(r.docs)) for r in blocks.collect()]
    assert sorted(i for b in back for i in b.column("doc_id").to_pylist()) == list(range(3200))


def test_blocks_are_few_files(spark):
    docs = spark.range(0, 400, 1, 150).select(F.col("id").alias("doc_id"), F.lit("a few words").alias("text"))
    blocks = lm_score._blocks(docs)
    assert len(blocks.inputFiles()) <= max(lm_score.MIN_FILES, 4 * spark.sparkContext.defaultParallelism) < 150
    assert blocks.agg(F.sum("n_words")).first()[0] == 1200
