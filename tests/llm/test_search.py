import math

import numpy as np
import pytest

from cases import SMALL, no_docs, odd_docs, ordered, pairs, some_docs, words
from postloom.llm import search

ITEMS = [(1, "again and AGAIN we say"), (2, None), (3, ""), (4, "!!"), (1, "again and AGAIN we say"), (None, "word one two three"), (6, "nowhere foundatall"), (7, "ünïcödé 日本語 word word"), (8, "de " * 400 + "a b c")]


def plain_ranks(docs, items, places=20):
    texts = [(doc_id, words(t)) for doc_id, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in texts), sum(len(w) for _, w in texts)
    counts = [{t: w.count(t) for t in set(w)} for _, w in texts]
    df = {}
    for c in counts:
        for t in c:
            df[t] = df.get(t, 0) + 1
    out = []
    for item_id, text in items:
        found = []
        asked = words(text)
        for (doc_id, w), c in zip(texts, counts):
            score = 0
            for t in asked:
                if t in c:
                    m = 75 + (25 * len(w) * n_docs) // n_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda f: f[:3])
        out += [(item_id, i + 1, f[3], -f[0]) for i, f in enumerate(found[:places])]
    return ordered(out)


def ranks(docs, items, **given):
    return ordered((r.item_id, r["rank"], r.doc_id, r.score) for r in search.ranked(docs, items, **given).collect())


def table(spark, items):
    return spark.createDataFrame([(i, t, "k") for i, t in items], "item_id bigint, text string, hash string")


@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_ranked(spark, make):
    docs = make(spark)
    items = [*ITEMS, *((r["item_id"] + 100, r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect())]
    assert ranks(docs, table(spark, items)) == plain_ranks(pairs(docs), items)


def test_no_items(spark):
    assert ranks(odd_docs(spark), table(spark, [])) == []


def test_blocks_and_narrow_sketches(spark, monkeypatch):
    """Many blocks, an item of its own block, and nearly all terms in one cell: bounds get loose, results stay."""
    docs = some_docs(spark)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()][:9]
    items.append((50, " ".join(t for _, t in items)))
    want = plain_ranks(pairs(docs), items, 3)
    monkeypatch.setattr(search, "ITEMS", 4)
    monkeypatch.setattr(search, "TERMS", 60)
    assert ranks(docs, table(spark, items), places=3, bits=3) == want


def test_ties_of_many_copies(spark):
    """Thousands of equal texts: the smallest ids have the places."""
    rows = [(i, "alpha beta gamma") for i in range(3000, 0, -1)] + [(5000 + i, f"alpha filler{i}") for i in range(40)] + [(None, "alpha beta gamma")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    items = [(1, "beta gamma"), (2, "alpha filler7")]
    assert ranks(docs, table(spark, items)) == plain_ranks(rows, items)


def test_bounds_never_fall_short():
    rng = np.random.default_rng(5)
    rows = [(int(i), int(h), int(rng.integers(1, 4)), int(rng.integers(1, 50))) for i in range(6) for h in rng.integers(-(2**62), 2**62, 30)]
    block = search._block(rows, 100, 5000, 16)
    hashes, counts = block.terms[::2], rng.integers(1, 9, len(block.terms[::2]))
    n = np.array([300])
    exact = search._impacts(block, np.zeros(len(hashes), int), np.searchsorted(block.terms, hashes), counts, n, len(block.terms)) @ block.term_weights
    cells = (hashes >> np.uint64(64 - 16)).astype(np.int64)
    tops = {c: counts[cells == c].max() for c in cells.tolist()}
    held = np.array(sorted(tops))
    bound = search._impacts(block, np.zeros(len(held), int), np.searchsorted(block.cells, held), np.array([tops[c] for c in held.tolist()]), n, len(block.cells)) @ block.cell_weights
    assert (bound >= exact).all()
