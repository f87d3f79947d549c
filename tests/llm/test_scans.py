import hashlib

import pytest

from cases import PASSAGE, SMALL, no_docs, odd_docs, ordered, pairs, some_docs, words
from postloom.llm.decontaminate import contamination
from postloom.llm.licenses import BASE, license_scan

ITEMS = [(1, PASSAGE), (2, PASSAGE.upper()), (3, "word"), (4, None), (5, ""), (6, "again and AGAIN"), (7, "z " + PASSAGE + " z"), (None, "no id here"), (3, "word"), (8, "unseen words only"), (10, "a b c a b c a b c a b c a"), (11, "x")]


def plain_contamination(docs, items, span=13):
    windows = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - span + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + span]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= ids
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return ordered(out)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_contamination(spark, make):
    docs = make(spark)
    items = [*ITEMS, *((r["item_id"] + 100, r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect())]
    table = spark.createDataFrame([(i, t, "k") for i, t in items], "item_id bigint, text string, kind string")
    got = contamination(docs, table).select(*COLUMNS).collect()
    assert ordered(map(tuple, got)) == plain_contamination(pairs(docs), items)


def test_every_place_of_a_shared_span_is_found(spark):
    base = PASSAGE.split()
    docs = [(i, " ".join([f"l{j}" for j in range(i)] + base[:13] + [f"r{j}" for j in range(20 - i)])) for i in range(20)]
    docs += [(100 + i, " ".join(base[:i] + ["other"] + base[i:])) for i in range(1, 15)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    items = [(1, PASSAGE), (2, "twelve thirteen fourteen"), (3, "")]
    got = contamination(table, spark.createDataFrame(items, "item_id bigint, text string")).select(*COLUMNS).collect()
    assert ordered(map(tuple, got)) == plain_contamination(docs, items)


def test_items_of_every_length(spark):
    base = [f"b{i}" for i in range(20)]
    items = [(n, " ".join(f"i{n}x{j}" for j in range(n))) for n in range(1, 15)] + [(100, " ".join(base)), (101, " ".join(base[5:13]))]
    docs = [(n, f"before {t} after") for n, t in items] + [(200 + n, " ".join(t.split()[:-1])) for n, t in items]
    docs += [(300, " ".join(base[4:14])), (301, " ".join(base[2:12] + ["x"])), (302, " ".join(base[3:16]))]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = contamination(table, spark.createDataFrame(items, "item_id bigint, text string")).select(*COLUMNS).collect()
    assert ordered(map(tuple, got)) == plain_contamination(docs, items)


def test_no_items(spark):
    docs = odd_docs(spark)
    got = contamination(docs, spark.createDataFrame([], "item_id bigint, text string")).select(*COLUMNS).collect()
    assert ordered(map(tuple, got)) == plain_contamination(pairs(docs), [])


@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_license_base(spark, make):
    docs = make(spark)
    want = []
    for doc_id, text in pairs(docs):
        w, places = words(text), []
        for label, phrase in BASE:
            p = phrase.split()
            places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        starts = [i for i, _ in places]
        want.append((doc_id, len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in places}))))
    rows = license_scan(docs)[0].collect()
    assert ordered((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == ordered(want)
    for r in rows:
        assert not r.base_labels or set(r.base_labels.split(",")) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_license_runs_bear_small_changes(spark):
    texts = [
        (1, "Permission is hereby granted, free of charge, to any person obtaining one copy of this software and associated documentation files (the 'Software'), to deal in the Software without restriction."),
        (2, "This program is free software and you can run it."),
        (3, "This work is licensed under the GNU General Public License, version 3 or later. Under the MIT license too."),
    ]
    rows = {r.doc_id: r for r in license_scan(spark.createDataFrame(texts, "doc_id bigint, text string"))[0].collect()}
    assert rows[1].labels == "mit" and rows[1].base_labels == "" and 0.8 <= rows[1].score < 1
    assert rows[2].labels == "" and rows[2].score == 0
    assert rows[3].labels == "gpl-3,mit" and rows[3].base_labels == "mit"
