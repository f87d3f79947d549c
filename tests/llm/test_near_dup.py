import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import no_docs, odd_docs, pairs, some_docs, words
from postloom.llm import near_dup
from postloom.llm.words import words_of


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def plain_classes(texts):
    """Components over all pairs of similarity 0.8 or more."""
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def grouping(labels):
    groups = {}
    for i, label in enumerate(labels):
        groups.setdefault(label, set()).add(i)
    return sorted(map(sorted, groups.values()))


def check(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "uid bigint, text string").withColumn("doc_id", F.col("uid") + 1000)
    got = {r.uid: r for r in near_dup.near_duplicates(rows).collect()}
    assert len(got) == len(texts)
    want = grouping(plain_classes(texts))
    assert grouping([got[i].class_id for i in range(len(texts))]) == want
    for group in want:
        assert {got[i].class_size for i in group} == {len(group)}
        assert [got[i].stays for i in group].count(True) == 1
        assert {got[i].class_id for i in group} == {1000 + group[0]}


@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_classes_are_those_of_all_pairs(spark, make):
    check(spark, [t for _, t in pairs(make(spark))])


def test_large_groups_passages_and_near_misses(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage, base = [word() for _ in range(60)], [word() for _ in range(200)]
    texts = []
    for _ in range(80):  # near copies, many closer to the base than to each other
        w = list(base)
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [" ".join(base)] * 30
    texts += [" ".join([word() for _ in range(40)] + passage) for _ in range(80)]  # share a passage only
    for n in range(1, 40):  # from equal to far
        w = [word() for _ in range(120)]
        texts += [" ".join(w), " ".join(w[: 120 - n] + [word() for _ in range(n)])]
    check(spark, texts)


def test_star_of_edited_copies_and_a_template(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    base, frame = [word() for _ in range(200)], [word() for _ in range(160)]
    texts = []
    for _ in range(1000):  # similar to the base, not to each other
        w = list(base)
        for k in range(4):
            w[25 + 45 * k + rng.randrange(20)] = word()
        texts.append(" ".join(w))
    texts.insert(700, " ".join(base))
    texts += [" ".join(frame + [word() for _ in range(60)]) for _ in range(300)]  # one frame, different contents
    check(spark, texts)


def test_signatures_estimate_weighted_similarity():
    elements = np.array([11, 12, 13, 11, 12, 13, 14], dtype=np.uint64)
    weights = np.array([1.0, 2.5, 0.5, 2.0, 2.0, 0.25, 1.0])
    rows = near_dup.dart_signatures(elements, np.array([0, 0, 0, 1, 1, 1, 1]), weights, 3, 20_000)
    assert abs((rows[0] == rows[1]).mean() - (1 + 2 + 0.25) / (2 + 2.5 + 0.5 + 1)) < 0.02
    assert (rows[2] == near_dup._EMPTY).all() and (rows[:2] != near_dup._EMPTY).all()


def test_shingles_count_and_stay_in_their_text():
    hashes, text, times = near_dup.shingles(words_of(pa.array(["a b c d e a b c d e", None, "x y", "", "x y z a b"])))
    assert np.bincount(text, minlength=5).tolist() == [5, 0, 1, 0, 1]
    assert times.sum() == 6 + 1 + 1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150)], "a bigint, b bigint")
    got = {r.node: r.root for r in near_dup.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}


def test_one_of_each_keeps_columns(spark):
    docs = odd_docs(spark)
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns
    stays = near_dup.document_classes(docs).filter("stays").count()
    assert kept.count() == stays < docs.count()
