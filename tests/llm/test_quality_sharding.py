import re
import zlib
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from cases import SMALL, no_docs, odd_docs, ordered, pairs, some_docs
from postloom.llm import quality, sharding

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    w = [x for x in SPACE.split(text) if x]
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else {g for g in set(grams) if sum(x == g for x in grams) > 1}
    hit = {i + j for i, g in enumerate(grams) if g in twice for j in range(5)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit), len(w) < 10 or 100 * len(hit) > 20 * len(w)


@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_counts(spark, make):
    docs = make(spark)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = quality.quality(docs, labels).collect()
    assert ordered((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == ordered((d, *plain_counts(t)) for d, t in pairs(docs))
    assert all(not (r.kept and r.base_failed) for r in rows)


@pytest.mark.parametrize("n", [0, 5, 400, 2000, 9000])
@pytest.mark.parametrize("delta", [0.05, 0.0004])
@pytest.mark.parametrize("risk", [0.02, 0.0033])
def test_most_allowed_is_the_exact_binomial_bound(spark, n, delta, risk):
    got = spark.range(1).select(quality._most_allowed(F.lit(n).cast("bigint"), risk, F.log(F.lit(delta)))).first()[0]
    p, total, best = Fraction(risk), Fraction(0), -1
    for k in range(int(n * risk) + 1):
        total += comb(n, k) * p**k * (1 - p) ** (n - k)
        if total > Fraction(delta):
            break
        best = k
    assert got == best


def most_allowed(n, delta, risk=quality.RISK):
    total, best = 0.0, -1
    for k in range(n + 1):
        total += comb(n, k) * risk**k * (1 - risk) ** (n - k)
        if total > delta:
            break
        best = k
    return best


def plain_cutoff(scores, tests, poor=()):
    """Safe cutoffs, tested one after the other from the loosest: the first that rejects as many poor texts as the last."""
    allowed, safe = most_allowed(len(scores), quality.DELTA / tests), []
    for cutoff in reversed(quality.GRID):
        if sum(s > cutoff for s in scores) > allowed:
            break
        safe.append((cutoff, sum(s > cutoff for s in poor)))
    if not any(p for _, p in safe):
        return safe[-1][0] if safe else None
    return next(c for c, p in safe if p == safe[-1][1])


def measures(spark, rows):
    """(doc_id, stratum, text_hash, symbols, shouts) as measured rows; the other rules are 0."""
    made = spark.createDataFrame(rows, "doc_id bigint, stratum string, text_hash bigint, symbols double, shouts double")
    rules = [F.col(r) if r in ("symbols", "shouts") else F.lit(0.0).alias(r) for r in quality.RULES]
    return made.select("doc_id", "stratum", "text_hash", F.lit(False).alias("base_failed"), F.struct(*rules).alias("rules"))


def test_cutoffs_bound_false_rejection(spark):
    # 6000 good texts, 1 in 3000 with many symbols; poor ones all have them; few labels in two strata.
    rows = [(i, "en", i, 0.9 if i % 3000 == 0 else 0.001 * (i % 20), 0.0) for i in range(6000)] + [(6000 + i, "en", 6000 + i, 0.9, 0.0) for i in range(500)]
    rows += [(7000 + i, "xx" if i % 2 else "yy", 7000 + i, 0.0, 0.0007 * i) for i in range(250)]
    measured = measures(spark, rows)
    labels = spark.createDataFrame([(i, 1 if i < 6000 or i >= 7000 else 0) for i, *_ in rows] + [(None, 1), (1, None)], "doc_id bigint, quality int")
    chosen = {r.stratum: r for r in quality.cutoffs(measured, labels).collect()}
    assert {k: (r.n_good, r.pooled) for k, r in chosen.items()} == {"en": (6000, False), "xx": (250, True), "yy": (250, True)}
    unit = quality.RULES["symbols"]
    assert chosen["en"].cutoff == plain_cutoff([s / unit for i, _, _, s, _ in rows if i < 6000], 2, [0.9 / unit] * 500)
    assert chosen["xx"].cutoff == chosen["yy"].cutoff == plain_cutoff([s / quality.RULES["shouts"] for i, _, _, _, s in rows if i >= 7000], 2)
    judged = measured.filter("stratum = 'en'").withColumn("kept", quality.verdict(F.col("rules"), F.lit(chosen["en"].cutoff)))
    assert judged.filter("kept and doc_id >= 6000").count() == 0
    assert judged.filter("not kept and doc_id < 6000").count() <= 0.02 * 6000


def test_the_loosest_safe_cutoff_that_rejects_as_many_poor_texts(spark):
    rows = [(i, "en", i, 0.0001 * (i % 1000), 0.0) for i in range(3000)] + [(3000 + i, "en", 3000 + i, 0.0, 0.005 * i) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i < 3000)) for i in range(3200)], "doc_id bigint, quality int")
    scores = [max(s, t) / quality.RULES["symbols"] for *_, s, t in rows]
    cutoff = quality.cutoffs(measures(spark, rows), labels).first().cutoff
    assert cutoff == plain_cutoff(scores[:3000], 1, scores[3000:])
    assert cutoff > plain_cutoff(scores[:3000], 1)


def test_the_risk_holds_for_all_rules_together(spark):
    # One rule alone rejects 90 of 6000, another 90 others: each is within the risk, both are not.
    rows = [(i, "en", i, 0.5 if i < 90 else 0.0, 0.5 if 90 <= i < 180 else 0.0) for i in range(6000)]
    measured = measures(spark, rows)
    labels = spark.createDataFrame([(i, 1) for i in range(6000)], "doc_id bigint, quality int")
    cutoff = quality.cutoffs(measured, labels).first().cutoff
    assert cutoff == plain_cutoff([5.0] * 180 + [0.0] * 5820, 1) == 5.0
    assert measured.filter(~quality.verdict(F.col("rules"), F.lit(cutoff))).count() == 0


def test_few_labels_are_pooled_with_all_others_only_if_needed(spark):
    rows = [(i, "en" if i < 400 else "xx", i, 0.0001 * i, 0.0) for i in range(410)]
    labels = spark.createDataFrame([(i, 1) for i in range(410)], "doc_id bigint, quality int")
    chosen = {r.stratum: (r.cutoff, r.n_good, r.pooled) for r in quality.cutoffs(measures(spark, rows), labels).collect()}
    scores = [s / quality.RULES["symbols"] for *_, s, _ in rows]
    assert chosen == {"en": (plain_cutoff(scores[:400], 2), 400, False), "xx": (plain_cutoff(scores, 2), 410, True)}


def test_copies_are_one_label_and_one_poor_label_counts(spark):
    # 5,000 copies of one text are one label: too few for a cutoff.
    rows = [(i, "en", 1, 0.0, 0.0) for i in range(5000)] + [(5000 + i, "en", 2 + i, 0.0, 0.0) for i in range(100)]
    labels = spark.createDataFrame([(i, int(i != 5099)) for i in range(5100)], "doc_id bigint, quality int")
    assert [tuple(r) for r in quality.cutoffs(measures(spark, rows), labels).collect()] == [("en", None, 100, True)]


def test_contradicting_labels_are_not_good(spark):
    measured = quality.measured_rows(spark.createDataFrame([(1, "a " * 5 + "b c d e f g")], "doc_id bigint, text string"))
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id bigint, quality int")
    assert [tuple(r) for r in quality.cutoffs(measured, labels).collect()] == [("?", None, 0, True)]


def test_every_stratum_of_the_given_labels_gets_a_cutoff(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality(docs, labels)
    assert rows.filter("cutoff is null").count() == 0
    judged = rows.filter("not base_failed").join(labels.filter("quality is not null").select("doc_id", "quality"), "doc_id")
    shares = {r.quality: r.gone for r in judged.groupBy("quality").agg(F.avg((~F.col("kept")).cast("int")).alias("gone")).collect()}
    assert shares[1] <= 0.02 and shares[0] >= 0.5


def test_kept_documents_are_those_kept(spark):
    docs, labels = some_docs(spark), spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = quality.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in quality.quality(docs, labels).filter("kept").collect())
    odd = odd_docs(spark)
    assert quality.kept_documents(odd, labels.limit(0)).columns == odd.columns


@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_shards(spark, make):
    docs = make(spark)
    rows = sharding.shuffled_shards(docs).collect()
    want = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in pairs(docs)]
    assert ordered((r.doc_id, r.size, r.text_crc32) for r in rows) == ordered(want)
    slots = {}
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(8))
    counts = [len(slots.get(s, [])) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = sharding.shuffled_shards(docs.repartition(3)).collect()
    assert ordered(map(tuple, again)) == ordered(map(tuple, rows))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 26, 101, 1000, 4097])
def test_permutation(spark, n):
    rows = sharding.permuted(spark.range(n), "id", "place", n, 7).collect()
    assert sorted(r.place for r in rows) == list(range(n))
    if n > 100:
        assert sum(r.place == r.id for r in rows) < 10


def test_walks_end_inside(spark):
    # Every cell outside walks to a place inside that no inner cell takes.
    n = 4097
    a, b = sharding.cells(n)
    placed = [r.p for r in spark.range(a * b).select(sharding._pass(F.col("id"), n, 7).alias("p")).collect()]
    assert sorted(placed) == list(range(a * b))
