import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cases import no_docs, odd_docs, ordered, pairs, some_docs
from postloom.llm.periodic import periodic_runs, runs_of
from postloom.llm.queries import QUERIES


def plain_runs(x, least=24, times=3):
    """Every period in turn: the maximal stretches that have it, without those that have a shorter one."""
    out = []
    for q in range(1, len(x) // times + 1):
        same = [x[i] == x[i + q] for i in range(len(x) - q)] + [False]
        begin = None
        for i, s in enumerate(same):
            if s and begin is None:
                begin = i
            elif not s and begin is not None:
                length = i - begin + q
                shorter = lambda d: all(x[k] == x[k + d] for k in range(begin, begin + length - d))  # noqa: B023, E731
                if length >= max(least, times * q) and not any(shorter(d) for d in range(1, q)):
                    out.append((begin, length, q))
                begin = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_sequences():
    rng = random.Random(7)
    for _ in range(600):
        n, letters = rng.randint(0, 70), rng.choice([1, 2, 3])
        x = [rng.randrange(letters) for _ in range(n)]
        p, s = rng.randint(1, 9), rng.randrange(n + 1)
        for i in range(s + p, min(n, s + rng.randint(0, 50))):
            x[i] = x[i - p]
        for least, times in ((24, 3), (6, 3), (4, 2), (10, 4)):
            assert runs_of(np.array(x, dtype=np.int64), least, times) == plain_runs(x, least, times)


def test_long_runs():
    assert runs_of(np.zeros(30_000, np.int64)) == [(0, 30_000, 1)]
    assert runs_of(np.tile(np.arange(37), 900)) == [(0, 33_300, 37)]
    assert runs_of(np.concatenate([np.arange(100), np.tile(np.arange(200, 205), 4), np.arange(50)])) == []


@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_periodic_runs(spark, make):
    docs = make(spark)
    want = []
    for doc_id, text in pairs(docs):
        words = plain_words(text)
        runs = plain_runs(words) if len(words) < 3000 or make is odd_docs else None
        want.append((doc_id, len(words), runs, None if runs is None else collapsed(words, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect()]
    if make is some_docs:  # ids are distinct: leave what the plain version is too slow for to the other tests
        whole = {w[0] for w in want if w[2] is not None}
        got, want = [g for g in got if g[0] in whole], [w for w in want if w[0] in whole]
    assert ordered(got) == ordered(want)


def test_query_over_texts_of_every_kind(spark, tmp_path):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choice(["ab", "c\x1cd", "é", "ß x"]) for _ in range(rng.randint(0, 260)))) for i in range(300)]
    texts += [(-1, None), (None, "a " * 40), (1000, "x\n" * 30 + "y\t" * 30), (1000, "x\n" * 30 + "y\t" * 30), (1001, "")]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for doc_id, text in texts:
        words = planted(doc_id, plain_words(text))
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        kept = hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
        want.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest, kept))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = QUERIES["op13_periodic"](spark, str(tmp_path)).select(*columns).collect()
    assert ordered(map(tuple, got)) == ordered(want)
    assert sum(bool(w[1]) for w in want) > 15
