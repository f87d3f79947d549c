import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import crc_of_ids, no_docs, odd_docs, ordered, pairs, some_docs
from postloom.llm import bpe, packing, token_files

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")

PARTS = list("abAé'sß \n\t.,!1２’ﬁİΣ😀日<|>\x1c") + [" ", " ", "́", " ", "'ll", "<|endoftext|>"]


def plain_ids(path, texts, end):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [[*e.ids, end] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), max_size=8))
@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_cut_and_cached_ids_are_the_tokenizers_ids(path, texts):
    ids, counts = bpe.encoder(path, 5).encode(pa.array([*texts, None], pa.string()))
    want = plain_ids(path, [*texts, None], 5)
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_RUNS", 3)
    encoder = bpe.Encoder(BYTE_BPE, 0)
    for text in ["one two three four five", "six seven", "one two nine"]:
        assert encoder.encode(pa.array([text]))[0].tolist() == plain_ids(BYTE_BPE, [text], 0)[0]


@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_packing(spark, make):
    docs, capacity = make(spark), 512
    rows = packing.packed_documents(docs, WORD_BPE, 1, capacity).collect()
    texts = pairs(docs)
    want = []
    for (doc_id, _), ids in zip(texts, plain_ids(WORD_BPE, [t for _, t in texts], 1)):
        for piece, at in enumerate(range(0, len(ids), capacity)):
            want.append((doc_id, piece, at, len(ids[at : at + capacity]), crc_of_ids(ids[at : at + capacity])))
    assert ordered((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == ordered(want)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    if rows:
        assert len(by_sequence) == best_fit_decreasing([r.length for r in rows], capacity)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= n]
        gap = min(fitting) if fitting else capacity
        if fitting:
            gaps.remove(gap)
        gaps.append(gap - n)
    return len(gaps)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 60), min_size=1))
def test_runs_pack_like_single_documents(sizes):
    counts = np.zeros(41, dtype=np.int64)
    for size, n in sizes.items():
        counts[size] = n
    plan = packing.matches(counts, 40)
    assert len(plan) <= 50 * 40
    load = {}
    for size, n in sizes.items():
        own = plan[plan[:, 0] == size]
        for rank in range(n):
            _, first, q, sequence, offset = own[own[:, 1] <= rank][np.argmax(own[own[:, 1] <= rank][:, 1])].tolist()
            load.setdefault(sequence + (rank - first) // q, []).append((offset + (rank - first) % q * size, size))
    for held in load.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= 40
    assert len(load) == best_fit_decreasing([s for s, n in sizes.items() for _ in range(n)], 40)


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_token_files(spark, make, kind):
    docs = make(spark)
    rows = token_files.token_file_round_trip(docs, BYTE_BPE, 0, kind).collect()
    texts = pairs(docs)
    want = ordered((d, len(ids), crc_of_ids(ids)) for (d, _), ids in zip(texts, plain_ids(BYTE_BPE, [t for _, t in texts], 0)))
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    at, seen = 0, []
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        seen.append((r.doc_id is not None, r.doc_id))
    assert seen == sorted(seen, key=lambda x: (x[0], x[1] or 0))


def test_many_small_files_share_a_manifest_file_and_read_tasks(spark, monkeypatch, tmp_path):
    settings = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    docs = spark.createDataFrame([(i, f"text {i} of some") for i in range(120)], "doc_id bigint, text string")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        manifest = token_files.write_token_files(docs, f"file://{tmp_path}/ids", BYTE_BPE, 0)
        files = manifest.count()
        assert files > 4
        assert len(manifest.inputFiles()) == 1
        shared = token_files.read_token_files(manifest)
        assert shared.rdd.getNumPartitions() == 1
        monkeypatch.setattr(token_files, "READ_IDS", 1)
        alone = token_files.read_token_files(manifest)
        assert alone.rdd.getNumPartitions() == files
        want = plain_ids(BYTE_BPE, [f"text {i} of some" for i in range(120)], 0)
        for rows in (shared.collect(), alone.collect()):
            assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in sorted(rows, key=lambda r: r.start)] == [(i, len(w), crc_of_ids(w)) for i, w in enumerate(want)]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_random_access(tmp_path, kind):
    ids = np.random.default_rng(3).integers(0, 1 << 20, 1000).astype("<u4")
    out = token_files.FileWriter(f"file://{tmp_path}/x.ids", kind, block=64)
    for at in range(0, 1000, 250):
        out.add(ids[at : at + 250], np.array([at]), np.array([False]), np.array([250]))
    out.close()
    back = token_files.FileReader(f"file:{tmp_path}/x.ids")
    for a, b in [(0, 1000), (63, 65), (64, 128), (999, 1000), (5, 5)]:
        assert back.ids(a, b).tolist() == ids[a:b].tolist()
    assert back.checksums() == [crc_of_ids(ids[a : a + 250].tolist()) for a in range(0, 1000, 250)]
