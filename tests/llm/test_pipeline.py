import pytest

import corpus_pipeline
from cases import SMALL, no_docs, odd_docs, some_docs
from postloom.llm import decontaminate, language, near_dup, packing, quality, queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_acts_on_what_is_left(spark, tmp_path):
    docs = some_docs(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        path = f"{tmp_path}/{name}"
        stage(spark, docs, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == COLUMNS
        kept = {r.doc_id for r in after.collect()}
        want = {
            "language": lambda: language.identify(docs).filter("lang_pred <> 'und' and score >= 0.5"),
            "quality": lambda: quality.quality(docs, spark.read.parquet(f"{SMALL}/labels.parquet")).filter("kept"),
            "near_dup": lambda: near_dup.document_classes(docs).filter("stays"),
            "decontaminate": lambda: decontaminate.contamination(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).filter("not contaminated"),
        }[name]()
        assert kept == {r.doc_id for r in want.collect()} and kept <= before
        docs = after
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    plain = packing.packed_documents(docs, queries.vocabulary("word_bpe_49k.json"), 1).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in last) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in plain)
    assert {r.doc_id for r in last} == {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_stages_bear_odd_rows(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
        assert stage(spark, docs, SMALL).count() <= docs.count()
