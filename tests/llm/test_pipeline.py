"""The pipeline: each stage on small and odd tables, and whole."""

import odd
import plain
from conftest import MEDIUM

import corpus_pipeline
from leavewatch.llm import packing
from leavewatch.llm.tables import table


def test_stages_on_odd_documents(spark):
    for make in (odd.documents, odd.repeated, odd.empty):
        docs = make(spark)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = docs.count()
            docs = spark.createDataFrame(stage(spark, docs, MEDIUM).collect(), docs.schema)
            assert docs.columns == columns, name
            assert docs.count() <= before, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, MEDIUM).count() >= docs.count()


def test_stages_decide_like_plain_ones(spark):
    docs = table(spark, MEDIUM, "documents")
    texts = {r.doc_id: r.text for r in corpus_pipeline.known_language(spark, docs, MEDIUM).collect()}
    assert len(texts) == docs.count()  # all have letters and a main language
    texts = {i: t for i, (t, n, gone) in plain.line_dedup(texts).items() if gone < n}
    groups = plain.near_duplicates(texts)
    texts = {i: t for i, t in texts.items() if groups[i][3] == i}
    items = [(r.item_id, r.text) for r in table(spark, MEDIUM, "benchmark").collect()]
    hits = plain.benchmark_hits(list(texts.values()), items)
    texts = {i: t for (i, t), hit in zip(texts.items(), hits) if not hit[4]}
    expected = packing.pieces(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    found = corpus_pipeline.run(spark, MEDIUM)
    assert sorted(map(tuple, expected)) == sorted(tuple(r)[:5] for r in found.collect())
    used, least = packing.certificate(found)
    assert used <= least + 1
