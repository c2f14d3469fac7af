"""Rows that repeat a doc_id or have none are documents of their own in the queries and the pipeline."""

from collections import Counter

import odd
import plain
import pytest

import corpus_pipeline
from leavewatch.llm import queries

SHARED = "\n".join(odd.prose(s, 6) for s in range(800, 812))
ROWS = [(None, odd.prose(820, 40)), (None, odd.prose(821, 40)), (None, SHARED), (None, None), (3, ""), (3, odd.prose(822, 50)),
        (4, f"{odd.prose(823, 30)}\n{SHARED}"), (4, odd.prose(824, 60)), (5, odd.prose(825, 40)), (5, odd.prose(825, 40)), (6, odd.prose(820, 40))]
# In the order of the operators: no row shares a text with another of its doc_id but the equal ones.
TEXTS = {k: text or "" for k, (_, text) in enumerate(ROWS)}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("rows"))
    (spark.createDataFrame([(i, t, "xx", None, len(t or "")) for i, t in ROWS], "doc_id long, text string, lang string, source string, n_chars long")
     .repartition(3).write.parquet(f"{where}/documents.parquet"))
    return where


def found(spark, folder, name, *columns):
    return Counter(tuple(r) for r in queries.QUERIES[name](spark, folder).select("doc_id", *columns).collect())


def test_lines(spark, folder):
    expected = Counter((ROWS[k][0], lines, gone, plain.sha(text)) for k, (text, lines, gone) in plain.line_dedup(TEXTS).items())
    assert found(spark, folder, "op1_line_dedup", "n_lines", "n_removed", "kept_sha256") == expected


def test_substrings(spark, folder):
    expected = Counter((ROWS[k][0], *v) for k, v in plain.word_passages(TEXTS).items())
    assert found(spark, folder, "op5_substring_dedup", "n_words", "n_removed", "kept_sha256") == expected
    expected = Counter((ROWS[k][0], *v) for k, v in plain.byte_strings(TEXTS).items())
    assert found(spark, folder, "op10_suffix_dedup", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected


def test_near_duplicates(spark, folder):
    expected = Counter((ROWS[k][0], ROWS[c][0], n, links, ROWS[g][0]) for k, (c, n, links, g) in plain.near_duplicates(TEXTS).items())
    assert found(spark, folder, "op3_jaccard_join", "class_id", "class_size", "n_links", "group_id") == expected


def test_pipeline_stages_lose_no_text(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lines = plain.line_dedup(TEXTS)
    after = corpus_pipeline.repeated_lines_removed(spark, docs, folder)
    assert after.schema.simpleString() == docs.schema.simpleString()
    assert Counter((r.doc_id, r.text or "") for r in after.collect()) == Counter((ROWS[k][0], t) for k, (t, n, gone) in lines.items() if gone < n)
    after = corpus_pipeline.one_of_near_duplicates(spark, docs, folder)
    assert after.schema.simpleString() == docs.schema.simpleString()
    groups = plain.near_duplicates(TEXTS)
    assert Counter((r.doc_id, r.text or "") for r in after.collect()) == Counter((ROWS[k][0], TEXTS[k]) for k in TEXTS if groups[k][3] == k)
