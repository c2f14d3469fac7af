"""Repeated line chunks against a plain version."""

import odd
import plain
import pytest
from compare import assert_same, connect
from conftest import MEDIUM

from leavewatch.llm import line_dedup, queries

NO_ID = -(1 << 63)


def rows(df):
    return {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in df.collect()}


@pytest.mark.parametrize("make", [odd.documents, odd.repeated, odd.empty])
def test_odd_documents(spark, make):
    docs = make(spark)
    texts = odd.by_id([(NO_ID if r.doc_id is None else r.doc_id, r.text) for r in docs.collect()])
    expected = {None if i == NO_ID else i: v for i, v in plain.line_dedup(texts).items()}
    assert rows(line_dedup.deduplicated(docs)) == expected
    cleaned = line_dedup.cleaned(docs)
    assert cleaned.schema.simpleString() == docs.schema.simpleString()
    assert {r.doc_id: r.text for r in cleaned.collect()} == {i: t for i, (t, n, gone) in expected.items() if gone < n}


def test_inserted_line_moves_no_later_boundary(spark):
    lines = [odd.prose(s, 5) for s in range(200, 260)]
    docs = [(1, "\n".join(lines)), (2, "\n".join([*lines[:7], "inserted", *lines[7:]]))]
    found = rows(line_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")))
    assert found == plain.line_dedup(dict(docs))
    assert found[2][2] > 40


def test_chunk_in_a_third_of_all_documents(spark):
    shared = "\n".join(odd.prose(s, 5) for s in range(300, 320))
    docs = [(i, f"{odd.prose(400 + i, 4)}\n{shared}" if i % 3 == 0 else odd.prose(400 + i, 9)) for i in range(150)]
    assert rows(line_dedup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"))) == plain.line_dedup(dict(docs))


def test_no_python_in_the_plan(spark):
    plan = queries.QUERIES["op1_line_dedup"](spark, MEDIUM)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_registered_query_matches_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, MEDIUM).toPandas(), connect(MEDIUM).execute(queries.ORACLE_SQL[name]).df())


def test_hot_digests_are_dealt_to_several_tasks(spark):
    """The same result with every digest beyond 4 chunks dealt in shards."""
    shared = ["\n".join(odd.prose(s, 5) for s in range(k, k + 6)) for k in (500, 520, 540)]
    docs = [(i, f"{odd.prose(600 + i, 4)}\n{shared[i % 3]}\n{odd.prose(900 + i, 4)}" if i % 4 else shared[i % 3]) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    body = line_dedup.one_per_id(frame)
    def chosen(df):
        return {r.doc_id: sorted(r.removed) for r in df.collect()}

    found = chosen(line_dedup.repeated_chunks(body, hot=4))
    assert found == chosen(line_dedup.repeated_chunks(body)) and len(found) > 20


def test_whole_copies_go_whole(spark):
    """Every text of several lines that equals an earlier one loses all its lines."""
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").collect()}
    seen, copies = set(), set()
    for i in sorted(texts):
        if texts[i] in seen and "\n" in texts[i]:
            copies.add(i)
        seen.add(texts[i])
    found = {r.doc_id: (r.n_lines, r.n_removed) for r in queries.QUERIES["op1_line_dedup"](spark, "/root/testdata/sf0.1").collect()}
    assert len(copies) > 600 and all(found[i][0] == found[i][1] for i in copies)
