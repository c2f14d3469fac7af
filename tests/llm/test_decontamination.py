"""Benchmark passages in documents against a plain scan."""

import odd
import plain
import pytest

from leavewatch.llm import decontamination

ITEMS = [(1, odd.prose(1, 14)), (2, odd.prose(1, 60).upper()), (3, odd.prose(6, 3)), (4, None), (5, ""), (6, "!!"), (10, odd.prose(2, 400)), (2, odd.prose(9, 4)), (None, odd.prose(7, 40)), (-1, odd.prose(7, 30)),
         (12, odd.prose(3, 5)), (13, "nul"), (11, odd.prose(1, 60))]


def benchmark(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string")


def found(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


def expected(docs, items=ITEMS):
    rows = docs.collect()
    return sorted((str(r.doc_id), *x) for r, x in zip(rows, plain.benchmark_hits([r.text for r in rows], items)))


@pytest.mark.parametrize("make", [odd.documents, odd.repeated, odd.empty])
def test_hits(spark, make):
    docs = make(spark)
    assert found(decontamination.report(docs, benchmark(spark))) == expected(docs)


def test_no_items(spark):
    docs = odd.documents(spark)
    assert found(decontamination.report(docs, benchmark(spark, []))) == expected(docs, [])
    assert decontamination.clean(docs, benchmark(spark, [])).count() == docs.count()


def test_blocks_of_the_benchmark_add_up(spark):
    docs = odd.documents(spark)
    whole = decontamination.matched(docs, benchmark(spark), keep=["doc_id"]).collect()
    parts = decontamination.matched(docs, benchmark(spark), keep=["doc_id"], block_bytes=3000).collect()
    key = lambda r: (r.row.doc_id, r.n_words, r.hit, sorted(set(r["items"])), r.longest and r.longest.words)
    assert sorted(map(str, map(key, whole))) == sorted(map(str, map(key, parts)))


def test_longest_match(spark):
    text = f"{odd.prose(70, 5)} {odd.prose(1, 33)} {odd.prose(71, 5)} {odd.prose(1, 12)}"
    row = decontamination.report(spark.createDataFrame([(1, text)], "doc_id long, text string"), benchmark(spark)).first()
    assert (row.longest_words, row.longest_item, row.longest_at) == (33, 11, 5)


def test_clean_keeps_columns(spark):
    docs = odd.documents(spark)
    left = decontamination.clean(docs, benchmark(spark))
    assert left.schema.simpleString() == docs.schema.simpleString()
    hit = {r[0] for r in expected(docs) if r[5]}
    assert {str(r.doc_id) for r in left.collect()} == {str(r.doc_id) for r in docs.collect()} - hit


def test_repeated_items_fill_no_block(spark):
    """Many equal rows in the benchmark are one item, in one small block."""
    docs = odd.documents(spark)
    assert found(decontamination.report(docs, benchmark(spark, ITEMS * 50).repartition(4))) == expected(docs)


def test_longest_match_has_an_order(spark):
    """Of equally long matches the first in the text, then the smallest item, in one block or several."""
    items = [(9, odd.prose(1, 20)), (5, odd.prose(1, 20)), (2, odd.prose(2, 20)), (None, odd.prose(3, 12))]
    docs = spark.createDataFrame([(1, f"{odd.prose(1, 20)} x {odd.prose(2, 20)}"), (2, f"{odd.prose(2, 20)} x {odd.prose(1, 20)}"),
                                  (3, odd.prose(3, 12))], "doc_id long, text string")
    for size in (1 << 24, 100):
        found = decontamination.matched(docs, benchmark(spark, items), keep=["doc_id"], block_bytes=size).collect()
        assert {r.row.doc_id: r.longest and tuple(r.longest) for r in found} == {1: (20, 5, 0), 2: (20, 2, 0), 3: (12, None, 0)}
