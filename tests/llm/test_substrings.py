"""Repeated word passages and byte strings against plain versions."""

import numpy as np
import odd
import plain
import pyarrow as pa
import pytest

from leavewatch.llm import queries, substring_dedup, suffix_dedup
from leavewatch.llm import windows as W


def word_rows(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in df.collect()}


def byte_rows(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept) for r in df.collect()}


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_documents(spark, parts):
    docs, texts = odd.documents(spark, parts), odd.by_id(odd.texts())
    assert word_rows(substring_dedup.deduplicated(docs, digest=True)) == plain.word_passages(texts)
    assert byte_rows(suffix_dedup.deduplicated(docs, digest=True)) == plain.byte_strings(texts)


def test_kept_text_is_the_digested_one(spark):
    docs = odd.documents(spark)
    whole = {r.doc_id: plain.sha(r.kept) for r in substring_dedup.deduplicated(docs).collect()}
    assert whole == {r.doc_id: r.kept for r in substring_dedup.deduplicated(docs, digest=True).collect()}
    whole = {r.doc_id: plain.sha(bytes(r.kept)) for r in suffix_dedup.deduplicated(docs).collect()}
    assert whole == {r.doc_id: r.kept for r in suffix_dedup.deduplicated(docs, digest=True).collect()}


def test_repeated_rows_and_missing_ids(spark):
    pairs = [(r[0], r[1]) for r in odd.repeated(spark).collect()]
    texts = odd.by_id([(W_NO_ID if i is None else i, t) for i, t in pairs])
    expected = plain.word_passages(texts)
    assert word_rows(substring_dedup.deduplicated(odd.repeated(spark), digest=True)) == {None if i == W_NO_ID else i: v for i, v in expected.items()}
    expected = plain.byte_strings(texts)
    assert byte_rows(suffix_dedup.deduplicated(odd.repeated(spark), digest=True)) == {None if i == W_NO_ID else i: v for i, v in expected.items()}


W_NO_ID = -(1 << 63)


def test_empty_table(spark):
    assert substring_dedup.deduplicated(odd.empty(spark)).count() == 0
    assert suffix_dedup.deduplicated(odd.empty(spark)).count() == 0


def test_shared_passages_with_different_neighbours(spark):
    passage = odd.prose(50, 40)
    rows = [(i, f"{odd.prose(60 + i, i % 7)} {passage[: 40 + 5 * i]} {odd.prose(90 + i, 9)}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for hot in (1024, 2, 0):
        assert word_rows(substring_dedup.deduplicated(docs, digest=True, hot_group=hot)) == plain.word_passages(dict(rows))
        assert byte_rows(suffix_dedup.deduplicated(docs, digest=True, hot_group=hot)) == plain.byte_strings(dict(rows))


def test_loser_tree_merges_runs():
    r = np.random.default_rng(3)
    for k in (1, 2, 3, 5, 8):
        runs, codes = [], []
        for _ in range(k):
            words = r.integers(0, 3, size=(int(r.integers(0, 60)), 3)).astype(np.uint64) << np.uint64(8)
            words = words[np.lexsort(words.T[::-1])]
            shared, rest = suffix_dedup.front_coded(words) if len(words) else (np.empty(0, np.uint8),) * 2
            assert (suffix_dedup.decoded(shared, rest) == words).all()
            runs.append(words)
            codes.append(shared)
        run, common = suffix_dedup.merged(runs, codes)
        flat = np.concatenate(runs)
        place = np.argsort(np.argsort(run, kind="stable"), kind="stable")
        order = np.argsort(run, kind="stable")
        inverse = np.empty_like(order)
        inverse[order] = np.arange(len(order))
        out = flat[inverse]
        assert len(place) == len(flat)
        assert out.tolist() == sorted(flat.tolist())
        for i in range(1, len(out)):
            a, b = (suffix_dedup.as_bytes(x[None])[0].tobytes() for x in (out[i - 1], out[i]))
            n = next((j for j in range(24) if a[j] != b[j]), 24)
            assert n == common[i]


def test_hot_keys_and_turns(monkeypatch):
    monkeypatch.setattr(W, "HOT", 2)
    group = np.array([7, 7, 9, 7, 9, 7], dtype=np.uint64)
    assert W.hot(group).tolist() == [False, False, False, True, False, True]
    text = np.frombuffer((odd.prose(1, 80) * 3).encode(), dtype=np.uint8)
    n = np.array([len(text) - 99], dtype=np.int32)
    start = np.arange(int(n[0]))
    hashes = [h.ranges(h.sums(text), start, start + 100) for h in (suffix_dedup.FIRST, suffix_dedup.SECOND)]
    # Document 6 has the same windows, sent one by one; the last two of document 4 are known to be repeated.
    value = W.packed(np.array([4, 8]), np.zeros(2, np.int32), np.repeat(n, 2), np.concatenate([text, text]),
                     *hashes, np.full(len(start), 6), start.astype(np.int32), np.array([4, 4]), np.array([n[0] - 2, n[0] - 1], dtype=np.int32))
    table = pa.table({"bucket": [0], "payload": [value]})

    def marked():
        out = suffix_dedup._compare(table)
        return {r["doc_id"]: sorted(x for lo, k in np.frombuffer(r["dup"], W.DUP).tolist() for x in range(lo, lo + k)) for r in out.to_pylist()}

    whole = marked()
    monkeypatch.setattr(W, "AT_ONCE", 100)
    assert marked() == whole
    assert whole[8] == whole[6] == list(range(int(n[0])))
    assert set(whole[4]) >= {int(n[0]) - 2, int(n[0]) - 1} and len(whole[4]) < len(whole[8])


def greedy(passages):
    """Plain relative Lempel-Ziv: (doc, window, windows, reference's doc and window) of each factor."""
    out = []
    for doc, lo, letters in passages:
        at = 0
        while at < len(letters):
            best = (0, 0, 0)  # length, then the earliest reference
            for d, l, other in passages:
                for j in range(len(other) if d < doc else 0):
                    k = 0
                    while at + k < len(letters) and j + k < len(other) and letters[at + k] == other[j + k]:
                        k += 1
                    best = max(best, (k, -d, -(l + j)))
            if best[0]:
                out.append((doc, lo + at, best[0], -best[1], -best[2]))
            at += max(1, best[0])
    return sorted(out)


@pytest.mark.parametrize("seed", range(12))
def test_factors_are_the_greedy_parse(seed):
    r = np.random.default_rng(seed)
    passages = []
    for doc in range(1, 9):
        lo = 0
        for _ in range(int(r.integers(0, 5))):
            letters = r.integers(0, 2 + seed % 3, size=int(r.integers(1, 10)))
            passages.append((doc, lo, letters.tolist()))
            lo += len(letters) + int(r.integers(0, 3))
    shuffled = [passages[i] for i in r.permutation(len(passages))]
    columns = [np.array([p[0] for p in shuffled], dtype=np.int64), np.array([p[1] for p in shuffled], dtype=np.int64),
               np.array([len(p[2]) for p in shuffled], dtype=np.int64), np.array([x for p in shuffled for x in p[2]], dtype=np.uint64)]
    assert sorted(zip(*(c.tolist() for c in substring_dedup.factors(*columns)))) == greedy(passages)


def test_passages_are_parsed_in_turns(monkeypatch):
    texts = [f"{odd.prose(160 + i, i % 7)} {odd.prose(150, 40 + 5 * (i % 3))} {odd.prose(190 + i, 9)}" for i in range(40)]
    spans = []
    for text in texts:
        _, _, _, _, _, words, bounds = next(substring_dedup._words(pa.array([text])))
        at, low, high, _ = substring_dedup.anchors(words, bounds, 13, 5)
        spans.append([W.records(W.DETAIL, lo=low, n=high - low + 1, off=at - low).tobytes()])
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(texts), pa.array(spans, pa.list_(pa.binary()))], ["doc_id", "text", "spans"])
    values = [v for out in substring_dedup._passages(13, 5, 1)(iter([batch])) for v in out.column(1).to_pylist()]
    table = pa.table({"bucket": [0] * len(values), "payload": values})

    def gone():
        out = {i: 0 for i in range(40)}
        for r in substring_dedup._factored(table).to_pylist():
            out[r["doc_id"]] = len({w for lo, n in np.frombuffer(r["dup"], W.DUP).tolist() for w in range(lo, lo + n + 12)})
        return out

    expected = {i: n for i, (_, n, _) in plain.word_passages(dict(enumerate(texts))).items()}
    assert gone() == expected
    monkeypatch.setattr(W, "AT_ONCE", 50)
    assert gone() == expected


@pytest.mark.parametrize("hot", [4096, 2])
def test_blocks_beyond_hot_meet_copies_of_other_tasks(monkeypatch, hot):
    monkeypatch.setattr(W, "HOT", hot)
    phrase = odd.prose(70, 40)
    texts = {3: f"{odd.prose(71, 20)} {phrase} {odd.prose(72, 20)}", 8: " ".join([phrase] * 30), 9: " ".join(["same"] * 200), 4: " ".join(["same"] * 50)}
    parts = [[4, 3], [8, 9]]  # two tasks: the earlier copies, and documents that repeat one passage or word

    def grouped(batches, work):
        values = {}
        for batch in batches:
            for row in batch.to_pylist():
                values.setdefault(row["bucket"], []).append(row["payload"])
        return [row for b, v in values.items() for row in work(pa.table({"bucket": [b] * len(v), "payload": v})).to_pylist()]

    body = [pa.RecordBatch.from_pydict({"doc_id": ids, "text": [texts[i] for i in ids]}) for ids in parts]
    found = grouped((out for part in body for out in substring_dedup._blocks(13, 5, 4)(iter([part]))), substring_dedup._meet(1024))
    asked = {i: [r["detail"] for r in found if r["doc_id"] == i and r["detail"]] for i in texts}
    body = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([texts[i]]), pa.array([asked[i]], pa.list_(pa.binary()))], ["doc_id", "text", "spans"])
            for i in texts if asked[i]]
    found += grouped(substring_dedup._passages(13, 5, 4)(iter(body)), substring_dedup._factored)
    removed = {}
    for i, text in texts.items():
        spans = [np.frombuffer(r["dup"], W.DUP) for r in found if r["doc_id"] == i and r["dup"]]
        removed[i] = len({w for lo, n in np.concatenate([np.empty(0, W.DUP), *spans]).tolist() for w in range(lo, lo + n + 12)})
    assert removed == {i: gone for i, (_, gone, _) in plain.word_passages(texts).items()}


@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
def test_windows_of_a_hot_anchor_are_dealt_evenly(module):
    """All blocks of one anchor, thousands of them, spread over the buckets by window."""
    n_buckets, texts = 16, [odd.prose(s, 120) for s in range(300)]
    n = 60 if module is substring_dedup else 400
    spans = [[np.array([(0, n, W.HOT_MARK + 5)], dtype=W.DETAIL).tobytes()] for _ in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array(texts), pa.array(spans, pa.list_(pa.binary()))], ["doc_id", "text", "spans"])
    emit = module._passages(13, 5, n_buckets) if module is substring_dedup else module._strings(n_buckets)
    held = np.zeros(n_buckets, dtype=int)
    for out in emit(iter([batch])):
        for bucket, payload in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            held[bucket] += len(W.unpacked(payload, *module._ASKED)[4])
    assert held.sum() > 0.8 * 300 * n and held.max() < 1.2 * held.mean()


def test_whole_table_equals_plain_versions(spark):
    """The registered queries on all documents of a given table."""
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.QUERIES["op5_substring_dedup"](spark, folder).collect()}
    assert found == plain.word_passages(texts)
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op10_suffix_dedup"](spark, folder).collect()}
    assert found == plain.byte_strings(texts)


@pytest.mark.parametrize("module", [substring_dedup, suffix_dedup])
def test_blocks_are_dealt_evenly_by_their_anchors(module):
    """Anchors are least hashes; buckets must not follow that."""
    n_buckets, texts = 16, [odd.prose(s, 150) for s in range(300)]
    column = pa.array(texts)
    spans = []
    for text in texts:
        if module is substring_dedup:
            _, _, _, _, _, items, bounds = next(module._words(pa.array([text])))
            at, low, high, _ = module.anchors(items, bounds, 13, 5)
        else:
            _, _, items, bounds = next(module.slices(pa.array([text])))
            at, low, high, _ = module.anchors(items, bounds, 100, module.DEPTH)
        spans.append([W.records(W.DETAIL, lo=low, n=high - low + 1, off=at - low).tobytes()])
    batch = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), column, pa.array(spans, pa.list_(pa.binary()))], ["doc_id", "text", "spans"])
    emit = module._passages(13, 5, n_buckets) if module is substring_dedup else module._strings(n_buckets)
    held = np.zeros(n_buckets, dtype=int)
    for out in emit(iter([batch])):
        for bucket, payload in zip(out.column(0).to_pylist(), out.column(1).to_pylist()):
            held[bucket] += len(W.unpacked(payload, *module._ASKED)[0])
    assert held.sum() > 1000 and held.max() < 1.5 * held.mean()
