"""Language identification: held-out accuracy, mixtures, odd texts."""

import math
import zlib
from collections import Counter

import numpy as np
import odd
import pyarrow.parquet as pq
import pytest
from conftest import MEDIUM

from leavewatch.llm import language_id


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    found = {r.doc_id: r for r in language_id.report(docs).collect()}
    rows = pq.read_table(f"{MEDIUM}/documents.parquet").to_pylist()
    assert len(found) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {i for i, r in found.items() if r.held_out} == {r["doc_id"] for r in held}
    assert sum(found[r["doc_id"]].lang_pred == r["lang"] for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_only_texts_decide(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = language_id.learned(docs)
    other = docs.selectExpr("doc_id + 1 AS doc_id", "text", "'zz' AS lang", "source")
    first = {r.row.text: (r.lang_pred, r.score) for r in language_id.predicted(docs, model, ["text"]).collect()}
    assert first == {r.row.text: (r.lang_pred, r.score) for r in language_id.predicted(other, model, ["text"]).collect()}


def test_mixture_has_several_languages(spark):
    rows = pq.read_table(f"{MEDIUM}/documents.parquet").to_pylist()
    by = {}
    for r in rows:
        if len(r["text"]) > 1500:
            by.setdefault(r["lang"], r["text"])
    text = by["en"][:900] + " " + by["de"][:500]
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    row = language_id.predicted(spark.createDataFrame([(1, text)], "doc_id long, text string"), language_id.learned(docs)).first()
    assert row.lang_pred == "en" and row.n_languages >= 2 and 0.5 < row.score < 0.8


def test_odd_documents(spark):
    for make in (odd.documents, odd.repeated):
        docs = make(spark)
        rows = language_id.report(docs).collect()
        assert len(rows) == docs.count()
        known = {"xx", "yy", "und"}
        assert {r.lang_pred for r in rows} <= known
    texts = dict(odd.texts())
    by = {r.doc_id: r for r in language_id.report(odd.documents(spark)).collect()}
    for i, r in by.items():
        letter = any(c.isalpha() for c in texts[i] or "")
        assert (r.lang_pred == "und") == (not letter)
        assert letter or r.score == 0
    left = language_id.identified(odd.documents(spark))
    assert left.columns == odd.documents(spark).columns
    assert {r.doc_id for r in left.collect()} <= {i for i, r in by.items() if r.lang_pred != "und"}


def test_nothing_to_learn_from(spark):
    docs = odd.documents(spark).withColumn("lang", odd.F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.report(docs).collect()} == {"und"}
    assert language_id.report(odd.empty(spark)).count() == 0


def test_sets_of_more_than_three_languages():
    r = np.random.default_rng(5)
    shares = [0.45, 0.20, 0.18, 0.17]
    counts = np.full((6, language_id.BUCKETS), 0.5)
    for lang in range(6):
        counts[lang, 100 * lang:100 * lang + 100] += 1000
    bucket = np.concatenate([100 * lang + r.integers(0, 100, size=int(4000 * share)) for lang, share in enumerate(shares)]).astype(np.uint32)
    main, score, n = language_id.judged(np.zeros(len(bucket), np.int64), bucket, 1, np.log(counts / counts.sum(axis=1, keepdims=True)), np.full(6, 1 / 6))
    assert main[0] == 0 and n[0] == 4 and abs(score[0] - 0.45) < 0.01


def grams(text):
    """Bucket -> number of a text's trigrams."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    return Counter((((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) * 2654435761) % 2**32) >> 17 for i in range(len(raw) - 2))


def plain_model(rows):
    counts, texts = {}, Counter()
    for doc_id, text, lang in rows:
        if lang is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2 and any(c.isalpha() for c in text or ""):
            counts.setdefault(lang, Counter()).update(grams(text))
            texts[lang] += 1
    names = sorted(counts)
    totals = {lang: sum(counts[lang].values()) + 0.5 * 2**15 for lang in names}
    return names, lambda lang, g: math.log((counts[lang][g] + 0.5) / totals[lang]), {lang: texts[lang] / sum(texts.values()) for lang in names}


def plain_em(count, allowed, log):
    """Shares after twelve rounds, and the log-likelihood."""
    share, total = {lang: 1 / len(allowed) for lang in allowed}, sum(count.values())
    chance = {g: {lang: math.exp(log(lang, g)) for lang in allowed} for g in count}
    for _ in range(12):
        new = dict.fromkeys(allowed, 0.0)
        for g, n in count.items():
            whole = sum(share[lang] * chance[g][lang] for lang in allowed)
            for lang in allowed:
                new[lang] += n * share[lang] * chance[g][lang] / whole
        share = {lang: v / total for lang, v in new.items()}
    return share, sum(n * math.log(sum(share[lang] * chance[g][lang] for lang in allowed)) for g, n in count.items())


def plain_language(text, model):
    names, log, prior = model
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, 0
    count = grams(text)
    if not count:
        best = max(names, key=lambda lang: (prior[lang], -names.index(lang)))
        return best, prior[best], 1
    alone = {lang: sum(n * log(lang, g) for g, n in count.items()) for lang in names}
    best = max(names, key=alone.get)
    value, out = alone[best], (best, 1 / sum(math.exp(alone[lang] - alone[best]) for lang in names), 1)
    share, _ = plain_em(count, names, log)
    order = sorted(names, key=lambda lang: -share[lang])
    for k in range(2, len(names) + 1):
        if share[order[k - 1]] < 0.02:
            break
        mixture, likelihood = plain_em(count, order[:k], log)
        likelihood -= (k - 1) / 2 * math.log(max(sum(count.values()), 2))
        if likelihood > value:
            value, main = likelihood, max(order[:k], key=mixture.get)
            out = (main, mixture[main], k)
    return out


def test_every_text_as_by_a_plain_em(spark):
    """The operator on texts of one language, of several, short, odd and long, with the model of the whole table."""
    table = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in table.collect()]
    model = plain_model(rows)
    long = {lang: next(t for _, t, own in rows if own == lang and len(t) > 1500) for lang in model[0]}
    texts = [t for _, t, _ in rows[:80] if len(t) < 6000] + [t for _, t in odd.texts() if t is None or len(t) < 5000]
    texts += [long[a][:600] + " " + long[b][:200 + 100 * i] for i, (a, b) in enumerate((a, b) for a in long for b in long if a != b)]
    texts += [" ".join(long[lang][:n] for lang, n in zip(long, (500, 400, 300, 300))), "ab", "é", "Zz9"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.row.doc_id: r for r in language_id.predicted(frame, language_id.learned(table)).collect()}
    several = 0
    for i, text in enumerate(texts):
        lang, score, n = plain_language(text, model)
        assert (found[i].lang_pred, found[i].n_languages) == (lang, n), (i, text and text[:60])
        assert abs(found[i].score - score) < 1e-6
        several += n > 1
    assert several >= 10


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 2)
    docs = odd.documents(spark)  # two languages
    assert language_id.report(docs).count() == docs.count()
    more = docs.withColumn("lang", odd.F.concat("lang", odd.F.col("doc_id") % 3))
    with pytest.raises(ValueError, match="more than 2"):
        language_id.report(more)
