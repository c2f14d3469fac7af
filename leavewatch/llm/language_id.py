"""Languages of a text as a mixture, by expectation-maximisation over n-gram likelihoods.

A language is a distribution over hashed byte trigrams, counted over all
labelled training texts. A text is a mixture of languages: EM finds their
proportions, and of the nested sets of its largest languages the one with the
best likelihood less a penalty per language is its language set.

Nulls: a null text, or one without a letter, is `und`; a null lang or doc_id is
not learned from. Ties of languages go to the first by name. Rows that repeat
are judged alike, and learned from as often as they stand there. Empty tables
give empty results, and teach nothing. Long texts are judged whole, each a
piece of work of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leavewatch.llm.tables import row_struct, row_text, with_row, without_text
from leavewatch.llm.text_arrays import slices

BUCKETS = 1 << 15    # of hashed trigrams; the model holds languages x BUCKETS counts
MOST_LANGUAGES = 1000  # beyond, the model is no longer small: an error
SMOOTHING = 0.5
ROUNDS = 12          # of EM
MINOR = 0.02         # a language of a smaller share is in no set
PENALTY = 1.0        # times log(n) / 2 per further language
UNKNOWN = "und"
LEAST_SHARE = 0.5    # of the main language, for a text of several to pass `identified`
PIECE = 1 << 20      # bytes of text judged at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string").rlike(r"\p{L}"), F.lit(False))


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every trigram inside a text."""
    if len(data) < 3:
        return np.empty(0, np.int64), np.empty(0, np.uint32)
    low = _LOWER[data].astype(np.uint32)
    code = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
    bucket = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    count = np.diff(offsets)
    text = np.repeat(np.arange(len(count)), count)
    inside = text[:-2] == text[2:]
    return text[:-2][inside], bucket[inside]


def learned(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their log trigram probabilities, and their shares of the training texts.

    Learns from whole texts with a lang, where the remainder of doc_id is not
    2 and the text has a letter; a null doc_id has no remainder and is not
    learned from. What reaches the driver is languages x BUCKETS counts; more
    than MOST_LANGUAGES labels are an error.
    """
    if docs.where(F.col("lang").isNotNull()).select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for first, last, data, offsets in slices(batch.column(1)):
                text, bucket = trigrams(data, offsets)
                names, place = np.unique(langs[first:last].astype(str), return_inverse=True)
                held = np.bincount(place[text] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for i, name in enumerate(names.tolist()):
                    totals[name] = totals.get(name, 0) + held[i]
                    texts[name] = texts.get(name, 0) + int((place == i).sum())
        for name, held in totals.items():
            at = np.flatnonzero(held)
            columns = [pa.array([name] * (len(at) + 1)), pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(held[at], texts[name]))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    train = docs.where((remainder() != 2) & F.col("lang").isNotNull() & has_letter())
    rows = (train.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
            .mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    names, place = np.unique(np.array(rows.column("lang").to_pylist(), dtype=str), return_inverse=True)
    bucket, n = np.asarray(rows.column("bucket")), np.asarray(rows.column("n"))
    counts, texts = np.zeros((len(names), BUCKETS)), np.zeros(len(names))
    is_text = bucket < 0
    texts[place[is_text]] = n[is_text]
    counts[place[~is_text], bucket[~is_text]] = n[~is_text]
    counts += SMOOTHING
    return names.tolist(), np.log(counts / counts.sum(axis=1, keepdims=True)), texts / max(texts.sum(), 1)


def proportions(chance: np.ndarray, count: np.ndarray, edge: np.ndarray, total: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over texts at once: shares of the allowed languages, and the log-likelihoods.

    `chance` and `count` are of each text's distinct trigrams, which begin at
    `edge`; likelihoods are relative to each trigram's best language.
    """
    share = allowed / allowed.sum(axis=1, keepdims=True)
    size = np.diff(np.append(edge, len(count)))
    for _ in range(ROUNDS):
        part = chance * np.repeat(share, size, axis=0)
        part *= (count / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, edge, axis=0) / total[:, None]
    mixed = (chance * np.repeat(share, size, axis=0)).sum(axis=1)
    return share, np.add.reduceat(count * np.log(np.maximum(mixed, 1e-300)), edge)


def judged(text: np.ndarray, bucket: np.ndarray, n: int, model: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Main language, score and size of the language set of each of n texts."""
    main = np.full(n, int(prior.argmax()))
    score, languages = np.full(n, float(prior.max())), np.ones(n, dtype=np.int32)
    if not len(text):
        return main, score, languages
    key = text.astype(np.uint64) * np.uint64(BUCKETS) + bucket.astype(np.uint64)
    if n * BUCKETS < 1 << 32:
        key = key.astype(np.uint32)
    key, count = np.unique(key, return_counts=True)
    of, gram = (key // BUCKETS).astype(np.int64), (key % BUCKETS).astype(np.int64)
    edge = np.flatnonzero(np.diff(of, prepend=-1))
    present = of[edge]
    total = np.add.reduceat(count, edge).astype(float)
    logs = model.T[gram]
    alone = np.add.reduceat(logs * count[:, None], edge, axis=0)
    chance = np.exp(logs - logs.max(axis=1, keepdims=True))
    base = np.add.reduceat(logs.max(axis=1) * count, edge)
    share, _ = proportions(chance, count, edge, total, np.ones((len(edge), model.shape[0])))
    order = np.argsort(-share, axis=1, kind="stable")
    row = np.arange(len(edge))
    best = alone.argmax(axis=1)
    top = alone[row, best]
    posterior = 1 / np.exp(alone - top[:, None]).sum(axis=1)
    main[present], score[present] = best, posterior
    value = top.copy()  # penalised log-likelihood so far
    size = np.diff(np.append(edge, len(count)))
    for k in range(2, model.shape[0] + 1):
        some = np.flatnonzero(share[row, order[:, k - 1]] >= MINOR)
        if not len(some):
            break
        inside = np.repeat(np.isin(row, some), size)
        allowed = np.zeros((len(some), model.shape[0]))
        np.put_along_axis(allowed, order[some, :k], 1.0, axis=1)
        begin = np.cumsum(size[some]) - size[some]
        mixture, likelihood = proportions(chance[inside], count[inside], begin, total[some], allowed)
        likelihood += base[some] - PENALTY * (k - 1) / 2 * np.log(np.maximum(total[some], 2))
        won = likelihood > value[some]
        chosen = some[won]
        value[chosen] = likelihood[won]
        main[present[chosen]] = mixture[won].argmax(axis=1)
        score[present[chosen]] = mixture[won].max(axis=1)
        languages[present[chosen]] = k
    return main, np.clip(score, 0, 1), languages


RESULT = "lang_pred string, score double, n_languages int"


def predicted(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], keep: list[str] | None = None) -> DataFrame:
    """The kept columns of every row as struct `row`, and RESULT beside it.

    Only the text is looked at. Null texts and those without a letter are
    `und` with score 0, as are all texts where nothing was learned. A text of
    fewer than three bytes gets the most frequent language and its share.
    """
    columns = keep if keep is not None else docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs, prior = sent.value
        for batch in batches:
            letters = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), dtype=bool)
            row = batch.column(0) if inside else without_text(batch.column(0))
            for first, last, data, offsets in slices(row_text(batch.column(0), inside), PIECE):
                n = last - first
                known = letters[first:last] & bool(names)
                if names:
                    main, score, languages = judged(*trigrams(data, offsets), n, logs, prior)
                    found = np.where(known, np.array(names, dtype=object)[main], UNKNOWN)
                else:
                    found, score, languages = np.full(n, UNKNOWN, dtype=object), np.zeros(n), np.zeros(n)
                yield pa.RecordBatch.from_arrays(
                    [row.slice(first, n), pa.array(found, pa.string()), pa.array(np.where(known, score, 0.0)),
                     pa.array(np.where(known, languages, 0).astype(np.int32))], ["row", "lang_pred", "score", "n_languages"])

    kept, inside = row_struct(docs, columns)
    return docs.select(kept, has_letter().alias("letter")).mapInArrow(predict, with_row(docs, columns, RESULT))


def report(docs: DataFrame) -> DataFrame:
    found = predicted(docs, learned(docs), ["doc_id"])
    held = F.coalesce(F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return found.select("row.doc_id", held.alias("held_out"), "lang_pred", "score", "n_languages")


def identified(docs: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """Documents with one language, or several of which one has the least share; all columns as they were."""
    found = predicted(docs, learned(docs))
    main = (F.col("n_languages") == 1) | (F.col("score") >= least_share)
    return found.where((F.col("lang_pred") != UNKNOWN) & main).select("row.*")
