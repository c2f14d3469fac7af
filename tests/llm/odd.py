"""Documents with nulls, empty and very long texts, ties, repeated rows and clashing column names."""

from __future__ import annotations

import random

from pyspark.sql import functions as F  # noqa: F401 - for the tests
from pyspark.sql import types as T

CLASHING = ["row", "spans", "bucket", "payload", "key", "removed", "n_words", "kept", "class_id", "label", "score", "page", "first",
            "_id", "_found", "_key", "_key_of", "_own", "_all", "_place", "_hash", "_among", "_part", "_start", "_size", "_text_of_the_row",
            "found", "whole", "known", "digest", "shard", "shards", "n", "no", "size", "tile", "island", "item_id", "spans", "longest"]
CLASHING = list(dict.fromkeys(CLASHING))
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
                      + [T.StructField(c, T.StringType()) for c in CLASHING])


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ba", "ce", "di", "fo", "gu", "né", "ß"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    passage, story = prose(1, 60), prose(2, 400)
    lines = "\n".join(prose(s, 6) for s in range(100, 112))
    near = story.split(" ")
    near[200] = "changed"
    out = [
        (5, story), (3, story), (9, " ".join(near)), (9_000_000_000, passage), (11, f"{prose(3, 30)} {passage} {prose(4, 20)}"),
        (12, f"{passage} {prose(5, 5)}"), (13, prose(6, 3)), (14, prose(6, 3)), (15, ""), (16, None), (17, "   \n\n "), (18, "a" * 1000),
        (19, "ab" * 400), (20, lines), (21, "one more line\n" + lines), (22, prose(7, 30_000)), (23, f"{prose(8, 10)} {prose(7, 30_000)}"),
        (24, "123 456 !!"), (25, "Ünïcode Σας İ <|endoftext|> don't"), (26, "\x00\x01 nul " * 20), (-4, passage.upper()), (27, f"x{passage}"),
        (28, "\n".join([prose(9, 4), prose(9, 4)] * 30)), (29, prose(1, 61)), (30, f"{prose(1, 12)}"), (31, prose(1, 13)),
    ]
    return out


def rows(extra: list[tuple] = ()) -> list[tuple]:
    out = []
    for i, (doc_id, text) in enumerate([*texts(), *extra]):
        out.append((doc_id, text, None if i % 3 == 0 else "xx" if i % 2 else "yy", None, None if text is None else len(text), *("c" for _ in CLASHING)))
    return out


def documents(spark, parts: int = 3):
    return spark.createDataFrame(rows(), SCHEMA).repartition(parts)


def repeated(spark):
    """Some rows twice, two texts for one id, and rows without an id."""
    return spark.createDataFrame(rows() + rows()[:6] + rows([(13, "another text of the same id"), (None, "no id at all here"), (None, None)])[-3:], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(pairs: list) -> dict:
    """doc_id -> text as the operators see it: the least text of an id, null as empty."""
    out = {}
    for doc_id, text in pairs:
        text = text or ""
        if doc_id not in out or text.encode() < out[doc_id].encode():
            out[doc_id] = text
    return out
