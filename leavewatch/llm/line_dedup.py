"""Removal of repeated multi-line chunks, with DataFrame functions only.

A text's lines are cut into chunks after a line at which a rolling hash of the
last lines meets a condition that it did not meet one line before, so that an
inserted line moves no boundary further on. No chunk has one line alone: there
is no boundary after the first line, and none before the last. A copy of a
whole text of several lines thus consists of repeated chunks only. Chunks meet
by their digest as a few bytes each; those whose digest repeats are fetched and
compared byte by byte with the first. Digests that hold many chunks are dealt
to several tasks, each with the first.

Nulls: a null text is empty; an empty text is one empty line; other columns are
not read, or kept as they are. Ties between equal chunks go to the smaller
doc_id, then the earlier place. An empty table gives an empty result. A text
and its lines have to fit in one task, as in the input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leavewatch.llm.tables import one_per_id, restored
from leavewatch.sources.shared_storage import cut_lineage

ROLLED = 2      # lines in the rolling hash
DIVISOR = 4     # one line in so many meets the condition
LEAST_LINES = 2
BASE = 31
HOT = 1000      # chunks of one digest that one task takes
HOT_DIGESTS = 10_000  # digests that are dealt to several tasks, at most


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunks(text: Column, divisor: int = DIVISOR, rolled: int = ROLLED) -> Column:
    """array<struct<lines: array<string>>>, in order; joined by line feeds they are the text."""
    def line_hash(line: Column) -> Column:
        return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")

    def ends(hashed: Column) -> Column:
        def meets(i: Column) -> Column:
            rolling = F.lit(0).cast("long")
            for back in range(rolled - 1, -1, -1):
                rolling = rolling * BASE + F.when(i > back, F.get(hashed, i - 1 - back)).otherwise(0)
            return F.pmod(rolling, F.lit(divisor)) == 0

        def boundary(i: Column) -> Column:
            n = F.size(hashed)
            return (i == n) | ((i > 1) & (i < n - 1) & meets(i) & ~meets(i - 1))

        return F.filter(F.sequence(F.lit(1), F.size(hashed)), boundary)

    def cut(lines: Column) -> Column:
        return let(let(F.transform(lines, line_hash), ends), lambda at: F.transform(
            at, lambda end, j: let(F.when(j > 0, F.get(at, j - 1)).otherwise(0),
                                   lambda before: F.struct(F.slice(lines, before + 1, end - before).alias("lines")))))

    return let(F.split(text, "\n"), cut)


def joined(chunk: Column) -> Column:
    return F.array_join(chunk["lines"], "\n")


def repeated_chunks(body: DataFrame, divisor: int = DIVISOR, rolled: int = ROLLED, least_lines: int = LEAST_LINES,
                    hot: int = HOT) -> DataFrame:
    """(doc_id, removed): numbers of the chunks that equal one earlier in doc_id and place.

    Chunks of fewer lines than least_lines are never removed. A chunk whose
    digest is that of other bytes stays.
    """
    spec = F.transform(chunks(F.col("text"), divisor, rolled),
                       lambda c, j: F.struct(j.alias("no"), F.size(c["lines"]).alias("n"), F.unhex(F.md5(joined(c))).alias("digest")))
    listed = body.select("doc_id", F.explode(F.filter(spec, lambda c: c["n"] >= least_lines)).alias("c")).select("doc_id", "c.no", "c.digest")
    firsts = cut_lineage(listed.groupBy("digest").agg(F.min(F.struct("doc_id", "no")).alias("first"), F.count("*").alias("n")).where("n > 1"))
    # A digest counts as hot beyond a share of all repeated chunks, so there are HOT_DIGESTS of them at most.
    repeated = firsts.agg(F.sum("n")).head()[0] or 0
    shards = F.ceil(F.col("n") / hot).cast("int")
    spread = firsts.where(F.col("n") > max(hot, repeated // HOT_DIGESTS)).select("digest", shards.alias("shards"))

    def dealt(rows: DataFrame) -> DataFrame:
        """Rows with `shard`, by which those of a hot digest go to several tasks."""
        shard = F.coalesce(F.pmod(F.xxhash64("doc_id", "no"), F.col("shards")), F.lit(0)).cast("int")
        return rows.join(F.broadcast(spread), "digest", "left").withColumn("shard", shard).drop("shards")

    def to_all(rows: DataFrame) -> DataFrame:
        """One row per digest, for each of its shards."""
        every = F.explode(F.sequence(F.lit(0), F.coalesce("shards", F.lit(1)) - 1))
        return rows.join(F.broadcast(spread), "digest", "left").withColumn("shard", every).drop("shards")

    members = dealt(listed).join(to_all(firsts.select("digest", "first")), ["digest", "shard"]).select(
        "doc_id", F.struct("no", "digest", (F.struct("doc_id", "no") == F.col("first")).alias("is_first")).alias("m"))
    wanted = members.groupBy("doc_id").agg(F.collect_list("m").alias("wanted"))  # at most the document's chunks
    fetched = body.join(wanted, "doc_id").select("doc_id", F.explode(let(
        chunks(F.col("text"), divisor, rolled),
        lambda all_chunks: F.transform("wanted", lambda w: F.struct(w["no"].alias("no"), w["digest"].alias("digest"), w["is_first"].alias("is_first"),
                                                                    joined(F.get(all_chunks, w["no"])).alias("chunk"))))).alias("c")).select("doc_id", "c.*")
    original = fetched.where("is_first").select("digest", F.col("chunk").alias("original"))
    same = dealt(fetched.where("not is_first")).join(to_all(original), ["digest", "shard"]).where("chunk = original")
    return same.groupBy("doc_id").agg(F.collect_list("no").alias("removed"))


def deduplicated(docs: DataFrame, divisor: int = DIVISOR, rolled: int = ROLLED, least_lines: int = LEAST_LINES) -> DataFrame:
    """(doc_id, text, n_lines, n_removed, n_chunks_removed) with repeated chunks taken out of the texts.

    The first copy of a chunk, by doc_id and place, stays. A null text is
    empty and stays so; an empty text is one empty line. doc_ids are unique in
    the result (see tables.one_per_id; by tables.each_row every row is judged);
    other columns are not read.
    """
    found = _judged(one_per_id(docs.select("doc_id", "text")), divisor, rolled, least_lines)
    return found.withColumn("doc_id", restored())


def cleaned(docs: DataFrame, length_column: str = "n_chars") -> DataFrame:
    """The documents with repeated chunks taken out, less those that lost all text; other columns as they were.

    Where a text was cut, length_column, if there is one, is its new length.
    """
    whole = one_per_id(docs)
    found = _judged(whole.select("doc_id", "text"), DIVISOR, ROLLED, LEAST_LINES)
    found = found.where("n_removed = 0 or n_lines > n_removed").select("doc_id", "text", "n_removed").alias("found")
    out = whole.drop("text").alias("whole").join(found, F.col("whole.doc_id") == F.col("found.doc_id"))
    new = {"doc_id": restored("whole.doc_id"), "text": F.col("found.text")}
    if length_column in docs.columns:
        length = F.when(F.col("found.n_removed") > 0, F.length("found.text")).otherwise(F.col(f"whole.`{length_column}`"))
        new[length_column] = length.cast(docs.schema[length_column].dataType)
    return out.select(*(new.get(c, F.col(f"whole.`{c}`")).alias(c) for c in docs.columns))


def _judged(body: DataFrame, divisor: int, rolled: int, least_lines: int) -> DataFrame:
    found = body.join(repeated_chunks(body, divisor, rolled, least_lines), "doc_id", "left")

    def kept(all_chunks: Column) -> Column:
        return F.filter(all_chunks, lambda c, j: ~F.array_contains("removed", j))

    lines = lambda cs: F.aggregate(cs, F.lit(0), lambda n, c: n + F.size(c["lines"]))
    gone = F.col("removed").isNotNull()
    cleaned = let(kept(chunks(F.col("text"), divisor, rolled)),
                  lambda cs: F.struct(F.array_join(F.transform(cs, joined), "\n").alias("text"), lines(cs).alias("n")))
    n_lines = F.length(F.col("text")) - F.length(F.translate("text", "\n", "")) + 1
    return (found.select("doc_id", "text", n_lines.alias("n_lines"), F.when(gone, F.size("removed")).otherwise(0).alias("n_chunks_removed"),
                         F.when(gone, cleaned).alias("cleaned"))
            .select("doc_id", F.when(F.col("cleaned").isNotNull(), F.col("cleaned.text")).otherwise(F.col("text")).alias("text"),
                    F.col("n_lines").cast("long").alias("n_lines"),
                    F.when(F.col("cleaned").isNotNull(), F.col("n_lines") - F.col("cleaned.n")).otherwise(0).cast("long").alias("n_removed"),
                    F.col("n_chunks_removed").cast("long").alias("n_chunks_removed")))
