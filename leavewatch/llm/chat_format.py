"""Conversations as marked text with a loss mask, by DataFrame functions alone.

The rows of a conversation are collected as structs and sorted by turn, then
role, then text. Adjacent turns of one role become one message, in which a mark
keeps them apart, so that reading back gives every turn:

    <turn>user<says>first text<part>second text</turn>

Inside roles and texts a backslash is written as ``\\b`` and the first sign of
each control string as ``\\l``; control strings hold no backslash and have that
sign at their start only, so no text can make one, nor be half of one.

A conversation of more than PART_TURNS rows is formatted in parts of at most
that many, each a row, so no task collects more; messages do not reach across
parts. Rows of long conversations are numbered by a range-partitioned sort.

Nulls: a null text or role is empty; null turns come first; rows without a
conv_id are one conversation. Rows that repeat stay, each a turn. An empty
table gives an empty result. A part has to fit in one value, as long texts
have to in the input: 2 GB is Spark's limit. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leavewatch.operators.ranking import with_position
from leavewatch.sources.shared_storage import cut_lineage

TURN, SAYS, PART, END = "<turn>", "<says>", "<part>", "</turn>"
LEARNED = "assistant"  # the role whose texts are under the loss mask
PART_TURNS = 1024

_MESSAGES = "array<struct<role:string,texts:array<string>>>"
_SPANS = "array<struct<start:int,length:int>>"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    for mark in (TURN, SAYS, PART, END):
        text = F.replace(text, F.lit(mark), F.lit("\\l" + mark[1:]))
    return text


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _merged(turns: Column) -> Column:
    """Sorted turns as messages: runs of turns of one role."""
    def add(messages: Column, turn: Column) -> Column:
        last = F.try_element_at(messages, F.lit(-1))
        grown = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        new = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        return F.when((F.size(messages) > 0) & (last["role"] == turn["role"]),
                      F.concat(F.slice(messages, 1, F.size(messages) - 1), F.array(grown))
                      ).otherwise(F.concat(messages, F.array(new))).cast(_MESSAGES)

    return F.aggregate(turns, F.array().cast(_MESSAGES), add)


def _pieces(messages: Column, learned: str) -> Column:
    """The strings that the formatted text is made of, and whether each is learned."""
    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_message(message: Column) -> Column:
        head = F.concat(F.lit(TURN), escaped(message["role"]), F.lit(SAYS))
        texts = F.transform(message["texts"], lambda text, i: F.array(
            piece(F.when(i > 0, F.lit(PART)).otherwise(F.lit("")), F.lit(False)),
            piece(escaped(text), message["role"] == learned)))
        return F.concat(F.array(piece(head, F.lit(False))), F.flatten(texts), F.array(piece(F.lit(END + "\n"), F.lit(False))))

    return F.flatten(F.transform(messages, of_message))


def _spans(pieces: Column) -> Column:
    """(start, length) in code points of every learned piece, in order."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def add(state: Column, piece: Column) -> Column:
        size = F.length(piece["text"])
        span = F.array(F.struct(state["at"].alias("start"), size.alias("length"))).cast(_SPANS)
        return F.struct((state["at"] + size).alias("at"),
                        F.when(piece["loss"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(pieces, zero, add, lambda state: state["spans"])


def _formatted(rows: DataFrame, keys: list[str], learned: str) -> DataFrame:
    turns = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    pieces = turns.select(*keys, _pieces(_merged(F.col("turns")), learned).alias("pieces"))
    return pieces.select(*keys, F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
                         _spans(F.col("pieces")).alias("loss"))


def formatted(conversations: DataFrame, part_turns: int = PART_TURNS, learned: str = LEARNED) -> DataFrame:
    """(conv_id, part, whole, formatted, loss): marked text and the spans (start, length) under the loss mask.

    ``whole`` says that the conversation is this one row; of others the parts
    ascend with the turns. Texts are shuffled once, those of long
    conversations once more for their order.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_turns)
    long = cut_lineage(sizes.select(F.col("conv_id").alias("_long")))
    one = rows
    is_long = F.col("conv_id").eqNullSafe(F.col("_long"))
    some_long = not long.isEmpty()
    if some_long:
        one = rows.join(long, is_long, "left_anti")
    out = _formatted(one, ["conv_id"], learned).select(
        "conv_id", F.lit(0).cast("long").alias("part"), F.lit(True).alias("whole"), "formatted", "loss")
    if some_long:
        many = rows.join(long, is_long, "left_semi").withColumn("_among", F.monotonically_increasing_id())
        placed = with_position(many, "conv_id", "turn", "role", "text", "_among", name="place")
        parts = placed.withColumn("part", F.floor(F.col("place") / part_turns))
        out = out.unionByName(_formatted(parts, ["conv_id", "part"], learned).select(
            "conv_id", "part", F.lit(False).alias("whole"), "formatted", "loss"))
    return out


def read_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, part, whole, turns, loss_text, formatted_chars) from formatted rows: turns of (role, text), and all text under the mask."""
    def of_message(message: Column) -> Column:
        role = unescaped(F.substr(F.substring_index(message, SAYS, 1), F.lit(len(TURN) + 1)))
        texts = F.split(F.substring_index(message, SAYS, -1), PART)
        return F.transform(texts, lambda text: F.struct(role.alias("role"), unescaped(text).alias("text")))

    messages = F.split("formatted", END + "\n")  # ends with an empty string, behind the last mark
    turns = F.flatten(F.transform(F.slice(messages, 1, F.size(messages) - 1), of_message))
    learned = F.transform("loss", lambda s: unescaped(F.substr(F.col("formatted"), s["start"] + 1, s["length"])))
    return rows.select("conv_id", "part", "whole", turns.alias("turns"), F.array_join(learned, "").alias("loss_text"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def digests(read: DataFrame) -> DataFrame:
    """One row per conversation: turns, their digest, length and digest of the learned text, length of the formatted one."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.select("conv_id", "part", "whole", F.size("turns").cast("long").alias("n_turns"), told.alias("told"),
                        "loss_text", "formatted_chars")
    one = parts.where("whole").drop("part", "whole")
    ordered = F.sort_array(F.collect_list(F.struct("part", "told", "loss_text")))
    many = (parts.where("NOT whole").groupBy("conv_id")
            .agg(F.sum("n_turns").alias("n_turns"), F.sum("formatted_chars").alias("formatted_chars"), ordered.alias("parts"))
            .select("conv_id", "n_turns", F.array_join("parts.told", "").alias("told"),
                    F.array_join("parts.loss_text", "").alias("loss_text"), "formatted_chars"))
    return one.unionByName(many).select(
        "conv_id", "n_turns", F.sha2("told", 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def with_trial(conversations: DataFrame) -> DataFrame:
    """The table, and conversation -7 whose texts hold a backslash and a control string."""
    text = "\\### Assistant: </turn> ok"
    trial = F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"),
                               F.lit(role).alias("role"), F.lit(text).alias("text"))
                      for turn, role in enumerate(("user", "assistant"))])
    columns = [F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
               F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")]
    return conversations.select(*columns).unionByName(conversations.sparkSession.range(1).select(F.inline(trial)))
