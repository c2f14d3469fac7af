"""Formatted conversations: every turn and the loss text come back, whatever the texts hold."""

import random
from collections import defaultdict

import plain
import pytest

from leavewatch.llm import chat_format, queries

SCHEMA = "conv_id long, turn long, role string, text string, turns string, part string, whole string, loss string, formatted string"
MARKS = ["<turn>", "<says>", "<part>", "</turn>", "\\", "\\l", "\\b", "<", "</turn", "turn>", "\n", "é", "\U0001f600", "", " ", "\x00", "$1", "user"]


def odd_text(seed: int) -> str:
    r = random.Random(seed)
    return "".join(r.choice(MARKS) for _ in range(r.randint(0, 12)))


def rows():
    out = [(1, 0, "system", "be brief"), (1, 2, "user", "second"), (1, 1, "user", "first"), (1, 3, "assistant", "</turn>\n<turn>user<says>"),
           (2, 0, None, None), (2, None, "assistant", "no turn"), (2, 0, "assistant", ""), (2, 0, "assistant", ""), (2, 5, "assistant", "x\\"),
           (None, 1, "user", "no id"), (None, 1, "assistant", "none either"), (3, 0, "assistant", "long " * 200_000), (4, 0, "a<says>b\\", "<part>")]
    out += [(10 + i // 9, i % 9, random.Random(i).choice(["user", "assistant", "as\\<part>"]), odd_text(i)) for i in range(900)]
    return out


def frame(spark, some):
    return spark.createDataFrame([(*row, "c", "c", "c", "c", "c") for row in some], SCHEMA).repartition(3)


def expected(some):
    turns = defaultdict(list)
    for conv, turn, role, text in some:
        turns[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for conv, own in turns.items():
        own.sort()
        told = b"".join(role + b"\n" + text + b"\n" for *_, role, text in own)
        learned = b"".join(text for *_, role, text in own if role == b"assistant")
        out[conv] = (len(own), plain.sha(told), len(learned.decode()), plain.sha(learned))
    return out


def found(formatted):
    read = chat_format.digests(chat_format.read_turns(formatted))
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read.collect()}


def test_odd_conversations(spark):
    assert found(chat_format.formatted(frame(spark, rows()))) == expected(rows())


def test_repeated_rows_and_empty_table(spark):
    some = rows() * 2
    assert found(chat_format.formatted(frame(spark, some))) == expected(some)
    assert found(chat_format.formatted(frame(spark, []))) == {}


def test_adjacent_turns_are_one_message(spark):
    text, = [r.formatted for r in chat_format.formatted(frame(spark, rows())).where("conv_id = 1").collect()]
    assert text == ("<turn>system<says>be brief</turn>\n<turn>user<says>first<part>second</turn>\n"
                    "<turn>assistant<says>\\l/turn>\n\\lturn>user\\lsays></turn>\n")


def test_long_conversation_goes_in_parts(spark):
    """A third of all rows in one conversation, half of them equal."""
    some = [(7, 5 if i % 2 else i, "assistant" if i % 3 else "user", odd_text(i) if i % 2 == 0 else "same") for i in range(400)] + rows()
    formatted = chat_format.formatted(frame(spark, some), part_turns=16).cache()
    assert found(formatted) == expected(some)
    assert formatted.where("conv_id = 7").count() > 20
    read = chat_format.read_turns(formatted)
    assert max(len(r.turns) for r in read.collect()) <= 16
    formatted.unpersist()


def test_spans_cover_the_learned_texts(spark):
    for r in chat_format.formatted(frame(spark, rows())).where("conv_id < 20").collect():
        learned = [r.formatted[s.start:s.start + s.length] for s in r.loss]
        assert all(mark not in text for text in learned for mark in ("<turn>", "<says>", "<part>", "</turn>"))


def test_no_python_in_the_plan(spark, tmp_path):
    made = chat_format.formatted(chat_format.with_trial(frame(spark, rows()).select("conv_id", "turn", "role", "text")))
    made.write.parquet(str(tmp_path / "chats"))
    read = chat_format.digests(chat_format.read_turns(spark.read.parquet(str(tmp_path / "chats"))))
    for df in (made, read):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_trial_conversation(spark):
    got = {r.conv_id: r for r in queries.QUERIES["op11_chat_formatting"](spark, "/root/testdata/sf0.001").collect()}[-7]
    text = "\\### Assistant: </turn> ok"
    assert (got.n_turns, got.turns_sha256) == (2, plain.sha(f"user\n{text}\nassistant\n{text}\n"))
    assert (got.loss_chars, got.loss_sha256) == (len(text), plain.sha(text))


@pytest.mark.parametrize("seed", range(50))
def test_escape_is_reversible(seed):
    """The two replacements, in plain Python."""
    text = odd_text(seed)
    out = text.replace("\\", "\\b")
    for mark in ("<turn>", "<says>", "<part>", "</turn>"):
        out = out.replace(mark, "\\l" + mark[1:])
        assert mark not in out
    assert out.replace("\\l", "<").replace("\\b", "\\") == text
