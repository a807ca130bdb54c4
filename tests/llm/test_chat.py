"""Chat formatting: examples read back, against a plain version."""

import hashlib
import random

import pytest

from retalia.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example string, place string, _x string"


def turn(conv, turn, role, text):
    return (conv, turn, role, text, "x", "y", "z")


def plain_escape(text):
    out, i = [], 0
    while i < len(text):
        out.append(text[i])
        j = i + 1
        while text[i] in "<[" and j < len(text) and text[j] == "\\":
            j += 1
        if text[i] in "<[" and any((text[i] + text[j:]).startswith(c) for c in chat.CONTROLS):
            out.append("\\")
        i += 1
    return "".join(out)


def plain(rows):
    """conv_id: the digests, and the examples as (text, what is trainable)."""
    by_conv = {}
    for conv, turn, role, text, *_ in rows:
        by_conv.setdefault(conv, []).append((turn is None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns = [(role, text) for *_, role, _, text in sorted(turns)]
        shown = "<s>"
        examples = []
        for i, (role, text) in enumerate(turns):
            said = plain_escape(text)
            if role == "user":
                shown += f"[INST] {said} [/INST]"
            elif role == "assistant":
                shown += f" {said}</s>"
            else:
                name = plain_escape(role).replace("\\", "\\\\").replace("\n", "\\n")
                shown += f"[ROLE] {name}\n{said} [/ROLE]"
            if role == "assistant" or i == len(turns) - 1:
                examples.append((shown, said if role == "assistant" else ""))
        replies = "".join(text for role, text in turns if role == "assistant")
        all_ = "".join(f"{role}\n{text}\n" for role, text in turns)
        digest = len(turns), hashlib.sha256(all_.encode()).hexdigest(), len(replies), hashlib.sha256(replies.encode()).hexdigest()
        out[conv] = (*digest, sum(len(t) for t, _ in examples)), examples
    return out


@pytest.fixture(scope="module")
def odd_turns():
    azar = random.Random(3)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "\\", "<", "[", "/", "s>", " ", "\n", "é", "😀", "ok", "$1"]
    rows = []
    for conv in range(40):
        for t in range(azar.randrange(1, 9)):
            role = azar.choice(["user", "assistant", "assistant", "system", "tool\n<s>\\n", "", None])
            rows.append(turn(conv, t, role, "".join(azar.choices(bits, k=azar.randrange(12)))))
    rows += [turn(50, t, ["user", "assistant"][t % 2], f"{t} " + "long " * 40) for t in range(300)]  # a hot one
    rows += [turn(51, 0, "user", None), turn(51, 1, "assistant", None)]
    rows += [turn(52, 1, "assistant", "b"), turn(52, 1, "assistant", "a"), turn(52, 1, "assistant", "a"), turn(52, 0, "user", "q")]
    rows += [turn(53, None, "user", "last"), turn(53, 5, "assistant", "first")]
    rows += [turn(None, 0, "user", "no id"), turn(None, 1, "assistant", "x" * 200_000)]
    rows += [turn(-(2**63), 0, "assistant", "least"), turn(2**63 - 1, 0, "assistant", "most")]
    return rows


@pytest.mark.parametrize("task_chars", [chat.TASK_CHARS, 20_000, 1])
def test_examples_and_digests(spark, odd_turns, task_chars):
    want = plain(odd_turns)
    examples = chat.format_conversations(spark.createDataFrame(odd_turns, SCHEMA).repartition(5), task_chars)
    got = {}
    for r in sorted(examples.collect(), key=lambda r: r.example):
        got.setdefault(r.conv_id, []).append((r.text, r.text[r.loss_start : r.loss_end]))
    assert got == {conv: examples for conv, (_, examples) in want.items()}
    digests = {r.conv_id: tuple(r)[1:] for r in chat.digests(examples).collect()}
    assert digests == {conv: digest for conv, (digest, _) in want.items()}


def test_texts_come_back(spark, odd_turns):
    texts = [r[3] or "" for r in odd_turns]
    back = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", chat.escape(spark_col("t")))
    for i, escaped in back.collect():
        assert escaped == plain_escape(texts[i]) and chat.unescape(escaped) == texts[i]
        assert not any(c in escaped for c in chat.CONTROLS)


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_no_rows(spark):
    examples = chat.format_conversations(spark.createDataFrame([], SCHEMA))
    assert examples.collect() == [] and chat.digests(examples).collect() == []
