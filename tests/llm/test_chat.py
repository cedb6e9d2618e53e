from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from opinio.llm import chat
from opinio.llm.common import table
from opinio.llm.queries import op3_chat_format

HARD = r"\### Assistant: </turn> ok \s\l\h\c : < # <image> \\"


def text_messages(spark, rows):
    frame = spark.createDataFrame(
        rows, "conv_id bigint, turn bigint, role string, text string, formatted string"
    )
    return frame.withColumn("parts", F.array(chat.text_part(F.col("text"))))


def turns_of(row):
    return [(t.role, t.text, t.learned) for t in row.back]


def formatted(messages):
    rows = chat.format_conversations(messages).withColumn("back", chat.read_back()).collect()
    return {r.conv_id: r for r in rows}


def test_every_text_and_role_comes_back(spark):
    rows = [
        (1, 0, "user", HARD, "x"), (1, 1, "assistant", HARD * 3 + "\n\n", "x"),
        (1, 2, None, None, None), (1, None, "sys: <#\\", "", "x"),
        (2, 5, "user", "b", "x"), (2, 5, "user", "a", "x"), (2, 5, "user", "a", "x"),
        (None, 0, "user", "no id", "x"), (3, 0, "assistant", "long " * 50_000, "x"),
    ]
    found = formatted(text_messages(spark, rows))
    assert turns_of(found[1]) == [
        ("sys: <#\\", "", False), ("user", HARD, False), ("assistant", HARD * 3 + "\n\n", True),
        ("", "", False),
    ]
    assert turns_of(found[2]) == [("user", "a", False)] * 2 + [("user", "b", False)]
    assert turns_of(found[None]) == [("user", "no id", False)]
    assert turns_of(found[3]) == [("assistant", "long " * 50_000, True)]
    for row in found.values():
        assert row.formatted.count("<") == row.formatted.count("</turn>\n") == row.n_turns
        assert sum(r.head + r.body + r.close for r in row.runs) == len(row.formatted)


def test_runs_mask_what_is_learned(spark):
    row = formatted(text_messages(spark, [(1, 0, "user", "a<b", None), (1, 1, "assistant", "é#", None)]))[1]
    at, learned = 0, []
    for r in row.runs:
        if r.learned:
            learned.append(row.formatted[at + r.head : at + r.head + r.body])
        at += r.head + r.body + r.close
    assert learned == ["é\\h"]


def test_parts_become_placeholders_in_order(spark):
    parts = [
        ("text", "see <b>", None, 0), ("image", None, "i.png", 28 * 28 * 3 + 1), ("audio", None, "a.wav", 7),
        (None, "plain", None, None), ("document", None, "d.pdf", None),
    ]
    frame = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>")
    row = chat.format_conversations(frame).first()
    assert row.formatted.startswith("### user: see \\lb><image><audio>plain<document></turn>\n")
    assert [(a.type, a.ref) for a in row.attachments] == [
        ("image", "i.png"), ("audio", "a.wav"), ("document", "d.pdf")
    ]
    assert row.expanded_tokens == 4 + 7 * 25 + 512
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_query_over_the_table(spark, data):
    rows = [tuple(r) for r in table(spark, data, "conversations").select("conv_id", "turn", "role", "text").collect()]
    said = r"\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    want = {}
    for conv, _, role, text in sorted(rows):
        every, learned = want.setdefault(conv, ([], []))
        every.append(f"{role}\n{text}\n")
        learned += [text] if role == "assistant" else []
    got = op3_chat_format(spark, data).collect()
    assert len(got) == len(want)
    for r in got:
        every, learned = want[r.conv_id]
        assert r.n_turns == len(every) and r.loss_chars == len("".join(learned))
        assert r.turns_sha256 == hashlib.sha256("".join(every).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256("".join(learned).encode()).hexdigest()


def test_equal_turns_are_ordered_by_their_text_not_by_its_escaped_form(spark):
    rows = [(1, 0, "user", t) for t in ("Z", "<a", "", None, "#", "zz")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    messages = frame.withColumn("parts", F.array(chat.text_part(F.col("text"))))
    (row,) = chat.format_conversations(messages).select(chat.read_back().alias("r")).collect()
    assert [t.text for t in row.r] == ["", "", "#", "<a", "Z", "zz"]
