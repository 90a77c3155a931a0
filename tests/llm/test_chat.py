"""Chat formatting: exact round trips, masks, placeholders, odd rows."""

import random

from pyspark.sql import functions as F

from tallyframe.llm import chat

SCHEMA = f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>, start int, pieces string"


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def formatted(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    out = chat.format_chat(frame).withColumn("read", chat.read_chat(F.col("formatted")))
    out = out.withColumn("trained", chat.trained_texts(F.col("formatted"), F.col("loss_spans")))
    return {r.conv_id: r for r in out.collect()}


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(1)
    bits = ["<", "|", "\\", "turn", "|>", "<|", "</s>", "<s>", "[INST]", "[/INST]", "[", "<|end|>", "<\\|end|>", "\n", " ", "é", "😀", "$1", "a"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 6)):
            text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
            role = rng.choice(["user", "assistant", "system", "".join(rng.choice(bits) for _ in range(3))])
            rows.append((conv, turn, role, [part("text", text)]))
    got = formatted(spark, rows)
    for conv in range(60):
        own = [(r[2], r[3][0][1]) for r in rows if r[0] == conv]
        assert [(t.role, t.text) for t in got[conv].read] == own
        assert got[conv].trained == [text for role, text in own if role == "assistant"]
        assert got[conv].formatted.count("<|turn|>") == len(own)


def test_round_trip_of_parts_that_make_up_marks(spark):
    """One to four parts a turn, attachments between them: no text reads as a mark, whatever parts it comes in."""
    rng = random.Random(2)
    bits = ["<", "|", "\\", "end", "|>", "<|", "</", "s>", "[IN", "ST]", "[", "/INST]", "image:1", "a", ""]
    rows = [(0, 0, "user", [part("text", "<"), part("text", "|end|>x")]), (0, 1, "user", [part("text", "<\\"), part("text", "|x")])]
    for conv in range(1, 60):
        for turn in range(rng.randrange(1, 5)):
            parts = []
            for _ in range(rng.randrange(1, 5)):
                text = "".join(rng.choice(bits) for _ in range(rng.randrange(4)))
                parts.append(part("image", ref="r") if rng.random() < 0.2 else part("text", text))
            rows.append((conv, turn, rng.choice(["user", "assistant", "<|", "["]), parts))
    got = formatted(spark, rows)
    for conv in range(60):
        own, number = [], 0
        for r in rows:
            if r[0] == conv:
                said = ""
                for p in r[3]:
                    number += p[0] == "image"
                    said += f"<|image:{number}|>" if p[0] == "image" else p[1]
                own.append((r[2], said))
        assert [(t.role, t.text) for t in got[conv].read] == own
        assert got[conv].formatted.count("<|turn|>") == got[conv].formatted.count("<|end|>") == len(own)
        marks = [f"<|image:{a.number}|>" for a in got[conv].attachments]
        assert len(marks) == number
        assert all(got[conv].formatted[a.start :].startswith(m) for a, m in zip(got[conv].attachments, marks))


def test_parts_become_placeholders(spark):
    rows = [
        (1, 1, "user", [part("text", "see "), part("image", ref="a.png", width=29, height=56), part("text", " and <|image:9|> "), None]),
        (1, 0, "system", None),
        (1, 2, "assistant", [part("audio", ref="b.wav", seconds=2.5), part("document", ref="c.pdf", pages=3), part("text", "ok")]),
        (1, 3, "user", [part("image", ref="d.png"), part("note", "kept"), part(None, "too")]),
    ]
    (row,) = formatted(spark, rows).values()
    assert [(t.role, t.text) for t in row.read] == [
        ("system", ""),
        ("user", "see <|image:1|> and <|image:9|> "),
        ("assistant", "<|audio:2|><|document:3|>ok"),
        ("user", "<|image:4|>kepttoo"),
    ]
    assert [(a.number, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (1, "image", "a.png", 2 * 2),
        (2, "audio", "b.wav", 32),
        (3, "document", "c.pdf", 768),
        (4, "image", "d.png", 1),
    ]
    assert row.attachment_tokens == 4 + 32 + 768 + 1
    for a in row.attachments:
        mark = f"<|{a.kind}:{a.number}|>"
        assert row.formatted[a.start : a.start + len(mark)] == mark
    (span,) = row.loss_spans
    assert row.formatted[span.start : span.start + span.length] == "<|audio:2|><|document:3|>ok"


def test_odd_rows(spark):
    same = [part("text", "x")]
    rows = [(1, 0, None, same), (1, 0, None, same), (1, None, "z", [part("text", None)]), (None, 5, "assistant", []), (2, 1, "b", same), (2, 1, "a", same)]
    rows.append((3, 0, "assistant", [part("text", "long " * 100_000)]))
    got = formatted(spark, rows)
    assert [(t.role, t.text) for t in got[1].read] == [("", "x"), ("", "x"), ("z", "")]
    assert got[None].trained == [""] and [t.role for t in got[2].read] == ["a", "b"]
    assert len(got[3].trained[0]) == 500_000
    assert formatted(spark, []) == {}
