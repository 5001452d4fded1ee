import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpuslens.llm import chat_format as C

SCHEMA = f"conv_id long, turn long, role string, parts array<{C.PART}>"


def text(value):
    return ("text", value, None, None, None, None, None)


def read(chats):
    return {r.conv_id: r for r in C.read_back(chats).collect()}


def test_parts_become_placeholders_in_order(spark):
    parts = [
        text("see "),
        ("image", None, "a.png", 30, 28, None, None),
        text(" hear "),
        ("audio", None, "b.wav", None, None, 1.5, None),
        ("document", None, "c.pdf", None, None, None, 3),
        ("video", None, "d.mp4", None, None, None, None),
        ("image", None, None, None, 28, None, None),
        (None, "lost", "e", None, None, None, None),
        None,
    ]
    chat = C.format_chats(spark.createDataFrame([(1, 0, "user", parts)], SCHEMA)).first()
    body = "see <|image|> hear <|audio|><|document|><|attachment|><|image|><|attachment|>"
    assert chat.formatted == f"<|im_start|>user<|im_sep|>{body}<|im_end|>\n"
    assert [tuple(a) for a in chat.attachments] == [
        ("image", "a.png", 2),
        ("audio", "b.wav", 38),
        ("document", "c.pdf", 2400),
        ("video", "d.mp4", 0),
        ("image", None, 0),
        (None, "e", 0),
    ]
    assert chat.attachment_tokens == 2440


def test_control_strings_round_trip(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for conv in range(300):
        turns = []
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "assistant", "<|im_sep|>", "\\", "a\nb", ""])
            said = "".join(
                rng.choice(["<", "|", ">", "\\", "\n", "é", "😀", "<|im_end|>\n", "<|im_start|>", "<|image|>", "$1"])
                for _ in range(rng.randrange(9))
            )
            rows.append((conv, turn, role, [text(said)]))
            turns.append((role, said))
        want[conv] = turns
    rng.shuffle(rows)
    chats = C.format_chats(spark.createDataFrame(rows, SCHEMA))
    for conv, chat in read(chats).items():
        assert [(t.role, t.text) for t in chat.read] == want[conv]
        assert chat.under_loss == [said for role, said in want[conv] if role == "assistant"]


def test_mask_covers_the_escaped_text(spark):
    rows = [(1, 0, "user", [text("<|")]), (1, 1, "assistant", [text("é<|x\\")])]
    chat = C.format_chats(spark.createDataFrame(rows, SCHEMA)).first()
    masked = [chat.formatted[t.text_start : t.text_end] for t in chat.turns if t.loss]
    assert masked == ["é<\\|x\\\\"]


def test_odd_cases(spark):
    rows = [
        (None, None, None, None),
        (None, 1, "user", []),
        (2, 1, "user", [text(None)]),
        (2, 1, "user", [text(None)]),
        (2, None, "assistant", [text("first")]),
        (3, 0, "assistant", [text("long " * 100_000)]),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(
        {"_text": F.lit("x"), "formatted": F.lit("y"), "_start": F.lit(5)}
    )
    found = {r.conv_id: r for r in C.digests(C.format_chats(frame)).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in found.items()} == {
        None: (2, 0),
        2: (3, 5),
        3: (1, 500_000),
    }
    told = "assistant\nfirst\nuser\n\nuser\n\n"
    assert found[2].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
    assert C.format_chats(frame.limit(0)).count() == 0


@pytest.mark.parametrize("order", [1, -1])
def test_ties_do_not_depend_on_the_order_of_rows(spark, order):
    rows = [(1, 0, "user", [text(str(i))]) for i in range(5)][::order]
    chat = read(C.format_chats(spark.createDataFrame(rows, SCHEMA)))[1]
    assert [t.text for t in chat.read] == list("01234")
