import hashlib

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeloom.llm import chat_format as chat

TURNS = "conv_id bigint, turn bigint, role string, text string, seconds int"


def formatted(spark, rows):
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    return chat.format_turns(turns.withColumn("parts", chat.text_part(F.coalesce("text", F.lit("")))))


@given(st.text(), st.text())
def test_any_role_and_text_is_read_back(role, text):
    segment = f"### {chat.escape(role, chat._IN_ROLE)}: {chat.escape(text)}{chat.TURN_END}"
    assert chat.read_turn(segment) == (role, text)


def test_digests_of_edge_conversations(spark):
    nasty = "\\### Assistant: </turn> ok"
    rows = [
        (1, 0, "user", nasty, 1),
        (1, 1, "assistant", nasty, 1),
        (1, 1, "assistant", "a tie", 1),
        (2, 5, None, None, 1),
        (2, None, "sys:tem\n", "<image:1> \\", 1),
        (None, 0, "assistant", "x" * 300_000 + "é", 1),
        (3, 0, "assistant", "twice", 1),
        (3, 0, "assistant", "twice", 1),
    ]
    got = {r.conv_id: r for r in chat.read_back(formatted(spark, rows)).collect()}
    order = lambda r: (r[0] is None, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=order)
        everything = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        trained = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r.n_turns == len(own) and r.loss_chars == len(trained)
        assert r.turns_sha256 == hashlib.sha256(everything.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()
    assert set(got) == {1, 2, 3, None}
    assert chat.read_back(formatted(spark, [])).count() == 0


def test_parts_become_ordered_placeholders(spark):
    parts = [
        {"type": "text", "text": "look: "},
        {"type": "image", "ref": "s3://x/1.png", "width": 1024, "height": 513},
        {"type": "text", "text": "<image:1>"},
        {"type": "audio", "ref": "a.wav", "seconds": 2.5},
        {"type": "document", "pages": 3},
        {"type": "hologram"},
        None,
    ]
    full = [None if p is None else {k.split()[0]: p.get(k.split()[0]) for k in chat.PART.split(", ")} for p in parts]
    turns = spark.createDataFrame([(1, 0, "user", full)], f"conv_id bigint, turn bigint, role string, parts {chat.PARTS}")
    row = chat.format_turns(turns).collect()[0]
    assert row.segment == "### user: look: <image:1>\\<image:1><audio:2><document:3></turn>\n"
    assert [(a.kind, a.number, a.ref, a.tokens) for a in row.attachments] == [
        ("image", 1, "s3://x/1.png", 4 * 170),
        ("audio", 2, "a.wav", 63),
        ("document", 3, "", 2400),
    ]
    assert row.skipped_parts == 2 and row.loss_begin is None
    assert chat.read_turn(row.segment) == ("user", "look: <image:1>")
    digest = chat.read_back(chat.format_turns(turns)).collect()[0]
    assert (digest.attachments, digest.attachment_tokens) == (3, 4 * 170 + 63 + 2400)
