import hashlib

import corpus
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from packetloom.llm import chat_format
from packetloom.llm.chat_format import escape, unescape

CONTROLS = ["<|", "</s>", "<s>", "[INST]", "[/INST]", "<|end|>", "<|turn|>", "<|image:0|>", "\\", "\\\\", "<", "|", "[", "/"]


@given(st.lists(st.sampled_from([*CONTROLS, "a", "\n", "é", "s>"]), max_size=12).map("".join))
def test_escapes_are_reversible_and_hide_control_strings(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


def conversations(spark):
    rows = [(1, 0, "user", "hi <|end|>"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "user", None), (1, 3, "assistant", "\\<|")]
    rows += [(2, 1, "assistant", ""), (2, 0, None, "x"), (2, None, "assistant", "first"), (None, 0, "assistant", "no id"), (3, 0, "user", "é" * 5000)]
    rows += [(4, 0, "user", "b"), (4, 0, "user", "a"), (4, 0, "user", "a")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))


def test_read_back_equals_the_turns(spark):
    turns = conversations(spark)
    found = {r.conv_id: r for r in chat_format.read_back(chat_format.format_turns(turns.withColumn("parts", chat_format.text_part(F.col("text"))))).collect()}
    given_turns = {}
    order = lambda r: tuple((v is not None, v) for v in (r.turn, r.role, r.text))
    for r in sorted(turns.collect(), key=lambda r: [(a, str(b) if isinstance(b, str) else b or 0) for a, b in order(r)]):
        given_turns.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    assert set(found) == set(given_turns)
    for conv, rows in given_turns.items():
        assert found[conv].n_turns == len(rows)
        assert found[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest()
        loss = "".join(t for r, t in rows if r == "assistant")
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_parts_become_placeholders_with_attachments(spark):
    parts = [
        {"kind": "text", "text": "see <|"}, {"kind": "image", "ref": "a.png", "units": 4}, {"kind": "text", "text": "and"},
        {"kind": "audio", "ref": "b.wav", "units": 10}, None, {"kind": "document", "ref": "c.pdf"},
    ]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [{"kind": "image", "ref": "d.png"}])]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_format.PART.simpleString()}>")
    first, second = chat_format.format_turns(turns).orderBy("turn_index").collect()
    assert first.formatted == "<|turn|>user<|role|>see <\\|<|image:0|>and<|audio:1|><|document:2|><|end|>"
    whole = first.formatted + second.formatted
    assert [(a.kind, a.ref, a.n_tokens) for a in first.attachments] == [("image", "a.png", 1024), ("audio", "b.wav", 250), ("document", "c.pdf", 512)]
    for a in [*first.attachments, *second.attachments]:
        assert whole[a.position :].startswith(f"<|{a.kind}:")
    assert whole[second.mask_start : second.mask_end] == "<|image:3|>" and first.mask_start is None


def test_unknown_parts_are_an_error():
    with pytest.raises(ValueError, match="must be"):
        chat_format.Flattener(0).visit({"kind": "video"})
    assert chat_format.parts_from_json('["a", {"kind": "image", "ref": "r"}]')[0] == {"kind": "text", "text": "a"}


def test_empty_table(spark):
    turns = corpus.empty(conversations(spark)).withColumn("parts", chat_format.text_part(F.col("text")))
    assert chat_format.read_back(chat_format.format_turns(turns)).count() == 0
