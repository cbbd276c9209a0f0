"""Formatting of conversations with typed content parts.

A turn is a list of parts: text, image, audio or document. A visitor flattens
the parts in order: texts are escaped and stand for themselves, every other
part becomes one placeholder, with an attachment that records what it refers
to and the tokens it expands to. The template marks the turns; texts cannot
break out of it, because the escape character and all control strings in them
are escaped reversibly.

The result has one row per turn with its piece of the conversation's output
and the offset of that piece, so a conversation of any length is never held
whole: rows are shuffled by conversation, sorted by turn, and streamed.
``read_back`` turns the output into turns and loss text again.

Null roles, texts and parts count as empty. Null turns come first; turns with
equal numbers are ordered by role, then by the JSON text of their parts; equal
rows stay. A null conv_id is one conversation. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from packetloom.llm.arrow import batch, fields

# The template, and the control strings that texts may not hold unescaped.
TURN, ROLE_END, TURN_END = "<|turn|>", "<|role|>", "<|end|>"
CONTROL = re.compile(r"\\|<(?=\||/?s>)|\[(?=/?INST\])")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
PLACEHOLDER = re.compile(r"<\|(image|audio|document):\d+\|>")
TRAINED_ROLE = "assistant"
# Tokens that one unit of a part expands to: image tiles, audio seconds, document pages.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}

PART = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("units", T.IntegerType()),
    ]
)
ATTACHMENT = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("position", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)


def escape(text: str) -> str:
    """Put the escape character before itself and into control strings."""
    return CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else m[1], text)


def text_part(text: Column) -> Column:
    """A list of parts that holds one text."""
    null = F.lit(None)
    return F.array(
        F.struct(F.lit("text").alias("kind"), text.alias("text"), null.cast("string").alias("ref"), null.cast("int").alias("units"))
    )


@dataclass
class Flattener:
    """Visits the parts of one turn in order."""

    first_attachment: int
    pieces: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    length: int = 0

    def visit(self, part: dict) -> None:
        visitor = getattr(self, f"visit_{part.get('kind')}", None)
        if visitor is None:
            raise ValueError(f"a part must be text, image, audio or document, not {part.get('kind')!r}")
        visitor(part)

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.length += len(piece)

    def visit_text(self, part: dict) -> None:
        self.add(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        self.attach(part, "image")

    def visit_audio(self, part: dict) -> None:
        self.attach(part, "audio")

    def visit_document(self, part: dict) -> None:
        self.attach(part, "document")

    def attach(self, part: dict, kind: str) -> None:
        tokens = TOKENS_PER_UNIT[kind] * max(1, part.get("units") or 1)
        self.attachments.append({"kind": kind, "ref": part.get("ref"), "position": self.length, "n_tokens": tokens})
        self.add(f"<|{kind}:{self.first_attachment + len(self.attachments) - 1}|>")


def format_turns(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts") -> DataFrame:
    """One row per turn: its piece of the output, offsets in the conversation's output, loss mask and attachments.

    ``mask_start`` and ``mask_end`` are code points of the output that are trained on, null for other roles.
    """
    schema = T.StructType(
        fields(turns, key)
        + [
            T.StructField("turn_index", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("formatted", T.StringType()),
            T.StructField("mask_start", T.LongType()),
            T.StructField("mask_end", T.LongType()),
            T.StructField("attachments", T.ArrayType(ATTACHMENT)),
        ]
    )
    arrow = to_arrow_schema(schema)

    def format_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, index, offset, attached, begun = None, 0, 0, 0, False
        for b in batches:
            rows = []
            for conv, name, content in zip(*(b.column(i).to_pylist() for i in range(3))):
                if not begun or conv != current:
                    current, index, offset, attached, begun = conv, 0, 0, 0, True
                flat = Flattener(attached)
                for part in content or ():
                    if part is not None:
                        flat.visit(part)
                head = f"{TURN}{escape(name or '')}{ROLE_END}"
                body = "".join(flat.pieces)
                formatted = head + body + TURN_END
                start = offset + len(head)
                trained = name == TRAINED_ROLE
                placed = [a | {"position": start + a["position"]} for a in flat.attachments]
                rows.append((conv, index, offset, formatted, start if trained else None, start + len(body) if trained else None, placed))
                index, offset, attached = index + 1, offset + len(formatted), attached + len(placed)
            yield batch(arrow, [list(c) for c in zip(*rows)] if rows else [[] for _ in arrow])

    ordered = (
        turns.select(
            F.col(key).alias("_key"),
            F.col(role).alias("_role"),
            F.col(parts).cast(T.ArrayType(PART)).alias("_parts"),
            F.col(turn).alias("_turn"),
        )
        .repartition("_key")
        .sortWithinPartitions("_key", "_turn", "_role", F.to_json("_parts"))
        .select("_key", "_role", "_parts")
    )
    return ordered.mapInArrow(format_batches, schema)


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and body, both still escaped, of one turn's output."""
    if not formatted.startswith(TURN) or not formatted.endswith(TURN_END):
        raise ValueError("not the output of one turn")
    role, _, body = formatted[len(TURN) : -len(TURN_END)].partition(ROLE_END)
    return role, body


def read_back(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """What the output of ``format_turns`` says, one row per conversation, with digests of turns and loss text.

    It reads the rows in the order they were made in, so it needs no shuffle.
    """
    schema = T.StructType(
        fields(formatted, key)
        + [
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def done() -> list:
            conv, n, turns, chars, loss, total = state
            return [conv, n, turns.hexdigest(), chars, loss.hexdigest(), total]

        for b in batches:
            rows = []
            for conv, index, offset, text, mask_start, mask_end in zip(*(b.column(i).to_pylist() for i in range(6))):
                if index == 0:
                    if state is not None:
                        rows.append(done())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, body = parse_turn(text)
                state[1] += 1
                state[2].update(f"{unescape(role)}\n{unescape(PLACEHOLDER.sub('', body))}\n".encode())
                if mask_start is not None:
                    masked = unescape(PLACEHOLDER.sub("", text[mask_start - offset : mask_end - offset]))
                    state[3] += len(masked)
                    state[4].update(masked.encode())
                state[5] += len(text)
            if rows:
                yield batch(arrow, [list(c) for c in zip(*rows)])
        if state is not None:
            yield batch(arrow, [[v] for v in done()])

    columns = [key, "turn_index", "start", "formatted", "mask_start", "mask_end"]
    return formatted.select(*columns).mapInArrow(read_batches, schema)


def parts_from_json(text: str | None) -> list[dict]:
    """Parts from a JSON list of strings and objects, as chat services write them."""
    found = json.loads(text) if text else []
    return [{"kind": "text", "text": p} if isinstance(p, str) else p for p in found]
