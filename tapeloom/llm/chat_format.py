"""Chat formatting of turns made of typed content parts.

A turn is a role and a list of parts (text, image, audio, document). A visitor walks the parts in order:
text is escaped, any other part becomes a numbered placeholder, and its reference and the number of
tokens the placeholder stands for are recorded. A turn is written as

    ### <role>: <content></turn>\\n

The control strings begin with `#` or `<`; in texts these characters and the escape character `\\` get
a `\\` before them (in roles also `:`), so a text can hold any control string and is read back exactly.

Turns are formatted row by row: a conversation is the concatenation of its turns by (turn, role, content)
and is never gathered in one cell. Reading back streams over the sorted turns with constant memory, so one
conversation may hold any share of the rows.

Null texts, roles and references are empty; null parts, and parts of an unknown type, are skipped and
counted in `skipped_parts`. Rows with a null conversation id form one conversation. Equal turns are put in
the order of role and content; repeated rows are repeated turns. Empty table: empty result.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "type string, text string, ref string, width int, height int, seconds double, pages int"
PARTS = f"array<struct<{PART}>>"
ATTACHMENT = "kind string, number int, ref string, tokens bigint"
FORMATTED = (
    "conv_id bigint, turn bigint, role string, segment string, loss_begin bigint, loss_end bigint,"
    f" attachments array<struct<{ATTACHMENT}>>, skipped_parts bigint"
)
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint, attachments bigint, attachment_tokens bigint"
)
TURN_END = "</turn>\n"
TRAINED_ROLE = "assistant"

_IN_TEXT = re.compile(r"[\\#<]")
_IN_ROLE = re.compile(r"[\\#<:]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\]|\\.)*)</turn>\n", re.DOTALL)
_PLACEHOLDER = re.compile(r"\\.|<(image|audio|document):\d+>", re.DOTALL)


def escape(text: str, special: re.Pattern = _IN_TEXT) -> str:
    return special.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class PartVisitor:
    """Flattens the parts of one turn; the token costs are parameters."""

    def __init__(self, tile: int = 512, tokens_per_tile: int = 170, tokens_per_second: float = 25, tokens_per_page: int = 800):
        self.tile, self.tokens_per_tile = tile, tokens_per_tile
        self.tokens_per_second, self.tokens_per_page = tokens_per_second, tokens_per_page
        self.content: list[str] = []
        self.attachments: list[dict] = []
        self.skipped = 0

    def visit(self, part: dict | None) -> None:
        method = getattr(self, f"visit_{part['type']}", None) if part and part["type"] else None
        if method is None:
            self.skipped += 1
        else:
            method(part)

    def visit_text(self, part):
        self.content.append(escape(part["text"] or ""))

    def visit_image(self, part):
        tiles = math.ceil((part["width"] or 1) / self.tile) * math.ceil((part["height"] or 1) / self.tile)
        self._attach("image", part, tiles * self.tokens_per_tile)

    def visit_audio(self, part):
        self._attach("audio", part, math.ceil((part["seconds"] or 0) * self.tokens_per_second))

    def visit_document(self, part):
        self._attach("document", part, (part["pages"] or 1) * self.tokens_per_page)

    def _attach(self, kind, part, tokens):
        number = len(self.attachments) + 1
        self.content.append(f"<{kind}:{number}>")
        self.attachments.append({"kind": kind, "number": number, "ref": part["ref"] or "", "tokens": tokens})


def text_part(text: Column) -> Column:
    """A list of one text part."""
    fields = {"type": F.lit("text"), "text": text}
    names = [field.split()[0] for field in PART.split(", ")]
    return F.array(F.struct(*[fields.get(name, F.lit(None)).alias(name) for name in names])).cast(PARTS)


def _format(batches):
    for batch in batches:
        rows = []
        for conv, turn, role, parts in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "parts")), strict=True):
            visitor = PartVisitor()
            for part in parts or []:
                visitor.visit(part)
            role, content = role or "", "".join(visitor.content)
            head = f"### {escape(role, _IN_ROLE)}: "
            trained = role == TRAINED_ROLE
            rows.append(
                {
                    "conv_id": conv,
                    "turn": turn,
                    "role": role,
                    "segment": f"{head}{content}{TURN_END}",
                    "loss_begin": len(head) if trained else None,
                    "loss_end": len(head) + len(content) if trained else None,
                    "attachments": visitor.attachments,
                    "skipped_parts": visitor.skipped,
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema=_FORMATTED)


_FORMATTED = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("segment", pa.string())]
    + [("loss_begin", pa.int64()), ("loss_end", pa.int64())]
    + [
        ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("number", pa.int32()), ("ref", pa.string()), ("tokens", pa.int64())]))),
        ("skipped_parts", pa.int64()),
    ]
)


def format_turns(turns: DataFrame) -> DataFrame:
    """Formatted turns (`FORMATTED`) of rows (`conv_id`, `turn`, `role`, `parts`); a row for each row.

    `loss_begin` and `loss_end` bound the trained text in `segment` (code points); null in turns of other roles.
    """
    return turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), "parts"
    ).mapInArrow(_format, FORMATTED)


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders of attachments have no text."""
    match = _TURN.fullmatch(segment)
    if match is None:
        raise ValueError(f"not a formatted turn: {segment[:80]!r}")
    return unescape(match[1]), unescape(_PLACEHOLDER.sub(lambda m: "" if m[1] else m[0], match[2]))


class _Reader:
    """Digests of the conversation being read."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.attachments, self.tokens = 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment, begin, end, attachments):
        role, text = read_turn(segment)
        self.turns += 1
        self.chars += len(segment)
        self.all.update(f"{role}\n{text}\n".encode())
        self.attachments += len(attachments)
        self.tokens += sum(a["tokens"] for a in attachments)
        if begin is not None:
            masked = unescape(_PLACEHOLDER.sub(lambda m: "" if m[1] else m[0], segment[begin:end]))
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self):
        return {
            "conv_id": self.conv_id,
            "n_turns": self.turns,
            "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
            "attachments": self.attachments,
            "attachment_tokens": self.tokens,
        }


def _read(batches):
    reader = None
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64())]
        + [("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("attachments", pa.int64()), ("attachment_tokens", pa.int64())]
    )
    for batch in batches:
        done = []
        names = ("conv_id", "segment", "loss_begin", "loss_end", "attachments")
        for conv, *rest in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if reader is None or reader.conv_id != conv:
                if reader is not None:
                    done.append(reader.row())
                reader = _Reader(conv)
            reader.add(*rest)
        yield pa.RecordBatch.from_pylist(done, schema=schema)
    if reader is not None:
        yield pa.RecordBatch.from_pylist([reader.row()], schema=schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests (`DIGESTS`) of each conversation, from its formatted turns alone."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "segment"]
    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions(*order)
        .select("conv_id", "segment", "loss_begin", "loss_end", "attachments")
        .mapInArrow(_read, DIGESTS)
    )
