"""Chat formatting: typed content parts flattened to one string per conversation, with a loss mask.

A message is a list of parts: text, image, audio, document. A visitor turns each into a piece of
the formatted string: text is escaped, an attachment becomes a numbered placeholder such as
``<image 1>`` and is recorded with its reference and the number of tokens it expands to.

    <turn user>Look: <image 1></turn>
    <turn assistant>A cat.</turn>

Only markup has an unescaped ``<``: in texts and roles a backslash goes before ``\\``, ``<`` and
``>``, so whatever a text says can't end a turn, and the string can be read back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import col

#: Tokens that an attachment of each kind expands to.
EXPANDED = {"image": 576, "audio": 750, "document": 1024}
#: The marks around a turn count as tokens, too.
MARK_TOKENS = 4
#: How a text writes attachments: ![alt](ref), [audio](ref), [document](ref).
_MARKUP = re.compile(r"!\[[^\]\n]*\]\(([^()\s]+)\)|\[(audio|document)\]\(([^()\s]+)\)")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPECIAL = re.compile(r"[\\<>]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>((?:[^\\<>]|\\.|<(?:image|audio|document) \d+>)*)</turn>\n", re.S)
_PIECE = re.compile(r"<(?:image|audio|document) (\d+)>|\\(.)", re.S)

ATTACHMENT = "struct<kind:string,ref:string,raw:string,tokens:int>"


@dataclass(frozen=True)
class Text:
    text: str

    def accept(self, visitor: Flattener) -> None:
        visitor.text(self)


@dataclass(frozen=True)
class Attachment:
    """``raw`` is how the source wrote it."""

    kind: str
    ref: str
    raw: str

    def accept(self, visitor: Flattener) -> None:
        visitor.attachment(self)


def parts(text: str) -> Iterator[Text | Attachment]:
    """The typed parts of a message, in order."""
    at = 0
    for m in _MARKUP.finditer(text):
        if m.start() > at:
            yield Text(text[at : m.start()])
        yield Attachment(m[2] or "image", m[1] or m[3], m[0])
        at = m.end()
    if at < len(text):
        yield Text(text[at:])


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Flattener:
    """Visits the parts of one message in order."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.attachments: list[dict] = []
        self.tokens = 0

    def text(self, part: Text) -> None:
        self.pieces.append(escape(part.text))
        self.tokens += len(_WORD.findall(part.text))

    def attachment(self, part: Attachment) -> None:
        tokens = EXPANDED[part.kind]
        self.attachments.append({"kind": part.kind, "ref": part.ref, "raw": part.raw, "tokens": tokens})
        self.pieces.append(f"<{part.kind} {len(self.attachments)}>")
        self.tokens += tokens


def _flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("raw", pa.string()), ("tokens", pa.int32())])
    for batch in batches:
        contents, attached, tokens = [], [], []
        for text in batch.column("text").to_pylist():
            seen = Flattener()
            for part in parts(text or ""):
                part.accept(seen)
            contents.append("".join(seen.pieces))
            attached.append(seen.attachments)
            tokens.append(seen.tokens)
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("conv", "turn", "role")]
            + [pa.array(contents, pa.string()), pa.array(attached, pa.list_(kind)), pa.array(tokens, pa.int64())],
            ["conv", "turn", "role", "content", "attachments", "tokens"],
        )


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        formatted, spans, attached, tokens = [], [], [], []
        for turns in batch.column("turns").to_pylist():
            out, mask, at = [], [], 0
            for t in turns:
                head = f"<turn {escape(t['role'] or '')}>"
                if t["role"] == "assistant":
                    mask.append({"start": at + len(head), "end": at + len(head) + len(t["content"])})
                out.append(f"{head}{t['content']}</turn>\n")
                at += len(out[-1])
            formatted.append("".join(out))
            spans.append(mask)
            attached.append([t["attachments"] for t in turns])
            tokens.append(sum(t["tokens"] + MARK_TOKENS for t in turns))
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        kind = pa.struct([("kind", pa.string()), ("ref", pa.string()), ("raw", pa.string()), ("tokens", pa.int32())])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv"),
                pa.array(formatted, pa.string()),
                pa.array(spans, pa.list_(span)),
                pa.array(attached, pa.list_(pa.list_(kind))),
                pa.array(tokens, pa.int64()),
            ],
            ["conv", "formatted", "loss", "attachments", "tokens"],
        )


def format_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``loss``, ``attachments``, ``tokens``.

    ``loss`` are the spans (code points) of the assistant's contents in ``formatted``;
    ``attachments`` has a list per turn, in the order of the placeholders; ``tokens`` counts words,
    marks and what attachments expand to. Turns go by number, null first, and equal numbers by role,
    then content; repeated rows are repeated turns. A null text or role is empty; rows with a
    null conversation id are one conversation. No rows, no conversations; other columns are
    left out. A conversation becomes one string, so one task holds it; all else is per turn.
    """
    types = dict(rows.dtypes)
    schema = (
        f"conv {types[conv_id]}, turn {types[turn]}, role string, content string, attachments array<{ATTACHMENT}>, tokens long"
    )
    flat = rows.select(
        col(conv_id).alias("conv"), col(turn).alias("turn"), col(role).alias("role"), col(text).alias("text")
    ).mapInArrow(_flatten, schema)
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "content", "attachments", "tokens")))
    schema = (
        f"conv {types[conv_id]}, formatted string, loss array<struct<start:long,end:long>>,"
        f" attachments array<array<{ATTACHMENT}>>, tokens long"
    )
    return flat.groupBy("conv").agg(turns.alias("turns")).mapInArrow(_assemble, schema)


def _restore(content: str, attachments: list[dict]) -> str:
    """The message that ``content`` was flattened from."""
    return _PIECE.sub(lambda m: attachments[int(m[1]) - 1]["raw"] if m[1] else m[2], content)


def read_back(
    formatted: str, loss: list[dict], attachments: list[list[dict]]
) -> tuple[list[tuple[str, str]], list[str]]:
    """Turns (role, text) and the texts under the mask, from the formatted string alone."""
    turns, masked, at = [], [], 0
    marked = {span["start"]: span["end"] for span in loss}
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"not a turn at {at}")
        own = attachments[len(turns)]
        turns.append((unescape(m[1]), _restore(m[2], own)))
        if m.start(2) in marked:
            masked.append(_restore(formatted[m.start(2) : marked[m.start(2)]], own))
        at = m.end()
    return turns, masked
