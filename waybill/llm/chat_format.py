r"""Chat formatting that survives its own grammar.

A formatted conversation is a row of turns without separators:

    [INST] body [/INST]              user
     body</s>                        assistant, led by one space
    [SYS] body [/SYS]                system
    [ROLE] body [TEXT] body [/ROLE]  any other role

In a body, ``\`` before ``\``, ``[`` or ``<`` makes that character plain text.
A turn is rendered without escapes first and read back by a deterministic
parser. If role and text do not come back identical, its control strings are
escaped, and if that is not enough (backslashes in the text), every ``\``, ``[``
and ``<``, which always reads back.

Turns are rendered where they lie. To read back, they are shuffled by
conversation and sorted by turn, and the parser runs over the joined text of a
conversation piece by piece: memory is bounded by a block of turns, also for a
conversation that holds a third of all rows, whose digest is one sequence by
its nature.

Special cases: a null text is empty, a null role is the empty role. A null
conversation id is a conversation of its own, a null turn comes first. Turns of
equal number follow each other by role and text, repeated rows included. An
empty table has no conversations. Extra columns are handed through by
``format_turns``; columns called like an added one are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import free_name, quoted

_FRAMES = {
    "user": ("[INST] ", " [/INST]"),
    "assistant": (" ", "</s>"),
    "system": ("[SYS] ", " [/SYS]"),
}
_OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
_CONTROL = re.compile(r"</?s>|\[/?(?:INST|SYS|ROLE)\]|\[TEXT\]")
_SPECIAL = re.compile(r"[\\\[<]")
_LEXEME = re.compile(r"\\[\\\[<]|</?s>|\[/?(?:INST|SYS|ROLE)\]|\[TEXT\]")
_ESCAPED = re.compile(r"\\([\\\[<])")
_BLOCK = 1 << 20  # characters that are parsed together

_ADDED = ["piece", "escapes", "loss_start", "loss_length"]


class GrammarError(ValueError):
    """The text is no row of turns."""


def escaped(text: str, level: int) -> str:
    if level == 0:
        return text
    return (_CONTROL if level == 1 else _SPECIAL).sub(lambda m: "\\" + m[0], text)


def unescaped(body: str) -> str:
    return _ESCAPED.sub(r"\1", body) if "\\" in body else body


def render(role: str, text: str, level: int) -> tuple[str, int, int]:
    """The turn, and where its body starts and how long it is."""
    body = escaped(text, level)
    if role in _FRAMES:
        head, tail = _FRAMES[role]
    else:
        head, tail = _OTHER[0] + escaped(role, level) + _OTHER[1], _OTHER[2]
    return head + body + tail, len(head), len(body)


def _body(text: str, at: int, closer: str) -> tuple[str, int]:
    """The raw body from ``at`` to ``closer`` and the place behind it."""
    mark = closer.strip()
    lead = closer.index(mark)
    for m in _LEXEME.finditer(text, at):
        if m[0][0] == "\\":
            continue
        end = m.start() - lead
        if m[0] != mark or end < at or not text.startswith(closer, end):
            raise GrammarError(f"{m[0]} at {m.start()} instead of {mark}")
        return text[at:end], end + len(closer)
    raise GrammarError(f"no {mark} after {at}")


def parse(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    at = 0
    while at < len(text):
        for role, (head, tail) in _FRAMES.items():
            if text.startswith(head, at):
                body, at = _body(text, at + len(head), tail)
                yield role, unescaped(body)
                break
        else:
            if not text.startswith(_OTHER[0], at):
                raise GrammarError(f"no turn starts at {at}")
            role, at = _body(text, at + len(_OTHER[0]), _OTHER[1])
            body, at = _body(text, at, _OTHER[2])
            yield unescaped(role), unescaped(body)


def formatted(role: str, text: str) -> tuple[str, int, int, int]:
    """The least escaped rendering that reads back identical: piece, level, body start, length."""
    for level in (0, 1, 2):
        piece, start, length = render(role, text, level)
        try:
            if list(parse(piece)) == [(role, text)]:
                return piece, level, start, length
        except GrammarError:
            pass
    raise AssertionError("a fully escaped turn reads back")


def format_turns(turns: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``turns`` with ``piece`` (the formatted turn), ``escapes`` (0, 1 or 2), and the loss mask.

    The mask is the assistant's body in the piece: ``loss_start`` and
    ``loss_length`` in code points, null for other turns.
    """
    schema = "struct<piece: string, escapes: int, loss_start: int, loss_length: int>"

    @F.pandas_udf(schema)
    def form(roles: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for role, text in zip(roles, texts):
            piece, level, start, length = formatted(role or "", text or "")
            masked = role == "assistant"
            rows.append((piece, level, start if masked else None, length if masked else None))
        return pd.DataFrame(rows, columns=_ADDED).astype(
            {"loss_start": "Int32", "loss_length": "Int32"}
        )

    out = free_name(turns.columns, "formatted")
    return turns.withColumn(out, form(quoted(role_col), quoted(text_col))).select(
        *[quoted(c) for c in turns.columns if c.lower() not in _ADDED],
        *[F.col(out)[c].alias(c) for c in _ADDED],
    )


class _Reader:
    """Reads the pieces of one conversation and keeps running digests."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.waiting: list[str] = []
        self.size = self.turns = self.loss_chars = self.chars = 0
        self.digest, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, start: int | None, length: int | None) -> None:
        self.waiting.append(piece)
        self.size += len(piece)
        if start is not None:
            text = unescaped(piece[start : start + length])
            self.loss_chars += len(text)
            self.loss.update(text.encode("utf-8"))
        if self.size > _BLOCK:
            self.read()

    def read(self) -> None:
        text = "".join(self.waiting)
        for role, said in parse(text):
            self.turns += 1
            self.digest.update(f"{role}\n{said}\n".encode())
        self.chars += len(text)
        self.waiting, self.size = [], 0

    def row(self) -> tuple:
        self.read()
        return (
            self.conv,
            self.turns,
            self.digest.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
        )


def read_back(
    pieces: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """What the formatted conversations say: one row per conversation with counts and digests."""
    schema = (
        f"conv {pieces.schema[conv_col].dataType.simpleString()}, n_turns bigint, "
        "turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            done = []
            for conv, piece, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Reader(conv)
                now.add(piece, start, length)
            if done:
                yield _batch(done, batch.schema.field(0).type)
            kind = batch.schema.field(0).type
        if now is not None:
            yield _batch([now.row()], kind)

    def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    order = ["conv", "turn", "role", "said"]
    sequence = (
        pieces.select(
            quoted(conv_col).alias("conv"),
            quoted(turn_col).alias("turn"),
            F.coalesce(quoted(role_col), F.lit("")).alias("role"),
            F.coalesce(quoted(text_col), F.lit("")).alias("said"),
            "piece",
            "loss_start",
            "loss_length",
        )
        .repartition("conv")
        .sortWithinPartitions(*order)
        .select("conv", "piece", "loss_start", "loss_length")
    )
    return sequence.mapInArrow(read, schema).withColumnRenamed("conv", conv_col)
