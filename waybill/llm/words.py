"""Text rules that several operators share: Column expressions, and the seams of words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that separates words, and the pattern of a word.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(c, UPPER, UPPER.lower())


def word_count(c: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("bigint")


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, or with underscores in front until no column is called so."""
    used = {c.lower() for c in taken}
    while wanted.lower() in used:
        wanted = "_" + wanted
    return wanted


def quoted(name: str) -> Column:
    """A column by its literal name, dots and backquotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


# What a byte can be cut from: 1 letters, 2 other ASCII, 3 digits (from each other too); 0 nothing.
_CLASS = np.zeros(256, np.uint8)
_CLASS[:128] = 2
_CLASS[[*b"'<", *b" \t\n\r\x0b\x0c"]] = 0
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_CLASS[0x30:0x3A] = 3
_LATIN = 0xC3  # U+00C0 to U+00FF begin with it: letters, but for these two
_LATIN_SIGNS = (0x97, 0xB7)


def _seams(text: np.ndarray) -> np.ndarray:
    """Where the pieces of a public tokenizer end for certain: before these bytes."""
    kind = np.frombuffer(bytearray(text).translate(_CLASS.tobytes()), np.uint8)
    lead = np.flatnonzero(text[:-1] == _LATIN)
    lead = lead[~np.isin(text[lead + 1], _LATIN_SIGNS)]
    kind[lead] = kind[lead + 1] = 1
    left, right = kind[:-1], kind[1:]
    cut = ((left != right) | (right == 3)) & (left != 0) & (right != 0)
    if len(bound := np.flatnonzero(text == 0x3C)):  # "<": a special token's word stays whole
        word = np.cumsum((text == 0x20) | ((text >= 0x09) & (text <= 0x0D)), dtype=np.int32)
        whole = np.zeros(int(word[-1]) + 1, bool)
        whole[word[bound]] = True
        cut &= ~whole[word[1:]]
    return np.flatnonzero(cut) + 1


_SPACES = b" \t\n\r\x0b\x0c"
_INK = bytes(b not in _SPACES for b in range(256))


def word_array(texts: list[bytes]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of ``cut_words`` of all texts in one array, and how many there are up to each text's end."""
    raw = b"\n".join(texts)
    ink = np.frombuffer(raw.translate(_INK), bool)
    begin = ink.copy()
    begin[1:] &= ~ink[:-1]
    begin[_seams(np.frombuffer(raw, np.uint8))] = True
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    before = np.searchsorted(np.flatnonzero(begin), ends)
    solid = raw.translate(None, _SPACES)
    offsets = np.append(np.flatnonzero(begin[ink]), len(solid))
    buffers = [None, pa.py_buffer(offsets.astype(np.int64, copy=False)), pa.py_buffer(solid)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers), before


def cut_words(texts: list[bytes]) -> list[list[bytes]]:
    """Each text's words (UTF-8), cut at ASCII white space and at the seams between their pieces.

    Seams are between letters of ASCII or Latin-1, ASCII digits and other ASCII characters, and
    between digits, but not beside an apostrophe nor in a word with ``<``.
    """
    joined = np.frombuffer(b"\n".join(texts), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    seams = _seams(joined)
    apart = np.empty(len(joined) + len(seams), np.uint8)
    blank = np.zeros(len(apart), bool)
    blank[seams + np.arange(len(seams))] = True
    apart[blank] = 0x20
    apart[~blank] = joined
    ends = (ends + np.searchsorted(seams, ends)).tolist()
    raw = apart.tobytes()
    return [raw[a:b].split() for a, b in zip([0, *ends], ends)]
