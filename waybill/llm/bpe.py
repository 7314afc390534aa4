"""BPE encoding and decoding with the vocabulary file of a public tokenizer.

A text is cut at special tokens, normalised, and cut into pieces; a piece is
merged in a contiguous rank array: the boundaries of its parts and, beside each,
the rank of joining that part with the next. The smallest rank is sought by a
scan, its boundary deleted, and the two ranks beside it looked up anew. The rank
arrays of many pieces are scanned side by side, a row each. The scan is quadratic,
so pieces above ``SHORT`` symbols are merged with the same choices from a heap of
ranks.

Rows are encoded in Arrow batches, one pass over the table and no shuffle. Each
Python worker keeps one encoder, and in it the words that it has met lately, in two
generations of at most ``KEPT_BYTES``, so memory grows neither with the input nor
with the number of runs. Words are cut at white space and where pieces end for
certain; those of some texts that are not known are merged together. The vocabulary file is read on the driver and sent to the
executors as one broadcast of its fixed size.

Special cases: null and empty texts give no ids, and no ids decode to the empty
text. An id outside the vocabulary is skipped in decoding. Whole texts are
encoded, whatever their length. Repeated rows are encoded each, an empty table
gives no rows. Rows and columns are otherwise left alone; output columns that
clash with existing ones replace them.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain, repeat

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import cut_words, free_name, quoted
from .workers import kept

SHORT = 96  # symbols; longer pieces are merged with a heap
SIDE_BY_SIDE = 24  # symbols; longer pieces are scanned one by one
PIECES = 4096  # that are scanned side by side
GROUP = 1 << 20  # characters of texts whose unknown words are merged together
KEPT_BYTES = 48 << 20  # words of one generation
CACHED_LENGTH = 64  # bytes; longer words are not kept
ID_BITS = 24
ID_MASK = (1 << ID_BITS) - 1
ROWS = 256  # that a worker holds encoded or decoded at a time
NEVER = 1 << 62  # the rank of a pair that is never joined

# White space as the tokenizer's normaliser takes it.
_SPACE = "\t-\r \x85\xa0  -     　"


def byte_alphabet() -> list[str]:
    """A printable character for each byte: itself, or one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 0x100
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class Bpe:
    """Encoder and decoder of a lower-casing, word-end BPE vocabulary."""

    def __init__(self, vocabulary: dict) -> None:
        import regex

        model = vocabulary["model"]
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in vocabulary["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.ids.items(), *self.special.items()]}
        self.decimals = {i: str(i) for i in self.tokens}
        self.by_decimal = _ByDecimal(self.decimals, self.tokens)
        # The rank of a pair and the id that it makes, in one number that sorts by rank.
        self.ranks: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pair = (self.ids[a], self.ids[b])
            self.ranks.setdefault(pair, rank << ID_BITS | self.ids[a + b])
        split = next(
            p for p in vocabulary["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        pattern = split["pattern"]["Regex"].replace(r"[^\s", f"[^{_SPACE}")
        self.piece = regex.compile(pattern)
        self.cut = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        alphabet = byte_alphabet()
        self.inner = [self.ids[c] for c in alphabet]
        self.last = [self.ids[c + self.end] for c in alphabet]
        self.pairs = _Pairs(self.ranks)
        # Words with their ids in decimal, and as 32-bit numbers.
        self.written_words = _Kept(KEPT_BYTES)
        self.words = _Kept(KEPT_BYTES)

    def normalised(self, text: str) -> str:
        """NFC and lower case; white space is left as it is, since no piece holds any."""
        # Lower-casing goes letter by letter there: no final form of sigma.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def merged(self, pieces: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of some pieces, each once."""
        found: dict[bytes, list[int]] = {}
        side: list[bytes] = []
        for piece in pieces:
            if len(piece) <= SIDE_BY_SIDE:
                side.append(piece)
                continue
            parts = list(map(self.inner.__getitem__, piece))
            parts[-1] = self.last[piece[-1]]
            found[piece] = (_scan if len(parts) <= SHORT else _heap)(parts, self.ranks)
        side.sort(key=len)
        for at in range(0, len(side), PIECES):
            some = side[at : at + PIECES]
            found.update(zip(some, _side_by_side(some, self.inner, self.last, self.pairs)))
        return found

    def _pieces(self, word: bytes) -> list[bytes]:
        if word.isalpha():  # ASCII letters
            return [word]
        text = word.decode("utf-8")
        if text.isalpha() and max(text) < "\u02b0":
            return [word]
        return [p.encode("utf-8") for p in self.piece.findall(text)]

    def _learnt(self, words: set[bytes], known: _Kept, make) -> dict:
        """What ``make`` makes of the ids of words that are not among the young."""
        have = known.older(words)
        cut = {w: self._pieces(w) for w in words if w not in have}
        ids = self.merged(list(set(chain.from_iterable(cut.values()))))
        for word, pieces in cut.items():
            if len(pieces) == 1:
                have[word] = make(ids[pieces[0]])
            else:
                have[word] = make(list(chain.from_iterable(map(ids.__getitem__, pieces))))
        known.keep(have)
        return have

    def _stretches(self, texts: list[str]) -> list[list[bytes]]:
        """Texts, cut at special tokens, as words; a special token begins with a blank."""
        if not (self.cut and any(map(self.cut.search, texts))):
            return cut_words([self.normalised(t).encode("utf-8") for t in texts])
        out = []
        for text in texts:
            words: list[bytes] = []
            for part in self.cut.split(text):
                if part in self.special:
                    words.append(b" " + part.encode("utf-8"))
                else:
                    words += cut_words([self.normalised(part).encode("utf-8")])[0]
            out.append(words)
        return out

    def _coded(self, texts: list[str], known: _Kept, make) -> Iterator[list]:
        """Of each text: what ``make`` makes of the ids of its words."""
        at = 0
        while at < len(texts):
            end, size = at + 1, len(texts[at])
            while end < len(texts) and size + len(texts[end]) <= GROUP:
                size += len(texts[end])
                end += 1
            split = self._stretches(texts[at:end])
            words = list(chain.from_iterable(split))
            got = list(map(known.young.get, words))
            if holes := [i for i, g in enumerate(got) if g is None]:
                new = {words[i] for i in holes}
                special = {w for w in new if w[:1] == b" "}
                have = self._learnt(new - special, known, make)
                have.update((w, make([self.special[w[1:].decode("utf-8")]])) for w in special)
                for i in holes:
                    got[i] = have[words[i]]
            ends = list(accumulate(map(len, split)))
            yield from (got[a:b] for a, b in zip([0, *ends], ends))
            at = end

    def written(self, texts: list[str]) -> Iterator[str]:
        """The ids of each text in decimal, with single spaces between."""
        for words in self._coded(texts, self.written_words, self._decimal):
            yield " ".join(filter(None, words))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, 32 bits each."""
        coded = self._coded(texts, self.words, _int32)
        return [np.frombuffer(b"".join(words), np.int32) for words in coded]

    def decode(self, ids) -> str:
        """Token texts with single spaces between, special tokens included."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])

    def read(self, written: str) -> str:
        """``decode`` of ids in decimal."""
        return " ".join(map(self.by_decimal.__getitem__, written.split()))

    def _decimal(self, ids: list[int]) -> str:
        return " ".join(map(self.decimals.__getitem__, ids))


def _int32(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class _ByDecimal(dict):
    """Tokens by their ids in decimal, in the usual writing or any other."""

    def __init__(self, decimals: dict[int, str], tokens: dict[int, str]) -> None:
        super().__init__((decimals[i], t) for i, t in tokens.items())
        self.tokens = tokens

    def __missing__(self, written: str) -> str:
        return self.tokens[int(written)]


class _Kept:
    """What was met lately, in two generations of ``most`` bytes by a rough count."""

    def __init__(self, most: int) -> None:
        self.young: dict[bytes, str | bytes] = {}
        self.old: dict[bytes, str | bytes] = {}
        self.most, self.size = most, 0

    def older(self, words: set[bytes]) -> dict:
        """Those of the words that are among the old."""
        old = self.old
        return {w: old[w] for w in words if w in old}

    def keep(self, met: dict) -> None:
        kept = {w: v for w, v in met.items() if len(w) <= CACHED_LENGTH}
        self.young.update(kept)
        self.size += 220 * len(kept) + sum(map(len, kept)) + sum(map(len, kept.values()))
        if self.size >= self.most:
            self.old, self.young, self.size = self.young, {}, 0


class _Pairs:
    """Ranks of many pairs at once: a hash table with linear probing in two arrays."""

    def __init__(self, ranks: dict[tuple[int, int], int]) -> None:
        self.bits = max(8, (4 * len(ranks)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NEVER, np.int64)
        pairs = np.array(list(ranks), np.int64).reshape(-1, 2)
        keys, values = self._key(pairs[:, 0], pairs[:, 1]), np.array(list(ranks.values()), np.int64)
        at = self._slot(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            _, first = np.unique(at[free], return_index=True)
            now = free[first]
            self.keys[at[now]], self.ranks[at[now]] = keys[now], values[now]
            left = np.setdiff1d(left, now, assume_unique=True)
            at[left] = (at[left] + 1) & self.mask

    def _key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a << ID_BITS | b

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).view(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, or ``NEVER``."""
        keys = self._key(a, b)
        at = self._slot(keys)
        met = self.keys[at]
        found = np.where(met == keys, self.ranks[at], NEVER)
        left = np.flatnonzero((met != keys) & (met >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            met = self.keys[at[left]]
            same = met == keys[left]
            found[left[same]] = self.ranks[at[left[same]]]
            left = left[~same & (met >= 0)]
        return found


def _side_by_side(pieces: list[bytes], inner, last, pairs: _Pairs) -> list[list[int]]:
    """``_scan`` of many pieces: a row of adjacent ranks for each, all scanned at a time."""
    n, width = len(pieces), max(map(len, pieces)) + 1
    sizes = np.fromiter(map(len, pieces), np.int64, n)
    raw = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8)
    parts = np.array(inner, np.int64)[raw].reshape(n, width)
    row = np.arange(n)
    parts[row, sizes - 1] = np.array(last, np.int64)[raw.reshape(n, width)[row, sizes - 1]]
    place = np.arange(width)
    inside = place < sizes[:, None]
    parts[~inside] = -1
    ranks = np.full((n, width), NEVER, np.int64)
    joins = place < sizes[:, None] - 1
    at, to = np.nonzero(joins)
    ranks[at, to] = pairs(parts[at, to], parts[at, to + 1])
    # Of each part that is left: the part after and before it; the last column is no part.
    after = np.minimum(np.broadcast_to(place + 1, (n, width)), sizes[:, None]).copy()
    before = np.broadcast_to(place - 1, (n, width)).copy()
    while len(row):
        least = ranks[row].argmin(axis=1)  # the leftmost of equals
        rank = ranks[row, least]
        more = rank != NEVER
        row, least, rank = row[more], least[more], rank[more]
        joined = rank & ID_MASK
        gone = after[row, least]
        then = after[row, gone]
        parts[row, least], parts[row, gone] = joined, -1
        ranks[row, gone] = NEVER
        after[row, least] = then
        before[row, then] = least
        right = parts[row, then]
        ranks[row, least] = NEVER
        has = right >= 0
        ranks[row[has], least[has]] = pairs(joined[has], right[has])
        left = before[row, least]
        has = left >= 0
        left_row, left = row[has], left[has]
        ranks[left_row, left] = pairs(parts[left_row, left], joined[has])
    alive = parts >= 0
    ends = np.cumsum(alive.sum(axis=1)).tolist()
    ids = parts[alive].tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


def _scan(parts: list[int], ranks: dict) -> list[int]:
    """Merge with an array of adjacent ranks, scanned for the minimum each time."""
    rank = ranks.get
    beside = list(map(rank, zip(parts, parts[1:]), repeat(NEVER)))
    while beside and (least := min(beside)) != NEVER:
        at = beside.index(least)  # the leftmost of equals
        parts[at] = joined = least & ID_MASK
        del parts[at + 1], beside[at]
        if at < len(beside):
            beside[at] = rank((joined, parts[at + 1]), NEVER)
        if at:
            beside[at - 1] = rank((parts[at - 1], joined), NEVER)
    return parts


def _heap(parts: list[int], ranks: dict) -> list[int]:
    """The same merges for a long piece: ranks in a heap, parts in a linked list."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (found := ranks.get((parts[i], parts[j]))):
            heapq.heappush(heap, (found >> ID_BITS, i, parts[i], parts[j], found & ID_MASK))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b, joined = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
            continue
        parts[i], alive[j], after[i] = joined, False, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p, a in zip(parts, alive) if a]


def _vocabulary(spark: SparkSession, path: str | None):
    """The text of the vocabulary file as a broadcast, and its digest."""
    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        text = f.read()
    return spark.sparkContext.broadcast(text), _sha256(text)


def _bpe(shared) -> Bpe:
    """The encoder of this Python worker, made once however many jobs use it."""
    text, digest = shared
    # What earlier stages left in Arrow's pool goes back to the machine.
    pa.default_memory_pool().release_unused()
    return kept("bpe", digest, lambda: Bpe(json.loads(text.value)))


def _with_columns(docs: DataFrame, source: str, added: list[T.StructField], make) -> DataFrame:
    """``docs`` with columns made from one; a worker holds ``ROWS`` new values at a time."""
    new = {f.name.lower() for f in added}
    rest = [f for f in docs.schema.fields if f.name.lower() not in new]
    schema = T.StructType([*rest, *added])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        build = make()
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.slice(at, ROWS)
                made = build(part.column(len(rest)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(rest)], *made], names=names)

    # The source comes last; names on the way in are plain, since dots in them would be taken apart.
    plain = [quoted(f.name).alias(f"c{i}") for i, f in enumerate(rest)]
    given = docs.select(*plain, quoted(source).alias("given"))
    return given.mapInArrow(run, schema)


def encode(
    docs: DataFrame,
    text_col: str = "text",
    out_col: str = "ids",
    path: str | None = None,
    digest_col: str | None = None,
) -> DataFrame:
    """``docs`` with the ids of each text as an array of ints.

    ``digest_col`` adds the SHA-256 of the text that is decoded from the ids.
    """
    shared = _vocabulary(docs.sparkSession, path)

    def make():
        bpe = _bpe(shared)

        def ids(texts: pa.Array) -> list[pa.Array]:
            rows = bpe.encode([t or "" for t in texts.to_pylist()])
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int32), *rows])
            out = [pa.ListArray.from_arrays(ends, flat)]
            if digest_col:
                out.append(pa.array([_sha256(bpe.decode(r.tolist())) for r in rows], pa.string()))
            return out

        return ids

    added = [T.StructField(out_col, T.ArrayType(T.IntegerType()))]
    if digest_col:
        added.append(T.StructField(digest_col, T.StringType()))
    return _with_columns(docs, text_col, added, make)


def decode(
    docs: DataFrame, ids_col: str = "ids", out_col: str = "decoded", path: str | None = None
) -> DataFrame:
    """``docs`` with the text of each array of ids; null for null."""
    shared = _vocabulary(docs.sparkSession, path)

    def make():
        bpe = _bpe(shared)

        def texts(arrays: pa.Array) -> list[pa.Array]:
            rows = arrays.to_pylist()
            return [pa.array([None if a is None else bpe.decode(a) for a in rows], pa.string())]

        return texts

    return _with_columns(docs, ids_col, [T.StructField(out_col, T.StringType())], make)


def round_trip(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` and the SHA-256 of the written ids and of the text decoded
    from them (lowercase hex), in one pass and without keeping either."""
    shared = _vocabulary(docs.sparkSession, path)

    @F.pandas_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def both(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = _bpe(shared)
        for batch in texts:
            rows = []
            for at in range(0, len(batch), ROWS):
                for written in bpe.written([t or "" for t in batch.iloc[at : at + ROWS]]):
                    n = written.count(" ") + 1 if written else 0
                    rows.append((n, _sha256(written), _sha256(bpe.read(written))))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    added = ["n_tokens", "ids_sha256", "decoded_sha256"]
    out = free_name(docs.columns, "round_trip")
    return docs.withColumn(out, both(quoted(text_col))).select(
        *[quoted(c) for c in docs.columns if c.lower() not in added],
        *[F.col(out)[c].alias(c) for c in added],
    )


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
