"""Token ids in binary files: canonical Huffman code of limited length, in independent blocks.

``encode_ids`` gives every text its ids with the ``tokenizers`` library and an end
id. ``write_files`` counts all ids, makes one code for the whole dataset, and
writes the documents in ascending order of their ids, each part of the sorted
table as files of its own. ``read_files`` decodes them to one row per document.

**Code.** Counts of all ids are added up by Spark and sent to the driver, one row
per id of the vocabulary. Code lengths are those of the best prefix code with at
most ``LIMIT`` bits (package-merge); codes are canonical, so the lengths alone say
everything and are the head of each file.

**File.** Magic, version, code lengths; then blocks of at most ``BLOCK`` ids. A
block has the rows of the documents that start in it (id, number of ids) and the
bits of its ids, from its first byte on; a checkpoint every ``STEP`` ids says at
which bit the decoder stands. A block is read without those before it, and from a
checkpoint on without the block's earlier bits. Decoding is by one table of
``2 ** longest`` entries: the next bits give id and length. All stretches between
checkpoints of a block are decoded side by side, one id of each at a time. The
foot lists the blocks: where they begin and how many ids come before.

**Order.** The ids are range-sorted by (document id, checksum, running number), so
that neither a frequent id nor repeated rows end in one part. A file counts its
ids; files follow each other by part and number, and the ids before a file are a
running sum over the list of files, one row per file of some ``FILE_IDS`` ids.

**Words.** The library is called once for a word that a worker has not met lately.
That gives the ids of the whole text, because its pieces never hold white space
and nothing it does looks beyond a blank: texts are cut at ASCII white space,
between letters of ASCII or Latin-1, ASCII digits and other ASCII characters, and
between digits, unless an apostrophe or ``<`` may bind them. A word cannot differ
from another by the punctuation around it, so fewer are met. Of some ``GROUP`` bytes
of texts each different word is looked up once; Arrow numbers the words and puts
their ids together. Unknown words that
are one piece to the library go through it ``TOGETHER`` in a text; the ids that end
a word tell them apart. Words are kept in two generations of ``KEPT_BYTES`` bytes; when
the younger is full, the older is dropped.

Special cases: null and empty texts give the end id alone. Documents with a null
id come first, repeated ids keep all their rows, in order of their checksums. An
empty table gives no files and no rows. Texts are encoded piece by piece, so a
very long one takes no more memory than its ids; its ids may span many blocks.
Files are written to the shared folder under a new name for each attempt, and
only those listed by finished tasks are read. Columns other than id and text are
not read, so their names cannot clash. A damaged file raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staging import new_staging_path, stage
from .warc import _place
from .words import quoted, word_array
from .workers import kept

END_ID = 2
LIMIT = 18  # bits of the longest code, or as many as the vocabulary needs
BLOCK = 1 << 20  # ids
STEP = 128  # ids between two checkpoints
CHUNK = 1 << 15  # ids whose bits are put together at a time, so that they stay in the cache
FILE_IDS = 1 << 25  # a new file is begun after so many ids
PIECE = 1 << 20  # bytes of a text that are encoded at a time
GROUP = 2 << 20  # bytes of texts that are encoded together
KEPT_BYTES = 96 << 20  # words of one generation, as Python holds them
TOGETHER = 256  # words that go through the library as one text
KEPT_LENGTH = 64  # bytes; longer words are not kept
MAGIC, FOOT = b"WBIDS\x00\x01\n", b"WBIDSEND"

_BLANKS = (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c")


# --- encoding --------------------------------------------------------------------------------


def id_kind(largest: int) -> np.dtype:
    """The numbers that ids are kept in between steps."""
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


class Words:
    """Ids of texts by the ``tokenizers`` library, word by word; one per Python worker."""

    def __init__(self, vocabulary: str) -> None:
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        given = json.loads(vocabulary)
        self.kind = id_kind(self.tokenizer.get_vocab_size() - 1)
        self.lowers = '"Lowercase"' in json.dumps(given["normalizer"])
        # Ids that end a word: with them many words can be told apart in one call's ids.
        suffix = given["model"].get("end_of_word_suffix")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if suffix:
            self.ends[[i for w, i in given["model"]["vocab"].items() if w.endswith(suffix)]] = True
        self.signs = re.compile(rb"[!-&(-/:;=-@\[-`{-~]+")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.size = 0

    def _one_piece(self, word: bytes) -> bool:
        """Letters alone or ASCII signs alone: at least one piece, and mostly just that."""
        if word.isascii():
            return word.isalpha() or self.signs.fullmatch(word) is not None
        return word.decode("utf-8").isalpha()

    def _library(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words; those that are one piece go through the library together."""
        plain, rest = [], []
        for w in words:
            (plain if w.isalpha() or self._one_piece(w) else rest).append(w)
        lower = list(map(bytes.lower, plain)) if self.lowers else plain
        once = list(dict.fromkeys(lower))
        starts = range(0, len(once), TOGETHER)
        coded = self._encode([b" ".join(once[a : a + TOGETHER]) for a in starts])
        ids = np.concatenate([np.empty(0, self.kind), *coded])
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(once):  # every word ends at least once, so none ends twice
            raw, cuts = ids.tobytes(), (cuts * ids.itemsize).tolist()
            found = {w: raw[a:b] for w, a, b in zip(once, [0, *cuts], cuts)}
        else:
            found = {w: i.tobytes() for w, i in zip(once, self._encode(once))}
        if self.lowers:
            found = dict(zip(plain, map(found.get, lower)))
        found.update((w, i.tobytes()) for w, i in zip(rest, self._encode(rest)))
        return found

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(
            [t.decode("utf-8") for t in texts], add_special_tokens=False
        )
        return [np.array(e.ids, self.kind) for e in found]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that are not among the young, which they now are."""
        have = dict(zip(words, map(self.old.get, words)))
        have.update(self._library([w for w, ids in have.items() if ids is None]))
        self.young.update(i for i in have.items() if len(i[0]) <= KEPT_LENGTH)
        self.size += 200 * len(have) + sum(map(len, have)) + sum(map(len, have.values()))
        if self.size >= KEPT_BYTES:
            self.old, self.young, self.size = self.young, {}, 0
        return have

    def _group(self, texts: list[bytes]) -> list[bytes]:
        """Ids of some texts; each different word of all of them is looked up once."""
        words, ends = word_array(texts)
        words = words.dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        got = list(map(self.young.get, distinct))
        if holes := [at for at, ids in enumerate(got) if ids is None]:
            known = self._learn([distinct[at] for at in holes])
            for at in holes:
                got[at] = known[distinct[at]]
        # The ids of a text's words follow each other in the bytes of the array.
        _, cuts, ids = pa.array([*got, b""], pa.large_binary()).take(words.indices).buffers()
        if not ids:
            return [b""] * len(texts)
        cuts, ids = np.frombuffer(cuts, np.int64)[ends].tolist(), memoryview(ids)
        return [bytes(ids[a:b]) for a, b in zip([0, *cuts], cuts)]

    def _plain(self, text: bytes) -> bytes:
        """The text with A-Z lower-cased where that changes no ids.

        Not where a special token may stand, nor where a letter may join with an
        accent that follows it (U+0300 to U+036F).
        """
        if self.lowers and not (b"<" in text or b"\xcc" in text or b"\xcd" in text):
            return text.lower()
        return text

    def _pieces(self, text: bytes) -> Iterator[bytes]:
        """A long text in pieces that end before a blank."""
        at = 0
        while at < len(text):
            ends = (text.find(b, at + PIECE, at + 2 * PIECE) for b in _BLANKS)
            end = min((e for e in ends if e >= 0), default=-1)
            if end < 0:  # the rest, or a stretch of a megabyte without a blank
                ends = (text.find(b, at + PIECE) for b in _BLANKS)
                end = min((e for e in ends if e >= 0), default=len(text))
            yield text[at:end]
            at = end

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of each text as numbers of ``kind``."""
        group, size = [], 0
        for text in texts:
            text = self._plain(text)
            if group and (size + len(text) > GROUP or len(text) > PIECE):
                yield from self._group(group)
                group, size = [], 0
            if len(text) > PIECE:
                yield b"".join([self._group([p])[0] for p in self._pieces(text)])
            else:
                group.append(text)
                size += len(text)
        yield from self._group(group)


def encode_ids(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """(id, ids, width, crc): ids of each text and the end id, ``width`` bytes each.

    ``crc`` is the CRC-32 of the ids as 32-bit numbers.
    """
    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    digest = hashlib.sha256(vocabulary.encode("utf-8")).hexdigest()
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("ids", T.BinaryType()),
            T.StructField("width", T.IntegerType()),
            T.StructField("crc", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept("token_words", digest, lambda: Words(shared.value))
        kind = max(words.kind, id_kind(end_id), key=lambda k: k.itemsize)
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64)
            cuts = (np.flatnonzero(np.diff(size // GROUP)) + 1).tolist()
            for at, to in zip([0, *cuts], [*cuts, len(batch)]):
                part = batch.slice(at, to - at)
                raw = []
                for ids in words.ids(part.column(1).to_pylist()):
                    if kind != words.kind:
                        ids = np.frombuffer(ids, words.kind).astype(kind).tobytes()
                    raw.append(ids + end)
                crc = [zlib.crc32(np.frombuffer(r, kind).astype("<u4")) for r in raw]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(raw, pa.binary()),
                        pa.array([kind.itemsize] * len(raw), pa.int32()),
                        pa.array(crc, pa.int64()),
                    ],
                    names=schema.fieldNames(),
                )

    text = F.coalesce(quoted(text_col), F.lit("")).cast("binary")
    return docs.select(quoted(id_col).alias("id"), text.alias("text")).mapInArrow(run, schema)


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n) of all ids of a task, from (ids, width)."""
    counts = np.zeros(0, np.int64)
    for batch in batches:
        for at in range(0, len(batch), 512):
            part = batch.slice(at, 512)
            width = part.column("width")[0].as_py()  # the same in all rows
            raw = b"".join(part.column("ids").to_pylist())
            more = np.bincount(np.frombuffer(raw, f"<u{width}"), minlength=len(counts))
            more[: len(counts)] += counts
            counts = more
    tokens = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(tokens, pa.int64()), pa.array(counts[tokens], pa.int64())], names=["token", "n"]
    )


# --- the code --------------------------------------------------------------------------------


def code_lengths(counts: Sequence[int], limit: int = LIMIT) -> np.ndarray:
    """Bits of each id in the best prefix code of at most ``limit`` bits; 0 if it does not occur.

    Package-merge: in ``limit`` rounds, pairs of the cheapest packages become
    packages among the single ids. Of the last round's cheapest ``2n - 2``, an id
    has as many bits as the packages that hold it.
    """
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, (n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    single = counts[order]
    rounds = []  # of each round: which of the merged list are single ids
    merged = single
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([single, pairs])
        sort = np.argsort(both, kind="stable")
        rounds.append(sort < n)
        merged = both[sort]
    take = 2 * n - 2
    bits = np.zeros(n, np.int64)
    for is_single in reversed(rounds):
        singles = int(is_single[:take].sum())
        bits[:singles] += 1
        take = 2 * (take - singles)
    bits[:take] += 1
    lengths[order] = bits
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: by length, then by id, counting upwards."""
    codes = np.zeros(len(lengths), np.uint64)
    code = before = 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        if bits := int(lengths[i]):
            code <<= bits - before
            codes[i] = code
            code, before = code + 1, bits
    return codes


def pack_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of ``ids`` from the highest bit of the first byte on, and where every id begins."""
    starts = np.empty(len(ids), np.int64)
    words = np.zeros(len(ids) * int(lengths.max(initial=0)) // 32 + 3, np.int64)
    total = 0
    for at in range(0, len(ids), CHUNK):
        part = ids[at : at + CHUNK]
        bits = lengths[part].astype(np.int64)
        ends = np.cumsum(bits)
        ends += total
        begin = np.subtract(ends, bits, out=starts[at : at + CHUNK])
        # A code of up to 32 bits lies in two words of 32 bits; no two codes share a bit, so
        # adding is the same as setting.
        wide = codes[part] << (64 - (begin & 31) - bits).astype(np.uint64)
        first = total >> 5
        word = (begin >> 5) - first
        for half, shift in ((wide >> np.uint64(32), 0), (wide & np.uint64(0xFFFFFFFF), 1)):
            sums = np.bincount(word, weights=half).astype(np.int64)
            words[first + shift : first + shift + len(sums)] += sums
        total = int(ends[-1])
    words = words[: (total + 31) // 32]
    return words.astype(">u4").tobytes()[: (total + 7) // 8], starts


class Decoder:
    """Table-driven decoding of canonical codes given by their lengths."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.longest = int(lengths.max(initial=0))
        # id and bits in one number
        self.table = np.zeros(1 << self.longest, np.int64 if len(lengths) >> 25 else np.int32)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = np.int64(1) << (self.longest - lengths[order].astype(np.int64))
        self.table[: int(spans.sum())] = np.repeat(order << 6 | lengths[order], spans)

    def decode(self, data: bytes, points: np.ndarray, n: int, step: int) -> np.ndarray:
        """``n`` ids; ``points`` are the bits at which every ``step``-th of them begins."""
        at = np.asarray(points, np.int64).copy()
        lanes = len(at)
        out = np.empty((step, lanes), np.int32)
        last = n - (lanes - 1) * step
        end = 8 * len(data)
        if lanes and int(at.max()) > end:
            raise ValueError("the bits of a block are damaged")
        shift = np.uint64(64 - self.longest)
        # the 64 bits that begin at each word of 32 bits, as one number
        padded = np.frombuffer(data + bytes(12 - len(data) % 4), ">u4").astype(np.uint64)
        pieces = padded[:-1] << np.uint64(32) | padded[1:]
        for i in range(step):
            if i == last:
                at, lanes = at[:-1], lanes - 1
                if not lanes:
                    break
            window = pieces[at >> 5] << (at & 31).view(np.uint64)
            found = self.table[(window >> shift).view(np.int64)]
            out[i, :lanes] = found >> 6
            used = found & 63
            at = at + used
            if not used.all() or (lanes and int(at.max()) > end):
                raise ValueError("the bits of a block are damaged")
        return out.T.reshape(-1)[:n]


# --- files -----------------------------------------------------------------------------------

_HEAD = "<IIIIQ"  # rows, ids, checkpoints, bytes of rows, bytes of bits


class FileWriter:
    """Writes one file to an output stream, block by block."""

    def __init__(self, stream, lengths: np.ndarray, step: int = STEP, block: int = BLOCK) -> None:
        self.stream, self.lengths = stream, lengths
        self.codes = canonical_codes(lengths)
        self.step, self.block = step, block
        self.rows: list[tuple] = []
        self.held: list[np.ndarray] = []
        self.waiting = self.ids = self.docs = 0
        self.blocks: list[tuple[int, int]] = []
        head = zlib.compress(lengths.tobytes(), 6)
        self.size = self.stream.write(
            MAGIC + (fields := struct.pack("<III", step, len(lengths), len(head)))
            + struct.pack("<I", zlib.crc32(fields + head)) + head
        )

    def add(self, doc, ids: np.ndarray) -> None:
        self.rows.append((doc, len(ids)))
        self.docs += 1
        at = 0
        while at < len(ids):
            part = ids[at : at + self.block - self.waiting]
            self.held.append(part)
            self.waiting += len(part)
            at += len(part)
            if self.waiting == self.block:
                self._close_block()

    def _close_block(self) -> None:
        ids = np.concatenate([np.empty(0, np.int32), *self.held])
        data, starts = pack_bits(ids, self.lengths, self.codes)
        points = starts[:: self.step].astype("<u4").tobytes()
        rows = zlib.compress(json.dumps(self.rows).encode("utf-8"), 1)
        body = points + rows + data
        head = struct.pack(_HEAD, len(self.rows), len(ids), len(points) // 4, len(rows), len(data))
        self.blocks.append((self.size, self.ids))
        self.size += self.stream.write(head + struct.pack("<I", zlib.crc32(head + body)) + body)
        self.ids += len(ids)
        self.rows, self.held, self.waiting = [], [], 0

    def close(self) -> None:
        if self.waiting or self.rows:
            self._close_block()
        foot = np.array(self.blocks, "<u8").tobytes()
        foot += struct.pack("<QQ", len(self.blocks), self.ids)
        self.stream.write(foot + struct.pack("<I", zlib.crc32(foot)) + FOOT)
        self.stream.close()


class FileReader:
    """Reads one file of ``FileWriter`` from a stream that can seek."""

    def __init__(self, stream) -> None:
        self.stream = stream
        self._need(0, len(MAGIC), MAGIC)
        fields = self._need(len(MAGIC), 16)
        self.step, _, size, crc = struct.unpack("<IIII", fields)
        head = self._need(len(MAGIC) + 16, size)
        if zlib.crc32(fields[:12] + head) != crc:
            raise ValueError("the code lengths are damaged")
        self.decoder = Decoder(np.frombuffer(zlib.decompress(head), np.uint8))
        length = stream.size()
        self._need(length - 8, 8, FOOT)
        blocks, self.ids, crc = struct.unpack("<QQI", self._need(length - 28, 20))
        foot = self._need(length - 28 - 16 * blocks, 16 * blocks + 16)
        if zlib.crc32(foot) != crc:
            raise ValueError("the list of blocks is damaged")
        self.blocks = np.frombuffer(foot[:-16], "<u8").reshape(-1, 2).astype(np.int64)

    def _need(self, at: int, n: int, same: bytes | None = None) -> bytes:
        if at < 0:
            raise ValueError("the file is cut short")
        self.stream.seek(at)
        data = self.stream.read(n)
        if len(data) != n or (same is not None and data != same):
            raise ValueError("the file is damaged or cut short")
        return data

    def block(self, i: int, start: int = 0, stop: int | None = None) -> tuple[list, np.ndarray]:
        """Rows that start in block ``i``, and its ids from ``start`` to ``stop``.

        Only the stretches between the checkpoints around that range are decoded.
        """
        at = int(self.blocks[i, 0])
        head = self._need(at, struct.calcsize(_HEAD) + 4)
        n_rows, n, n_points, row_bytes, bit_bytes = struct.unpack(_HEAD, head[:-4])
        body = self._need(at + len(head), 4 * n_points + row_bytes + bit_bytes)
        if zlib.crc32(head[:-4] + body) != struct.unpack("<I", head[-4:])[0]:
            raise ValueError("a block is damaged")
        points = np.frombuffer(body, "<u4", n_points)
        rows = json.loads(zlib.decompress(body[4 * n_points : 4 * n_points + row_bytes]))
        if len(rows) != n_rows:
            raise ValueError("a block is damaged")
        stop = n if stop is None else min(stop, n)
        first, last = start // self.step, -(-stop // self.step)
        wanted = min(n, last * self.step) - first * self.step
        if wanted <= 0:
            return rows, np.empty(0, np.int32)
        bits = body[4 * n_points + row_bytes :]
        ids = self.decoder.decode(bits, points[first:last], wanted, self.step)
        return rows, ids[start - first * self.step : stop - first * self.step]

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file, from the blocks that hold them."""
        parts = [np.empty(0, np.int32)]
        i = max(int(np.searchsorted(self.blocks[:, 1], start, "right")) - 1, 0)
        while i < len(self.blocks) and self.blocks[i, 1] < stop:
            before = int(self.blocks[i, 1])
            parts.append(self.block(i, max(start - before, 0), stop - before)[1])
            i += 1
        return np.concatenate(parts)

    def documents(self) -> Iterator[tuple[object, int, Iterator[np.ndarray]]]:
        """(id, number of ids, the ids in parts) of each document; take the parts in order."""
        ahead: list[np.ndarray] = []
        waiting: list[tuple] = []
        state = {"block": 0}

        def load() -> None:
            if state["block"] >= len(self.blocks):
                raise ValueError("the file has too few ids")
            rows, ids = self.block(state["block"])
            state["block"] += 1
            waiting.extend(rows)
            ahead.append(ids)

        def parts(n: int) -> Iterator[np.ndarray]:
            while n:
                while not ahead or not len(ahead[0]):
                    if ahead:
                        ahead.pop(0)
                    else:
                        load()
                part = ahead[0][:n]
                ahead[0] = ahead[0][n:]
                n -= len(part)
                yield part

        while True:
            if not waiting:
                if state["block"] >= len(self.blocks):
                    return
                load()
                continue
            rows = waiting[:]
            waiting.clear()
            for doc, n in rows:
                yield doc, n, parts(n)


def write_files(
    coded: DataFrame, folder: str | None = None, limit: int = LIMIT, file_ids: int = FILE_IDS
) -> DataFrame:
    """Write what ``encode_ids`` gives, staged, to files: (file, place, docs, n_ids, bytes), staged."""
    spark = coded.sparkSession
    folder = folder or new_staging_path(spark, "token-files")
    counts = (
        coded.select("ids", "width")
        .mapInArrow(_count_ids, "token bigint, n bigint")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .collect()
    )  # a row per id of the vocabulary
    table = np.zeros(max((r.token for r in counts), default=0) + 1, np.int64)
    for r in counts:
        table[r.token] = r.n
    lengths = code_lengths(table, limit)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _place(folder)
        files.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        out = name = None
        number = 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict(
                {
                    "file": [f"{folder}/{name}"],
                    "place": [part << 32 | number],
                    "docs": [out.docs],
                    "n_ids": [out.ids],
                    "bytes": [out.size],
                }
            )

        for batch in batches:
            for doc, raw, width in zip(*(c.to_pylist() for c in batch.columns)):
                if out is not None and out.ids >= file_ids:
                    yield closed()
                    out, number = None, number + 1
                if out is None:
                    name = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex}.ids"
                    out = FileWriter(
                        files.open_output_stream(f"{base}/{name}", compression=None), lengths
                    )
                out.add(doc, np.frombuffer(raw, f"<u{width}").astype(np.int32))
        if out is not None:
            yield closed()

    keys = ["id", "crc", "tie"]
    ordered = (
        coded.withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("id", "ids", "width")
    )
    return stage(
        ordered.mapInArrow(
            write, "file string, place bigint, docs bigint, n_ids bigint, bytes bigint"
        ),
        "token-file-list",
    )


def placed_files(files: DataFrame) -> DataFrame:
    """The files with ``before``: the number of ids in all files before; one row per file."""
    earlier = W.orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    return files.withColumn("before", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))


def read_files(files: DataFrame, id_type: str | T.DataType = "bigint") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each document, decoded from its file."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, before in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = _place(file)
                with system.open_input_file(path) as stream:
                    rows = []
                    for doc, n, parts in FileReader(stream).documents():
                        crc = 0
                        for ids in parts:
                            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                        rows.append((doc, before, n, crc))
                        before += n
                        if len(rows) >= 10_000:
                            yield batch_of(rows)
                            rows = []
                    if rows:
                        yield batch_of(rows)

    text = id_type in ("string", T.StringType())
    names = ["id", "start", "n_tokens", "ids_crc32"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        ids, *numbers = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.string() if text else pa.int64()),
                *[pa.array(c, pa.int64()) for c in numbers],
            ],
            names=names,
        )

    n = max(files.count(), 1)
    found = placed_files(files).select("file", "before").repartition(n)
    schema = f"id {'string' if text else 'bigint'}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return found.mapInArrow(read, schema).withColumn("id", F.col("id").cast(id_type))


def token_files(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` written to token files and read back, one row per document."""
    coded = stage(encode_ids(docs, id_col, text_col), "token-ids")
    return read_files(write_files(coded), docs.schema[id_col].dataType)
