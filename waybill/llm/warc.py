"""WARC archives in Zstandard: one frame per record, the dictionary in front.

``write_archives`` writes each partition of a table of pages as archives
(`.warc.zst`): a skippable frame with the dictionary, then one frame per record.
A payload that an earlier page has already (same SHA-256, at least
``min_revisit`` bytes) becomes a revisit record that refers to it. Files get a
name of their own for each attempt; the table of written archives is staged by
Spark, so only those of successful tasks are ever read. ``read_archives`` loads
the dictionary from the skippable frame, decodes frame by frame as a stream, and
checks version, headers, lengths and digest of every record.

Duplicates are found by a minimum per digest with partial aggregation: a payload
shared by a third of the pages is one row per task. Pages meet the digests that
occur twice by an equi-join that adaptive execution may broadcast or split. The
dictionary is trained on at most ``SAMPLES`` starts of pages.

Special cases: null pages have the empty payload. A null url gives no target
header; control characters and spaces of a url are percent-encoded in it. Rows
of the same page with the same payload are all responses if that page is the
first. A null page id never is the first, and its row is a revisit only if
another page is. Ids may be numbers or texts; an empty text is as a null id. An empty table gives no archives and no records. Extra columns
are not written. A damaged record comes back with ``error`` set; a damaged frame
ends its archive with one such row.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import new_staging_path, stage
from .sampling import hash_sample
from .words import quoted

SKIPPABLE = 0x184D2A5D  # the frame that holds a dictionary
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_BYTES = 64 << 10
SAMPLES = 1000  # pages that the dictionary is trained on, at most
SAMPLE_BYTES = 16 << 10
ARCHIVE_BYTES = 64 << 20
MIN_REVISIT = 100
DATE = "2024-01-01T00:00:00Z"  # of a page without a capture date
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_REQUIRED = ("WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Length")
_RECORDS = (
    "archive string, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_bytes bigint, payload_digest string, payload binary, error string"
)


# --- records ---------------------------------------------------------------------------------


def record_id(page_id) -> str:
    """The page's id, percent-encoded, in a URN."""
    return f"<urn:x-page:{'' if page_id is None else quote(str(page_id), safe='')}>"


def _uri(url: str) -> str:
    return re.sub(
        r"[\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8")), url
    )


def make_record(page_id, url, payload: bytes, digest: str, first=None) -> bytes:
    """A response record, or a revisit of page ``first`` without the payload."""
    revisit = first is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _uri(url)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first))]
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def _headers(raw: bytes) -> dict[str, str]:
    found = {}
    for line in raw.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"header without a name: {line[:60]!r}")
        found.setdefault(name.strip().lower(), value.strip())
    return found


def read_record(raw: bytes) -> dict:
    """Check a record and take it apart; ValueError says what is wrong."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no WARC record")
    headers = _headers(lines)
    missing = [h for h in _REQUIRED if h.lower() not in headers]
    if missing:
        raise ValueError(f"missing header {missing[0]}")
    length = headers["content-length"]
    if not length.isascii() or not length.isdigit() or len(rest) != int(length) + 4:
        raise ValueError(f"Content-Length {length}, block of {len(rest) - 4} bytes")
    if rest[-4:] != b"\r\n\r\n":
        raise ValueError("no empty lines after the block")
    kind, block = headers["warc-type"], rest[:-4]
    if kind not in ("response", "revisit"):
        raise ValueError(f"record type {kind}")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no HTTP header")
    status, _, fields = http.partition(b"\r\n")
    size = _headers(fields).get("content-length", "") if fields else ""
    if not status.startswith(b"HTTP/") or not size.isdigit():
        raise ValueError("no HTTP status or length")
    digest = headers.get("warc-payload-digest", "")
    if not digest.startswith("sha256:"):
        raise ValueError("no SHA-256 payload digest")
    digest = digest[7:]
    if kind == "response":
        if len(payload) != int(size):
            raise ValueError(f"payload of {len(payload)} bytes, {size} announced")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("payload digest differs")
    elif payload or "warc-refers-to" not in headers:
        raise ValueError("revisit with a payload or without a reference")
    return {
        "record_type": kind,
        "record_id": headers["warc-record-id"],
        "target_uri": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"),
        "payload_bytes": int(size),
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


# --- frames ----------------------------------------------------------------------------------


def read_frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The content of each frame of an archive, read as a stream; ValueError if it is damaged."""
    import zstandard

    buffer = b""

    def more(n: int) -> bytes:
        nonlocal buffer
        while len(buffer) < n and (read := stream.read(max(chunk, n - len(buffer)))):
            buffer += read
        return buffer[:n]

    dictionary = None
    lead = more(8)
    if len(lead) == 8 and struct.unpack("<I", lead[:4])[0] == SKIPPABLE:
        size = struct.unpack("<I", lead[4:])[0]
        raw = more(8 + size)[8:]
        if len(raw) != size:
            raise ValueError("the dictionary frame is cut short")
        buffer = buffer[8 + size :]
        if raw[:4] == ZSTD_MAGIC:  # a dictionary may be compressed itself
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
    decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
    while more(4):
        lead = more(8)
        if len(lead) == 8 and struct.unpack("<I", lead[:4])[0] & 0xFFFFFFF0 == 0x184D2A50:
            size = 8 + struct.unpack("<I", lead[4:])[0]
            if len(more(size)) != size:
                raise ValueError("a skippable frame is cut short")
            buffer = buffer[size:]
            continue
        frame, parts = decoder.decompressobj(), []
        while not frame.eof:
            data = buffer or stream.read(chunk)
            if not data:
                raise ValueError("a frame is cut short")
            buffer = b""
            try:
                parts.append(frame.decompress(data))
            except zstandard.ZstdError as e:
                raise ValueError(f"a frame is damaged: {e}") from e
        buffer = frame.unused_data
        yield b"".join(parts)


def lead_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


def _place(uri: str):
    """The file system and path of a folder that all executors share."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition("://")
    if colon and scheme in ("s3a", "s3n"):
        uri = "s3://" + rest
    elif uri.startswith("file:/") and not colon:
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


# --- operators -------------------------------------------------------------------------------


def train_dictionary(payloads: DataFrame) -> bytes | None:
    """From at most ``SAMPLES`` starts of payloads, taken by hash; None if they are too few."""
    import zstandard

    start = F.substring("payload", 1, SAMPLE_BYTES)
    known = payloads.where(F.octet_length("payload") > 0)
    rows = hash_sample(
        known.select(start.alias("start"), "digest", "page_id"),
        F.struct("digest", "page_id"),
        SAMPLES,
        known.count(),
    ).collect()
    samples = [bytes(r.start) for r in rows]
    if len(samples) < 10:
        return None
    try:
        return zstandard.train_dictionary(
            min(DICTIONARY_BYTES, sum(map(len, samples)) // 10 + 256), samples
        ).as_bytes()
    except zstandard.ZstdError:  # too little to learn from
        return None


def with_first_page(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_revisit: int = MIN_REVISIT,
) -> DataFrame:
    """(page_id, url, payload, digest, first): ``first`` is the page that a revisit refers to."""
    payload = F.encode(F.coalesce(quoted(html_col), F.lit("")), "UTF-8")
    rows = pages.select(
        quoted(id_col).alias("page_id"), quoted(url_col).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    twice = stage(
        rows.where(F.octet_length("payload") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("of"), "first"),
        "warc-digests",
    )
    met = rows.join(twice, F.col("digest") == F.col("of"), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return met.select(
        "page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("first")
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write ``pages`` and return the written archives: (archive, records, bytes)."""
    folder = folder or new_staging_path(pages.sparkSession, "warc")
    rows = with_first_page(pages, id_col, url_col, html_col)
    dictionary = train_dictionary(rows)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        files, base = _place(folder)
        files.create_dir(base, recursive=True)
        given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder = zstandard.ZstdCompressor(level=3, dict_data=given)
        part = TaskContext.get().partitionId()
        out = name = None
        records = size = 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict(
                {"archive": [f"{folder}/{name}"], "records": [records], "bytes": [size]}
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is not None and size >= archive_bytes:
                    yield closed()
                    out = None
                if out is None:
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.warc.zst"
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                    records = size = 0
                    if dictionary:
                        size += out.write(lead_frame(dictionary))
                size += out.write(encoder.compress(make_record(*row)))
                records += 1
        if out is not None:
            yield closed()

    return stage(
        rows.mapInArrow(write, "archive string, records bigint, bytes bigint"), "warc-archives"
    )


def read_archives(archives: DataFrame, archive_col: str = "archive") -> DataFrame:
    """The records of archives, one row each; ``error`` says what is wrong with a bad one."""
    names = [f.split()[0] for f in _RECORDS.split(", ")]
    kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                files, path = _place(archive)
                rows, size = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    frames = read_frames(stream)
                    while True:
                        row = {"archive": archive}
                        try:
                            raw = next(frames)
                        except StopIteration:
                            break
                        except ValueError as e:
                            rows.append(row | {"error": str(e)})
                            break
                        try:
                            rows.append(row | read_record(raw))
                        except ValueError as e:
                            rows.append(row | {"error": str(e)})
                        size += len(raw)
                        if size > 16 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    n = max(archives.count(), 1)  # one row per archive of 64 MB
    return archives.select(quoted(archive_col)).repartition(n).mapInArrow(read, _RECORDS)


def page_of(record: str, kind="bigint"):
    """The page id in a record id, as a Column of type ``kind``; null for a null id."""
    written = F.nullif(F.regexp_extract(F.col(record), r"^<urn:x-page:(.*)>$", 1), F.lit(""))
    return F.url_decode(written).try_cast(kind)


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages written to archives and read back: the records, with ``page_id`` and ``first_page``."""
    kind = pages.schema["page_id"].dataType
    return (
        read_archives(write_archives(pages))
        .withColumn("page_id", page_of("record_id", kind))
        .withColumn("first_page", page_of("refers_to", kind))
    )
