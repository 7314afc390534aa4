"""The first record of each of many CSV files, without reading the files."""

from __future__ import annotations

import codecs
import csv
import io
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 16 << 10  # bytes read at a time
HEAD_BYTES = 1 << 20  # bytes of a file that are looked at, at most


def _lines(read: Callable[[int], bytes]) -> Iterator[str]:
    """Lines of a stream, read chunk by chunk as they are asked for."""
    decoder = io.IncrementalNewlineDecoder(
        codecs.getincrementaldecoder("utf-8-sig")("replace"), translate=True
    )
    text, left = "", HEAD_BYTES
    while left > 0 and (data := read(min(CHUNK, left))):
        left -= len(data)
        *whole, text = (text + decoder.decode(data)).split("\n")
        yield from (line + "\n" for line in whole)
    text += decoder.decode(b"", final=True)
    if text:
        yield text


def first_record(read: Callable[[int], bytes]) -> list[str]:
    """The fields of the first record that is not blank; none if there is no such record.

    A heading may hold line breaks in quotes. One that does not end within
    ``HEAD_BYTES`` is taken as far as it was read.
    """
    csv.field_size_limit(HEAD_BYTES)
    lines = _lines(read)
    for line in lines:
        if line.strip():
            rest = iter([line])
            return next(csv.reader(_chained(rest, lines), skipinitialspace=True), [])
    return []


def _chained(first: Iterator[str], then: Iterator[str]) -> Iterator[str]:
    yield from first
    yield from then


def opened(path: str):
    """A stream over a file in a folder that all executors share; decompressed by its ending."""
    from pyarrow import fs

    found = re.match(r"([A-Za-z][\w+.-]*):(?://([^/]*))?(/.*)", path)
    scheme, authority, rest = found.groups() if found else ("file", "", path)
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream(rest)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    system, base = fs.FileSystem.from_uri(f"{scheme}://{authority or ''}/")
    return system.open_input_stream(f"{base.rstrip('/')}{rest}")


def file_heads(spark: SparkSession, paths) -> DataFrame:
    """(path, fields) of the files: tasks open the listed files and read their starts."""
    # Of this source only the listing is used; without its ``content`` no file is read.
    listed = spark.read.format("binaryFile").load(paths).where("length > 0").select("path")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            fields = []
            for name in names:
                with opened(name) as stream:
                    fields.append(first_record(stream.read))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(fields, pa.list_(pa.string()))], names=["path", "fields"]
            )

    spread = listed.repartition(spark.sparkContext.defaultParallelism, F.xxhash64("path"))
    return spread.mapInArrow(heads, "path string, fields array<string>")
