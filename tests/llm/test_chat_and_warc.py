"""Chat round trips and WARC archives: fuzzed, damaged, and against SQL."""

import random
import struct

import pytest
from pyspark.sql import functions as F
from waybill.llm import chat_format, oracle, queries, warc

MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[TEXT]", "[/ROLE]"]
BITS = [*MARKS, "\\", "[", "<", "]", " ", "a", "\n", "é", "/"]


def test_every_turn_reads_back():
    random.seed(2)
    for _ in range(4000):
        role = random.choice(["user", "assistant", "system", "", "tool", random.choice(MARKS)])
        text = "".join(random.choices(BITS, k=random.randint(0, 9)))
        piece, level, start, length = chat_format.formatted(role, text)
        assert list(chat_format.parse(piece)) == [(role, text)]
        assert chat_format.unescaped(piece[start : start + length]) == text
        if not level:
            assert text in piece


def test_joined_turns_read_back():
    random.seed(4)
    turns = [
        (random.choice(["user", "assistant", "x"]), "".join(random.choices(BITS, k=8)))
        for _ in range(500)
    ]
    text = "".join(chat_format.formatted(*t)[0] for t in turns)
    assert list(chat_format.parse(text)) == turns
    with pytest.raises(chat_format.GrammarError):
        list(chat_format.parse(text + "[INST] open"))


def test_chat_edges(spark, same):
    rows = [
        (1, 1, "assistant", "b", 0), (1, 0, "user", None, 0), (1, 1, "assistant", "b", 0),
        (1, 1, "user", "tie", 0), (2, None, None, "", 0), (2, 5, "tool[INST]", "x\\[y", 0),
        (None, 0, "system", "s </s>", 0), (None, 1, "assistant", "ends in \\", 0),
        (3, 0, "assistant", "[INST] " * 20_000, 0), (4, 0, "user", "", 0),
    ]
    df = spark.createDataFrame(
        rows, "conv_id bigint, turn bigint, role string, text string, piece int"
    ).withColumn("said", F.lit(1))
    got = chat_format.read_back(chat_format.format_turns(df))
    planted = "UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),\n                   (-1, 1, 'assistant', '</s>[INST] ok [/INST]')"
    assert planted in oracle.OP1
    same(got, oracle.OP1.replace(planted, ""), conversations=df.select("conv_id", "turn", "role", "text"))
    empty = chat_format.read_back(chat_format.format_turns(df.limit(0)))
    assert empty.count() == 0


PAGES = [
    (1, "http://a/", "x" * 100), (2, None, "x" * 100), (3, "http://c/ d\r\n\x01", "x" * 99),
    (4, "u", "x" * 99), (5, "", None), (6, "u", ""), (1, "again", "x" * 100),
    (None, "u", "x" * 100), (7, "u", "é" * 50), (8, "u", "é" * 50), (9, "u", "long " * 400_000),
]


def test_warc_edges(spark, same):
    df = spark.createDataFrame(
        [(*p, 0, 1) for p in PAGES], "page_id bigint, url string, html string, digest int, first int"
    )
    got = warc.archived(spark, df).select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.col("first_page").alias("refers_to"), "error",
    )
    same(got, oracle.OP4, pages=df.select("page_id", "html"))
    assert warc.archived(spark, df.limit(0)).count() == 0


def test_archive_has_a_dictionary_and_a_frame_per_record(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").repartition(2)
    written = warc.write_archives(pages, str(tmp_path / "out"), archive_bytes=100_000).collect()
    assert len(written) > 2 and sum(r.records for r in written) == 250
    for r in written:
        with open(r.archive, "rb") as f:
            raw = f.read()
        assert len(raw) == r.bytes
        magic, size = struct.unpack("<II", raw[:8])
        assert magic == warc.SKIPPABLE and raw[8:12] == b"\x37\xa4\x30\xec"
        assert raw[8 + size : 12 + size] == warc.ZSTD_MAGIC
        with open(r.archive, "rb") as f:
            frames = list(warc.read_frames(f, chunk=1000))
        assert len(frames) == r.records and all(x.startswith(b"WARC/1.1\r\n") for x in frames)


def record(**change):
    import hashlib

    payload = b"<p>hello</p>"
    raw = warc.make_record(1, "u", payload, hashlib.sha256(payload).hexdigest())
    for old, new in change.items():
        raw = raw.replace(*new)
    return raw


@pytest.mark.parametrize(
    "old, new, says",
    [
        (b"WARC/1.1", b"WARC/9", "no WARC record"),
        (b"WARC-Date", b"X-Date", "missing header WARC-Date"),
        (b"</p>\r\n\r\n", b"</p>x\r\n\r\n", "Content-Length"),
        (b"</p>\r\n\r\n", b"</p>\r\n\rX", "no empty lines"),
        (b"<p>", b"<q>", "digest differs"),
        (b"response\r\n", b"metadata\r\n", "record type metadata"),
        (b"Content-Length: 12", b"Content-Length: 13", "announced"),
    ],
)
def test_damaged_records_are_named(old, new, says):
    good = record()
    assert warc.read_record(good)["payload"] == b"<p>hello</p>"
    with pytest.raises(ValueError, match=says):
        warc.read_record(good.replace(old, new, 1))


def test_damaged_frames(spark, tmp_path):
    import io

    import zstandard

    frame = zstandard.ZstdCompressor().compress(record())
    assert len(list(warc.read_frames(io.BytesIO(frame * 3)))) == 3
    path = tmp_path / "cut.warc.zst"
    path.write_bytes(frame + frame[:-4])
    df = spark.createDataFrame([(str(path),)], "archive string")
    rows = warc.read_archives(df).collect()
    assert [r.error is None for r in rows] == [True, False] and "cut short" in rows[1].error
    # a dictionary may be compressed itself
    rows = [(b"some page of a host %d " % i) * 20 for i in range(200)]
    trained = zstandard.train_dictionary(4096, rows)
    packed = zstandard.ZstdCompressor().compress(trained.as_bytes())
    body = zstandard.ZstdCompressor(dict_data=trained).compress(record())
    assert list(warc.read_frames(io.BytesIO(warc.lead_frame(packed) + body))) == [record()]


def test_queries(spark, same):
    sf = "/root/testdata/sf0.001"
    same(queries.op1_chat_format(spark, sf), oracle.OP1, conversations=spark.read.parquet(f"{sf}/conversations.parquet"))
    same(queries.op4_warc(spark, sf), oracle.OP4, pages=spark.read.parquet(f"{sf}/pages.parquet"))
