"""Merkle manifest, divergence audit and token files on edge tables."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from waybill.llm import audit_sql, divergence, merkle, queries, token_files
from waybill.llm.words import cut_words, word_array

LONG = "word Word wörd's " * 20_000 + "\n" + "x" * 70_000
ROWS = [
    (1, None, "s", "en"),
    (2, "", "s", None),
    (None, "no id\nat all", "s", "en"),
    (4, "One two\nthree", None, "en"),
    (5, "one TWO three", "t", "en"),
    (5, "one TWO three", "t", "en"),  # a repeated row
    (5, "another text of this id\n\n", "t", "en"),
    (7, "ÄÖ one ﬁ 12 two'three", "", "en"),
    (8, LONG, "t", "de"),
    (9, "one two\none", "é", "en"),
    (-3, "12 34 !!", "only digits", "en"),
    (10, "alone", "a", "xx"),
]


@pytest.fixture
def table(spark):
    """documents, with columns whose names clash with the operators' own."""

    def make(rows):
        schema = (
            "doc_id bigint, text string, source string, lang string, n_chars bigint, rank string, "
            "grp string, node string, at string, part int, term string, counts int, ids string, "
            "id string, crc string, tie string, `a.b` int"
        )
        extra = ("r", "g", "n", "a", 1, "t", 2, "i", "x", "c", "t", 3)
        out = [(d, t, s, g, None if t is None else len(t), *extra) for d, t, s, g in rows]
        return spark.createDataFrame(out, schema)

    return make


def many(n, sources=("a", "b", None)):
    random.seed(n)
    words = ["one", "two", "Three", "vier", "fünf", "\n", "6"]
    return [
        (i, " ".join(random.choices(words, k=random.randint(0, 12))), random.choice(sources), random.choice("xy"))
        for i in range(n)
    ]


# --- manifest --------------------------------------------------------------------------------


def only(df, *columns):
    return df.select(*columns)


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_manifest(spark, table, same, monkeypatch, digits):
    monkeypatch.setattr(merkle, "DIGITS", digits)
    for rows in (ROWS, many(1, ["a"]), many(90, ["a"] * 9 + ["b", None])):
        docs = table(rows)
        sql_docs = docs.select("doc_id", "text", "source", "lang", "n_chars")
        same(queries.proved_after_change(docs), audit_sql.OP11, documents=sql_docs)


def test_manifest_of_nothing(table):
    assert merkle.manifest(table([])).count() == 0


def test_manifest_does_not_depend_on_partitions(table):
    docs = table(many(300))
    first = sorted(map(tuple, merkle.manifest(docs).drop("path").collect()), key=str)
    again = merkle.manifest(docs.repartition(7)).drop("path").collect()
    assert first == sorted(map(tuple, again), key=str)


def test_ranks_split_equal_rows(spark):
    """A third of all rows alike: they spread over parts, and ranks have no gaps."""
    rows = spark.range(9000).selectExpr("if(id < 3000, 7, id) AS id", "'g' AS grp", "'same' AS node")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = merkle.ranked(rows, "grp", ["id", "node"]).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(got["rank"]) == list(range(9000))
    assert (got.sort_values("rank").id.diff().dropna() >= 0).all()
    assert (got.n == 9000).all()


def test_manifest_of_other_columns(spark):
    docs = spark.createDataFrame(
        [("k1", "u", "x", 1.5), ("k2", "u", None, 2.0), ("k3", "v", "y", None)],
        "key string, host string, `odd.name` string, score double",
    )
    proved = merkle.manifest(docs, ("key", "odd.name", "score"), "key", "host").collect()
    assert {r.id for r in proved} == {"k1", "k2", "k3"} and len({r.root for r in proved}) == 1
    assert {r.group for r in proved} == {"u", "v"}


# --- divergence ------------------------------------------------------------------------------


@pytest.mark.parametrize("tile, entries", [(1, 3), (2, 1 << 20), (32, 4)])
def test_divergence(table, same, monkeypatch, tile, entries):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "ENTRIES", entries)
    monkeypatch.setattr(divergence, "FLUSH", 5)
    monkeypatch.setattr(divergence, "PIECE", 10)
    for rows in (ROWS, many(200, ["a"] * 9 + ["b", "c", "d", None])):
        for least in (1, 2, 10):
            docs = table(rows)
            sql = audit_sql.OP12.replace("count(*) >= 10", f"count(*) >= {least}")
            same(
                divergence.audit(docs, min_docs=least),
                sql,
                documents=docs.select("text", "source", "lang"),
            )


def test_divergence_of_nothing(table):
    assert divergence.audit(table([])).count() == 0


def test_run_columns_cover_their_block():
    rng = np.random.default_rng(4)
    for _ in range(200):
        rows, width = rng.integers(1, 9), rng.integers(1, 5)
        dense = rng.integers(0, 3, (rows, width))
        dense[0, 0] += not dense.any()
        sizes = rng.integers(1, 4, rows)
        row, pos = np.nonzero(dense)
        seen = set()
        for p, ends, counts in divergence._columns_of(sizes, row, pos, dense[row, pos]):
            seen.add(p)
            assert np.repeat(counts, np.diff(ends, prepend=0)).tolist() == np.repeat(dense[:, p], sizes).tolist()
            assert (counts[1:] != counts[:-1]).all()
        assert seen == set(pos.tolist())


def test_shares_of_huge_counts():
    counts = np.array([0, 5, 10**13], np.int64)
    want = [1 + 10**9 * (int(c) + 2) // (10**14 + 6) for c in counts]
    assert divergence._shares(counts, 10**14, 3).tolist() == want


# --- token files -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def slow_files(tokenizer, rows):
    """(doc_id, start, n_tokens, crc) by the library on whole texts."""
    out, coded = [], []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        coded.append((doc is not None, doc or 0, crc, doc, len(ids)))
    start = 0
    for _, _, crc, doc, n in sorted(coded, key=lambda c: c[:3]):
        out.append((doc, start, n, crc))
        start += n
    return out


@pytest.mark.parametrize("file_ids, block, step", [(1 << 25, 1 << 18, 128), (50, 64, 7), (1, 1, 1)])
def test_token_files(spark, table, tokenizer, monkeypatch, file_ids, block, step):
    rows = [(d, t if t != LONG else t[:4000], s, g) for d, t, s, g in ROWS] + many(60)
    make = token_files.FileWriter.__init__

    def small(self, stream, lengths):
        make(self, stream, lengths, step, block)

    monkeypatch.setattr(token_files.FileWriter, "__init__", small)
    coded = token_files.stage(token_files.encode_ids(table(rows)), "t")
    files = token_files.write_files(coded, file_ids=file_ids)
    got = [tuple(r) for r in token_files.read_files(files).orderBy("start").collect()]
    assert got == slow_files(tokenizer, [(r[0], r[1]) for r in rows])


def test_token_files_of_nothing_and_of_text_ids(spark, table):
    assert token_files.token_files(spark, table([])).count() == 0
    docs = spark.createDataFrame([("b", "x y"), ("a", None), (None, "z")], "name string, body string")
    got = token_files.token_files(spark, docs, "name", "body").orderBy("start").collect()
    assert [(r.id, r.n_tokens) for r in got] == [(None, 2), ("a", 1), ("b", 3)]


def test_token_query(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_token_files(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == slow_files(tokenizer, rows)


def test_words_like_the_library(tokenizer):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        words = token_files.Words(f.read())
    pieces = [
        "a", "B", "jJ", "J̌", "i̇", "İ", "'s", "'S", "'ll", "<|endoftext|>", "<|startoftext|>", "<|", "|>",
        "a", ".", " ", "\n", "\x0b", "\x1c", "\x85", " ", "　", "́", "é", "ß", "Σ", "日本", "½",
        "1", "23", "?.", "–", "_", "🙂", "​", "\x00", "ﬁ", "ing", "The", "<", "'", "&amp;", "ſ", "K",
    ]
    random.seed(5)
    texts = ["".join(random.choices(pieces, k=random.randint(0, 9))) for _ in range(4000)]
    texts += ["y " + "x" * 3_000_000 + " y", LONG, "The Cat\n" * 200_000]
    together = list(words.ids([t.encode() for t in texts]))
    for text, ids in zip(texts, together):
        assert np.frombuffer(ids, words.kind).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        own = np.frombuffer(b"".join(words.ids([text.encode()])), words.kind).tolist()
        assert own == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)[:80]


def test_words_forget(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_BYTES", 2000)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        words = token_files.Words(f.read())
    for text in ("one two. three, four-five six", "two. six seven", "one one. eight 9 ten" * 5) * 20:
        own = np.frombuffer(b"".join(words.ids([text.encode()])), words.kind).tolist()
        assert own == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(words.young) + len(words.old) < 30


def test_words_go_through_the_library_once(tokenizer):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        words = token_files.Words(f.read())
    asked, encode = [], words._encode
    words._encode = lambda texts: asked.extend(texts) or encode(texts)
    stems = [f"{a}ü{b}ß" for a in "abcdefghij" for b in "klmnopqrst"] + ["the", "cat", "2019"]
    texts = [f"({s}, {s}. {s}!? {s.upper()};{s}-{s}2 <{s}, {s}'s," for s in stems]
    ids = list(words.ids([t.encode() for t in texts]))
    for text, own in zip(texts, ids):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own, words.kind).tolist() == want, text
    texts = [f"{s}?! {s}: [{s}] {s};" for s in stems]
    asked.clear()
    ids = list(words.ids([t.encode() for t in texts]))
    for text, own in zip(texts, ids):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own, words.kind).tolist() == want, text
    # Known words beside unknown signs: the signs alone are asked for.
    assert sorted(b" ".join(asked).split()) == [b":", b"?!", b"[", b"]"]
    assert len(asked) == 1


def test_a_word_is_looked_up_once_in_many_texts(tokenizer):
    class Counted(dict):
        asked = 0

        def get(self, word):
            self.asked += 1
            return super().get(word)

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        words = token_files.Words(f.read())
    words.young = Counted()
    texts = ["The cat, the Ünï7 dog!\n" * 30, "", "\x1c", "the dog"] * 20
    ids = list(words.ids([t.encode() for t in texts]))
    for text, own in zip(texts, ids, strict=True):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own, words.kind).tolist() == want
    assert words.young.asked == len(["the", "cat", ",", "Ünï", "7", "dog", "!", "\x1c"])


@pytest.mark.parametrize("group, piece", [(1, 1), (20, 5), (7, 30), (1 << 22, 1 << 20)])
def test_groups_of_texts(spark, table, tokenizer, monkeypatch, group, piece):
    monkeypatch.setattr(token_files, "GROUP", group)
    monkeypatch.setattr(token_files, "PIECE", piece)
    rows = [(d, t if t != LONG else t[:4000], s, g) for d, t, s, g in ROWS] + many(20)
    rows += [(900 + i, t, None, None) for i, t in enumerate(["", " ", "\x1c", "", "a  b\tc", None])]
    got = token_files.encode_ids(table(rows).coalesce(1)).collect()
    for row, (doc, text, *_) in zip(got, rows, strict=True):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert (row.id, np.frombuffer(row.ids, f"<u{row.width}").tolist()) == (doc, want)


def test_word_array_has_the_words_of_each_text():
    chars = "aZéÿ×5½,.'<|-\x1c\u0301 ñ日\n\t "
    random.seed(9)
    for _ in range(300):
        texts = ["".join(random.choices(chars, k=random.randint(0, 12))).encode() for _ in range(9)]
        words, ends = word_array(texts)
        words, ends = words.to_pylist(), ends.tolist()
        assert [words[a:b] for a, b in zip([0, *ends], ends)] == cut_words(texts)
        assert len(words) == ends[-1]
    assert word_array([])[0].to_pylist() == [] and word_array([b""])[1].tolist() == [0]


def test_seams_part_no_piece(tokenizer):
    chars = "aZéÉßÿ×÷İſ5½,.'<|>-_\x1c\x00\u0301\u0338\u00a0ñ 日\n"
    random.seed(8)
    for _ in range(6000):
        text = "".join(random.choices(chars, k=random.randint(1, 8)))
        cut = [w.decode() for w in cut_words([text.encode()])[0]]
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert tokenizer.encode(" ".join(cut), add_special_tokens=False).ids == want, repr(text)


def slow_huffman(counts):
    """The bits of all ids under a plain Huffman code."""
    import heapq

    heap = [(c, i) for i, c in enumerate(counts) if c]
    heapq.heapify(heap)
    total, number = 0, len(counts)
    if len(heap) == 1:
        return heap[0][0]
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total, number = total + a[0] + b[0], number + 1
        heapq.heappush(heap, (a[0] + b[0], number))
    return total


def test_code_is_optimal_and_limited():
    rng = np.random.default_rng(2)
    for _ in range(150):
        counts = rng.integers(0, 50, rng.integers(1, 40)) ** rng.integers(1, 4)
        if not counts.any():
            counts[0] = 1
        free = token_files.code_lengths(counts, 40).astype(np.int64)
        assert (free * counts).sum() == slow_huffman(counts.tolist())
        short = token_files.code_lengths(counts, 6).astype(np.int64)
        used = short[short > 0]
        assert used.max() <= 6 and (len(used) == 1 or (2.0**-used).sum() == 1)
        assert ((short > 0) == (counts > 0)).all()


def written(docs, lengths, step=4, block=10):
    out = io.BytesIO()
    out.close = lambda: None
    writer = token_files.FileWriter(out, lengths, step, block)
    for doc, ids in docs:
        writer.add(doc, np.array(ids, np.int32))
    writer.close()
    return out.getvalue()


class Stream(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_slices_and_damage():
    rng = np.random.default_rng(3)
    counts = rng.integers(1, 100, 30)
    lengths = token_files.code_lengths(counts, 8)
    docs = [(i, rng.integers(0, 30, n).tolist()) for i, n in enumerate([3, 0, 7, 55, 5, 1, 10, 0, 7])]
    whole = [i for _, ids in docs for i in ids]
    data = written(docs, lengths)
    reader = token_files.FileReader(Stream(data))
    for start in range(0, len(whole), 3):
        for stop in (start, start + 1, start + 11, len(whole) + 5):
            assert reader.slice(start, stop).tolist() == whole[start:stop]
    back = [(d, np.concatenate([np.empty(0), *p]).tolist()) for d, _, p in reader.documents()]
    assert back == docs
    for at in range(len(data)):  # no changed byte goes unseen
        broken = data[:at] + bytes([data[at] ^ 5]) + data[at + 1 :]
        with pytest.raises((ValueError, zlib.error)):
            got = token_files.FileReader(Stream(broken))
            read = [(d, np.concatenate([np.empty(0), *p]).tolist()) for d, _, p in got.documents()]
            if read != docs or got.ids != len(whole) or got.blocks.tolist() != reader.blocks.tolist():
                raise ValueError
    for cut in (0, 5, 40, len(data) - 1):
        with pytest.raises(ValueError):
            token_files.FileReader(Stream(data[:cut]))
