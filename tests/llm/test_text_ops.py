"""Line dedup, mixing and BPE on edge tables, against SQL and the tokenizers library."""

import hashlib
import json
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from waybill.llm import bpe, line_dedup, mixing, oracle, queries

LONG = "word " * 50_000 + "\n" + "x" * 70_000
EDGE = [
    (1, None, "s"),
    (2, "", "s"),
    (3, "\n\n", None),
    (4, " Same Line \nown 1", "s"),
    (5, "same line\r\nown 2\nSAME LINE", "t"),
    (5, "same line\r\nown 2\nSAME LINE", "t"),  # a repeated row
    (None, "\tsame line", "t"),
    (6, LONG, "t"),
    (7, "ÄÖ same line\nsame line ", ""),
    (7, "another text of this id\nsame line", ""),
]


def test_line_dedup(spark, docs_of, same):
    docs = docs_of(EDGE)
    for threshold in (2, 5, 10):
        cleaned = line_dedup.drop_common_lines(docs, threshold)
        assert cleaned.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
        got = cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
        # the SQL counts ids, and so does the operator; a null id is one value to both
        sql = oracle.OP6.replace(">= 10", f">= {threshold}")
        same(got, sql, documents=docs.select("doc_id", "text"))
    assert line_dedup.drop_common_lines(docs.limit(0)).count() == 0


def test_mixing_edges(spark, docs_of, same):
    docs = docs_of(EDGE)
    mixed = mixing.mix(docs)
    first = F.floor(F.get("rounds", 0)["position"] * 1000000).cast("bigint")
    got = mixed.select("doc_id", "size", "source_size", "target", "taken", first.alias("position_ppm"))
    same(got, oracle.OP5, documents=docs.select("doc_id", "text", "source"))
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.in_training_order(mixed).count() > 0


def test_mixing_meets_targets(spark):
    random.seed(3)
    rows = [
        (i, "w " * random.randint(0, 60), random.choice(["a"] * 20 + ["b", "c", "d", None]))
        for i in range(600)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixed = mixing.mix(docs).toPandas()
    again = mixing.mix(docs.repartition(7)).toPandas()
    by_id = lambda d: d.set_index("doc_id").taken.sort_index()
    assert by_id(mixed).equals(by_id(again))
    assert (mixed.taken <= 3 * mixed["size"]).all()
    total = 0
    for _, part in mixed.groupby("source", dropna=False):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= 1
        assert part.target.iloc[0] <= 3 * part["size"].sum()
        total += part.target.iloc[0]
    assert abs(total - mixed["size"].sum()) < 1e-6


def test_positions_follow_the_schedule(spark):
    """Class 0 falls from weight 6 to 4: half its demand is due before the middle."""
    knots = ((0.0, 6.0), (0.5, 6.0), (1.0, 2.0))
    shares = [0.0, 0.2, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(s,) for s in shares], "s double")
    at = [r[0] for r in df.select(mixing.due_at(F.col("s"), knots)).collect()]
    area = lambda t: 6 * t if t <= 0.5 else 3 + 6 * (t - 0.5) - 4 * (t - 0.5) ** 2
    assert [round(area(t) / 5, 9) for t in at] == shares


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


TEXTS = [
    None, "", " ", "Hello'S it's 12345 <|startoftext|>a b<|endoftext|>", "ΑΣ Σ ΣΑΣ İI ﬁ é́",
    "a" * 500, "ab" * 3000, "!?" * 300, "日本語 ½²", "a\x1cb \x1f'll x'T", "<|endoftext|><|endoftext|>",
    "\x85​ x", "🙂👍🏽", LONG, "Zoë’s naïve café\n\nrésumé",
]


def test_bpe_like_the_library(spark, tokenizer):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    rows = bpe.decode(bpe.encode(docs)).collect()
    digests = {r.doc_id: r for r in bpe.round_trip(docs).collect()}
    for r in rows:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert list(r.ids) == ids, repr(r.text)[:80]
        assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False)
        d = digests[r.doc_id]
        written = " ".join(map(str, ids))
        assert d.n_tokens == len(ids)
        assert d.ids_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert d.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()


def test_bpe_scan_and_heap_agree(spark):
    import json

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        coder = bpe.Bpe(json.load(f))
    random.seed(1)
    for _ in range(300):
        raw = bytes(random.choice(b"abcdeinrst") for _ in range(random.randint(1, 90)))
        parts = [coder.inner[b] for b in raw]
        assert bpe._scan(parts[:], coder.ranks) == bpe._heap(parts[:], coder.ranks)


def test_bpe_query(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op8_bpe(spark, sf).collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.round_trip(spark.createDataFrame([], "text string")).count() == 0


def test_bpe_reads_ids_by_their_decimals(spark):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        coder = bpe.Bpe(json.load(f))
    assert coder.by_decimal == {str(i): t for i, t in coder.tokens.items()}
    assert coder.read("007 7\n+7") == coder.decode([7, 7, 7]) and coder.read("") == ""


@pytest.fixture
def coder():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return bpe.Bpe(json.load(f))


def test_bpe_merges_side_by_side_like_one_by_one(coder):
    random.seed(2)
    pieces = [bytes(random.choices(b"abcdeinrst\xc3\xa9!#", k=random.randint(1, 120))) for _ in range(800)]
    pieces = list(dict.fromkeys([b"a", b"zz", *pieces]))
    found = coder.merged(pieces)
    assert set(found) == set(pieces) and coder.merged([]) == {}
    for p in pieces:
        parts = [*map(coder.inner.__getitem__, p[:-1]), coder.last[p[-1]]]
        assert found[p] == bpe._scan(parts, coder.ranks), p
    pairs = list(coder.ranks)
    a, b = (list(x) for x in zip(*pairs, (0, 0), (49407, 49407)))
    import numpy as np

    got = coder.pairs(np.array(a), np.array(b)).tolist()
    assert got == [coder.ranks.get(p, bpe.NEVER) for p in zip(a, b)]


def test_bpe_learns_words_once_whatever_signs_are_beside_them(coder, tokenizer):
    stems = [f"{a}ü{b}ß" for a in "abcdef" for b in "klmnop"] + ["The", "2019"]
    texts = [f"({s}, {s}. {s}!? {s.upper()};{s}-{s}2 [{s}]\n{s}:" for s in stems]
    asked, merged = [], coder.merged
    coder.merged = lambda pieces: asked.append(pieces) or merged(pieces)
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(asked) == 1  # the unknown words of all texts together
    for text, ids in zip(texts, coder.written([f"{t}?!" for t in texts])):
        want = tokenizer.encode(f"{text}?!", add_special_tokens=False).ids
        assert ids == " ".join(map(str, want))
    assert b"?!" in coder.written_words.young or b":?!" in coder.written_words.young
    assert len(coder.written_words.young) < 2 * len(stems) + 20


def test_bpe_forgets_words_and_knows_special_tokens(coder, tokenizer, monkeypatch):
    coder.words.most = coder.written_words.most = 3000
    monkeypatch.setattr(bpe, "GROUP", 30)
    chars = ["a", "The", "é", "É", "´", "́", "ſ", "'s", "'LL", "5", "½", ",", "?!", "<", "|", "\x1c", "\x85",
             " ", " ", "\n", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "İ", "日本", "×"]
    random.seed(4)
    texts = ["".join(random.choices(chars, k=random.randint(0, 9))) for _ in range(3000)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for text, ids, written, own in zip(texts, coder.encode(texts), coder.written(texts), want):
        assert ids.tolist() == own and written == " ".join(map(str, own)), repr(text)
        assert coder.read(written) == coder.decode(own)
    assert len(coder.words.young) + len(coder.words.old) < 60
