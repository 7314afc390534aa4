"""Columns called like those that the operators work with, ids of other types, other column names."""

import pytest
from pyspark.sql import functions as F
from waybill.llm import bpe, chat_format, html_extract, mixing, quality, url_templates, warc

CLASHING = [
    "__quality", "quality_counts", "_quality_counts", "__host", "won_host", "won", "found", "__source",
    "source_text", "__mix_of", "__mix_order", "aside0", "taken_at", "round_trip", "__bpe_round_trip",
    "formatted", "__formatted", "label", "shapes", "f_host", "__good", "a.b",
]


@pytest.fixture
def crowded():
    """A table with all of these columns, each with a value of its own."""

    def make(df):
        return df.select("*", *[F.lit(f"mine {i}").alias(c) for i, c in enumerate(CLASHING)])

    return make


APPLY = {
    "bpe.encode": lambda d: bpe.encode(d),
    "bpe.round_trip": lambda d: bpe.round_trip(d),
    "quality": lambda d: quality.judge(d, None),
    "mixing": lambda d: mixing.mix(d),
    "mixing order": lambda d: mixing.in_training_order(mixing.mix(d)),
    "html": lambda d: html_extract.extract(d, "url", "text"),
    "urls": lambda d: url_templates.judge_urls(d, {"net/": "block"}),
    "chat": lambda d: chat_format.format_turns(d),
}


@pytest.mark.parametrize("name", APPLY)
def test_users_columns_stay(spark, crowded, name):
    rows = [(1, "some words here\nand here", "s", "http://a.net/x", "user"), (2, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, url string, role string")
    got = APPLY[name](crowded(docs))
    for row in got.collect():
        assert [row[c] for c in CLASHING] == [f"mine {i}" for i in range(len(CLASHING))]
    assert {r.doc_id for r in got.collect()} <= {1, 2}
    assert APPLY[name](crowded(docs).limit(0)).count() == 0


def test_conversations_with_other_column_names(spark):
    rows = [("c/1", 0, "user", "hi [INST]"), ("c/1", 1, "assistant", "yes"), (None, 0, None, None)]
    turns = spark.createDataFrame(rows, "talk string, n int, speaker string, body string")
    pieces = chat_format.format_turns(turns, "speaker", "body")
    got = chat_format.read_back(pieces, "talk", "n", "speaker", "body").collect()
    assert {(r.talk, r.n_turns, r.loss_chars) for r in got} == {("c/1", 2, 3), (None, 1, 0)}


@pytest.mark.parametrize("kind", ["string", "int", "bigint"])
def test_archives_of_pages_with_ids_of_any_type(spark, kind):
    ids = ["a b", "x>y+z%", "ü", ""] if kind == "string" else [5, -7, 12, 0]
    same = "<p>" + "word " * 40
    rows = [(ids[0], None, same), (ids[1], "u", same), (ids[2], "v", "short"), (ids[3], "w", None)]
    pages = spark.createDataFrame(rows, f"page_id {kind}, url string, html string")
    got = {r.page_id: r for r in warc.archived(spark, pages).collect()}
    assert all(r.error is None for r in got.values())
    assert set(got) == {None if i == "" else i for i in ids}
    first, again = sorted(ids[:2])
    assert got[again].record_type == "revisit" and got[again].first_page == first
    assert got[first].record_type == "response" and dict(pages.dtypes)["page_id"] == kind


def test_labels_with_another_id_column(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 30) for i in range(6)], "key int, body string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "key int, good int")
    got = quality.labelled_sample(docs, labels, 10, "key", "body", "good", "key").collect()
    assert {(r.id, r.y) for r in got} == {(i, i % 2) for i in range(6)}
