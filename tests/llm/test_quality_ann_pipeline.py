"""Quality rules, nearest neighbours and the corpus pipeline."""

import random
import re

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from waybill.llm import ann, quality, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed)


def test_counts(spark):
    random.seed(1)
    texts = [None, "", " \n\x0b", "a b c", "a a a a", "a b c a b c x", "x\nx\n x\n\nx", "#*$%&|<> a\x1cb\x85c é"]
    texts += [" ".join(random.choices("abcd", k=random.randint(1, 120))) for _ in range(40)]
    texts.append("word another " * 40_000)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, kept int")
    rows = quality.judge(df, None).collect()
    assert len(rows) == len(texts)
    for r in rows:
        if len(r.text or "") < 10_000:
            got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
            assert got == slow_counts(r.text), repr(r.text)
        assert r.kept == (not r.base_failed) and r.probability is None
    assert rows[-1].n_repeat_words == rows[-1].n_words == 80_000
    assert quality.judge(df.limit(0), None).count() == 0


def test_held_out_accuracy(spark):
    """Trained on the labels of even ids, judged on those of odd ids."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    again = quality.train(docs.repartition(5), labels.where("doc_id % 2 = 0"))
    assert np.array_equal(model.weights, again.weights) and model.slope == again.slope
    rows = quality.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [not r.kept for r in rows if r.quality == 0]
    assert len(good) > 100 and len(bad) > 5
    assert np.mean(good) > 0.97 and np.mean(bad) > 0.85


def test_few_or_odd_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (None, "b"), (1, "c")], "doc_id bigint, text string")
    for rows in ([], [(1, 0)], [(1, None), (None, 1), (7, 1)]):
        assert quality.train(docs, spark.createDataFrame(rows, "doc_id bigint, quality int")) is None


def vectors():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 24)).astype(np.float32)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    hot = rows[50][1]
    rows += [(5000 + i, hot) for i in range(900)]  # one vector holds a quarter of the rows
    rows += [(5000, hot), (100, rows[100][1])]  # repeated rows
    nan = float("nan")
    odd = [None, [], [0.0] * 24, [nan] * 24, [1.0, None] * 12, [float("inf")] * 24, [1.0] * 3]
    return rows + [(9000 + 100 * i, v) for i, v in enumerate(odd)] + [(None, hot)]


def exact(rows, k, step):
    seen = {}
    for i, v in rows:
        if i is not None and v and len(v) == 24 and None not in v and np.isfinite(v).all() and any(v):
            seen[i] = v
    ids, x = np.array(list(seen)), np.array(list(seen.values()), np.float64)
    for at in np.flatnonzero(ids % step == 0):
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        d[at] = np.inf
        best = np.lexsort((ids, d))[: min(k, len(ids) - 1)]
        yield int(ids[at]), [(int(ids[j]), float(d[j])) for j in best]


@pytest.mark.parametrize("cut", [20_000, 64])
def test_neighbours(spark, monkeypatch, cut):
    monkeypatch.setattr(ann, "SLICE", cut)
    rows = vectors()
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, h int")
    got = {}
    for r in ann.neighbours(df, F.col("id") % 100 == 0, list_rows=64).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = dict(exact(rows, 10, 100))
    assert got.keys() == want.keys()
    hits = 0
    for q, best in want.items():
        assert len(got[q]) == 10 and got[q] == sorted(got[q], key=lambda p: (p[1], p[0]))
        assert q not in [i for i, _ in got[q]]
        hits += len({i for i, _ in got[q]} & {i for i, _ in best})
        if q >= 5000:  # copies of the hot vector: nearest are its smallest ids
            assert got[q][:9] == best[:9]
    assert hits / sum(map(len, want.values())) >= 0.9


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0]), (100, [1.0]), (3, [2.0])], "vec_id bigint, embedding array<float>")
    rows = ann.neighbours(df, F.col("id") % 100 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows) == [
        (0, 1, 100, 0.0), (0, 2, 3, 1.0), (100, 1, 0, 0.0), (100, 2, 3, 1.0)
    ]
    for few in (df.limit(0), df.limit(1)):
        assert ann.neighbours(few, F.col("id") % 100 == 0).count() == 0


def test_neighbour_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    got = queries.op9_neighbours(spark, sf).toPandas().groupby("query_id").vec_id.agg(set)
    x = np.array(table.embedding.tolist(), np.float64)
    ids = table.vec_id.to_numpy()
    hits = 0
    for q in np.flatnonzero(ids % 100 == 0):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(got[ids[q]] & set(ids[np.lexsort((ids, d))[:10]]))
    assert hits / (10 * len(got)) >= 0.9


def test_pipeline_stages(spark):
    """Each stage against a plain version of its decision on its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "bpe"]
    works = dict(corpus_pipeline.STAGES)

    good = works["quality_rules"](spark, docs, SF).cache()
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    for r in docs.collect():
        if slow_counts(r.text)[-1]:
            assert r.doc_id not in kept
        elif labels.get(r.doc_id) == 1:
            assert r.doc_id in kept

    lines = works["line_dedup"](spark, good, SF).cache()
    seen = {}
    for r in good.collect():
        for x in r.text.split("\n"):
            key = "".join(c.lower() if c < "\x80" else c for c in x.strip(" \t\n\x0b\x0c\r"))
            seen.setdefault(key, set()).add(r.doc_id)
    before = {r.doc_id: r.text for r in good.collect()}
    for r in lines.collect():
        want = [
            x for x in before[r.doc_id].split("\n")
            if not (k := "".join(c.lower() if c < "\x80" else c for c in x.strip(" \t\n\x0b\x0c\r")))
            or len(seen[k]) < 10
        ]
        assert r.text == "\n".join(want) and r.n_chars == len(r.text)

    unique = works["simhash_near_dedup"](spark, lines, SF).cache()
    from tests.llm.test_near_copies import survivors

    kept_ids = survivors([(r.doc_id, r.text) for r in lines.collect()])
    assert sorted(r.doc_id for r in unique.collect()) == kept_ids

    mixed = works["mixing"](spark, unique, SF).cache()
    assert mixed.columns == docs.columns
    copies = mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert 1 <= copies <= 3 and mixed.join(unique, "doc_id", "left_anti").count() == 0

    tokens = works["bpe"](spark, mixed, SF)
    assert tokens.count() == mixed.count() and tokens.where("n_tokens <> size(ids)").count() == 0


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, work in corpus_pipeline.STAGES:
        docs = work(spark, docs, SF)
    assert docs.count() == 0


def test_pipeline_with_odd_rows(spark, docs_of):
    """Nulls in any column, repeated rows, very long and empty texts, clashing columns."""
    words = [f"w{i}" for i in range(3000)]
    random.seed(8)
    good = [" ".join(random.choices(words, k=80)) for _ in range(6)]
    rows = [(i, t, "s") for i, t in enumerate(good)]
    rows += [(0, good[0], "s"), (None, good[1] + " more", None), (20, None, None), (21, "", "t")]
    rows += [(22, " ".join(random.choices(words, k=60_000)), "t"), (23, good[2], "t")]
    docs = docs_of(rows)
    kept = {}
    for name, work in corpus_pipeline.STAGES:
        before, docs = docs, work(spark, docs, SF)
        if name != "bpe":
            assert docs.columns == before.columns
        kept[name] = sorted(str(r.doc_id) for r in docs.select("doc_id").collect())
    assert kept["quality_rules"] == sorted(["0", "0", "1", "2", "3", "4", "5", "None", "22", "23"])
    assert kept["line_dedup"] == kept["quality_rules"]
    assert {"0", "2", "22"} <= set(kept["simhash_near_dedup"]) and "23" not in kept["simhash_near_dedup"]
    assert kept["simhash_near_dedup"].count("0") == 1
    assert set(kept["mixing"]) <= set(kept["simhash_near_dedup"]) and kept["bpe"] == kept["mixing"]
