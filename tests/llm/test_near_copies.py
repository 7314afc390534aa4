"""Near copies of the pipeline's stage against brute-force Jaccard."""

import random
from pathlib import Path

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from waybill.llm import mixing, near_copies, simhash
from waybill.sources import staging_root


def slow_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def survivors(rows):
    """The smallest id of each component of all pairs at 0.8; ids are unique here."""
    sets = [slow_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or 5 * len(a & b) >= 4 * len(a | b):
                up[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(least.values())


def texts():
    random.seed(11)
    words = [f"w{i}" for i in range(4000)]
    rows = [None, "", " \n", "One two", "one TWO", "a b c d e", "a b c d e f", "same " * 3000, "same " * 9]
    passage = random.choices(words, k=60)  # in many texts that are no copies of each other
    rows += [" ".join(random.choices(words, k=40) + passage) for _ in range(60)]
    for n in (12, 40, 150, 600):
        for _ in range(6):
            base = random.choices(words, k=n)
            rows.append(" ".join(base))
            for edits in (1, 2, n // 60, n // 50, n // 45, n // 40, n // 30, n // 20):
                copy = base[:]
                for _ in range(edits):
                    copy[random.randrange(n)] = random.choice(words)
                rows.append(" ".join(copy))
            rows += [" ".join(base[: int(n * part)]) for part in (0.7, 0.79, 0.8, 0.81, 0.9)]
    base = random.choices(words, k=200)  # one large group, by steps away from its first
    for _ in range(80):
        copy = base[:]
        for _ in range(random.randint(0, 4)):
            copy[random.randrange(200)] = random.choice(words)
        rows.append(" ".join(copy))
        base = copy if random.random() < 0.1 else base
    random.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("pairs, rounds, sample", [(8, 6, 10_000), (0, 2, 0)])
def test_stage_against_brute_force_jaccard(spark, docs_of, monkeypatch, pairs, rounds, sample):
    monkeypatch.setattr(near_copies, "PAIRS", pairs)
    monkeypatch.setattr(near_copies, "ROUNDS", rounds)
    monkeypatch.setattr(near_copies, "SAMPLE", sample)
    rows = texts()
    docs = docs_of([(d, t, "s") for d, t in rows])
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == survivors(rows)


def test_stage_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == survivors(rows)


def test_a_passage_that_the_sample_missed(spark, monkeypatch):
    """Unlike texts that share a passage: pairs compared stay near their number."""
    monkeypatch.setattr(near_copies, "HOT", 100)
    random.seed(4)
    words = [f"w{i}" for i in range(20_000)]
    passage = random.choices(words, k=60)
    rows = [(i, " ".join(random.choices(words, k=40) + passage)) for i in range(1500)]
    rows += [(i + 5000, rows[i][1] + " more") for i in range(0, 300, 10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    compared = []
    verified = near_copies._verified

    def counting(pairs, nodes, texts):
        compared.append(pairs.count())
        return verified(pairs, nodes, texts)

    frequent = near_copies._frequent
    calls = []

    def missed(texts):
        calls.append(1)
        none = np.empty(0, np.int64)
        return frequent(texts) if len(calls) > 1 else (none, none)

    monkeypatch.setattr(near_copies, "_verified", counting)
    monkeypatch.setattr(near_copies, "_frequent", missed)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
    assert got == {i: i - 5000 if i >= 5000 else i for i, _ in rows}
    assert len(calls) > 1 and sum(compared) < 5 * len(rows)


def test_phrases_that_a_sample_of_a_large_table_misses(spark, monkeypatch):
    """Unlike texts that share phrases too rare for the sample are not compared on whole sets."""
    monkeypatch.setattr(near_copies, "PAIRS", 1)
    monkeypatch.setattr(near_copies, "SAMPLE", 0)
    random.seed(8)
    words = [f"w{i}" for i in range(20_000)]
    phrases = [" ".join(random.choices(words, k=5)) for _ in range(60)]

    def text():
        parts = [" ".join(random.choices(words, k=9)) for _ in range(12)]
        return " ".join(p + " " + f for p, f in zip(parts, random.sample(phrases, 12)))

    rows = [(i, text()) for i in range(300)]
    rows += [(i + 1000, rows[i][1] + " more") for i in range(0, 300, 20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    compared = []
    verified = near_copies._verified

    def counting(pairs, nodes, texts):
        compared.append(pairs.count())
        return verified(pairs, nodes, texts)

    monkeypatch.setattr(near_copies, "_verified", counting)
    kept = near_copies.drop_near_copies(docs)
    assert sorted(r.doc_id for r in kept.collect()) == survivors(rows) == list(range(300))
    assert sum(compared) < 50


def test_staged_tables_are_dropped(spark):
    rows = texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")

    def held():
        found = Path(staging_root(spark).removeprefix("file:")).glob("*/part-*.parquet")
        return {p for p in found if p.parent.name.startswith("copies")}

    before = held()
    kept = near_copies.drop_near_copies(docs)
    left = {p.parent.name.rpartition("-")[0] for p in held() - before}
    assert left <= {"copies-rows", "copies-links", "copies-alike"}
    assert sorted(r.doc_id for r in kept.collect()) == survivors(rows)


def exchanges_of(spark, make):
    """How often rows are dealt out by the plan of a DataFrame when no side of a join is broadcast."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, -1)
    try:
        result = make()
        plan = result._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange "), result.collect()
    finally:
        spark.conf.unset(limit)


def test_texts_are_dealt_out_once_for_joins_and_choices(spark):
    rows = [(None, "a b", None), (None, "a b", None), (1, "a b", "s"), (2, "c", "t"), (2, "c", "t"), (3, "c", "t")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("t"))
    by_id = found.withColumn("component", F.coalesce("id", F.lit(0)))
    # By component, and both sides of the join.
    count, kept = exchanges_of(spark, lambda: simhash.keep_first(docs, by_id, "doc_id", "text"))
    assert count == 3
    assert sorted(map(tuple, kept), key=str) == sorted({*rows}, key=str)
    # Both sides of the join, and the sort.
    count, mixed = exchanges_of(spark, lambda: mixing.in_training_order(mixing.mix(docs)))
    assert count == 3
    assert {r.doc_id for r in mixed} == {None, 1, 2, 3}
