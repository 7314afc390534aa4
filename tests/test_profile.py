"""The profiler against hand-made columns and a plain Python count."""

import random
import re

import pytest
from pyspark.sql import functions as F
from waybill import issue_total, profile
from waybill.operators.profiling import column_values


def column(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "_ix bigint, c string")
    return profile(df.repartition(3)).first()


def test_date_formats(spark):
    p = column(spark, ["1999-12-31", "01/15/2000", "February 7 2000", "21-Mar-2000"])
    assert p.inferred_type == "date"
    assert p.date_formats == ["ISO", "US", "Long", "D-Mon-Y"]
    assert p.issues == ["Mixed date formats in one column: ISO, US, Long, D-Mon-Y"]


def test_formats_in_order_of_appearance(spark):
    p = column(spark, ["30-Nov-2011", "", "2011-12-02", "5-Jan-2012"])
    assert p.date_formats == ["D-Mon-Y", "ISO"]
    assert p.issues[0] == "High null rate — 25% of values are empty"


def test_typos_and_casing(spark):
    p = column(spark, ["granite", "Granite", "garnite", "sandstone"])
    assert p.inferred_type == "string"
    assert p.issues == [
        'Inconsistent casing: "granite" vs "Granite"',
        'Possible typos: "garnite" ≈ "granite", "garnite" ≈ "Granite"',
    ]


def test_rarer_value_is_the_typo(spark):
    p = column(spark, ["abcd", "abce", "abce", "zzzzzz"])
    assert p.issues == ['Possible typos: "abcd" ≈ "abce"']


def test_three_casing_groups_and_three_pairs_at_most(spark):
    p = column(spark, ["aaaaaaa", "AAAAAAA", "bbbbbbb", "BBBBBBB", "ccccccc", "CCCCCCC",
                       "ddddddd", "DDDDDDD", "Bbbbbbb"])
    assert p.issues == [
        'Inconsistent casing: "aaaaaaa" vs "AAAAAAA", "bbbbbbb" vs "BBBBBBB" vs "Bbbbbbb", '
        '"ccccccc" vs "CCCCCCC"'
    ]
    p = column(spark, ["x1", "x2", "x3", "x4"])
    assert p.issues == ['Possible typos: "x2" ≈ "x1", "x3" ≈ "x1", "x4" ≈ "x1"']


@pytest.mark.parametrize(("n", "flagged"), [(25, True), (26, False)])
def test_typo_check_is_for_columns_of_few_values(spark, n, flagged):
    p = column(spark, [f"value {i:02d}" for i in range(n)])
    assert any(i.startswith("Possible typos") for i in p.issues) == flagged


def test_currency_marks_are_still_float(spark):
    p = column(spark, ["12.25", "$3,456.70", "8"])
    assert p.inferred_type == "float"
    assert p.issues == ["Numeric values contain currency symbols or thousands separators"]


def test_null_rate(spark):
    p = column(spark, ["", "", "", "17", "", "", "", ""])
    assert (p.null_count, p.null_rate, p.distinct_count) == (7, 0.875, 1)
    assert p.issues == ["High null rate — 88% of values are empty"]
    assert column(spark, ["a", "bcd", "efgh", "ijklm", ""]).issues == []


@pytest.mark.parametrize(
    ("values", "kind"),
    [(["0", "1"], "integer"), (["-5", "12"], "integer"), (["1,000"], "float"), (["1.5", "2"], "float"),
     (["yes", "N", "1"], "boolean"), (["2026-02-31"], "date"), (["", ""], "integer"),
     ([], "integer"), (["1", "x"], "string"), (["1\n"], "float")],
)
def test_types(spark, values, kind):
    p = column(spark, values)
    assert p.inferred_type == kind
    assert p.samples == [v for v in values if v][:4]


def test_stray_white_space(spark):
    assert column(spark, ["abcdef", " uvwxyz"]).issues == [
        "Values contain leading or trailing whitespace"
    ]
    assert column(spark, ["abcdef", "uvwxyz "]).issues == [
        "Values contain leading or trailing whitespace"
    ]


def test_columns_keep_their_order_and_odd_names(spark):
    df = spark.createDataFrame([(0, "1", "x", "2")], "_ix bigint, `b.c` string, A string, a string")
    got = profile(df).collect()
    assert [(p.pos, p.name, p.inferred_type) for p in got] == [
        (0, "b.c", "integer"), (1, "A", "string"), (2, "a", "integer")
    ]


def test_issue_total(spark):
    df = spark.createDataFrame([(0, "", "$5")], "_ix bigint, a string, b string")
    assert issue_total(profile(df)).first().issue_total == 2


def test_wide_table_in_one_pass(spark):
    n = 150
    df = spark.range(3).select(
        F.col("id").alias("_ix"), *[(F.col("id") * i).cast("string").alias(f"c{i}") for i in range(n)]
    )
    plan = column_values(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
    got = profile(df).collect()
    assert [p.name for p in got] == [f"c{i}" for i in range(n)]
    assert [p.distinct_count for p in got] == [1] + [3] * (n - 1)


def test_against_plain_python_with_a_dominant_value(spark):
    rng = random.Random(3)
    words = ["Alpha", "alpha", "beta", "BETA", "Beta", "", "", "gamma", "delta", "epsilon"]
    values = [rng.choice(words) if rng.random() < 0.6 else "alpha" for _ in range(3000)]
    p = column(spark, values)
    filled = [v for v in values if v]
    seen = list(dict.fromkeys(filled))
    assert p.null_count == len(values) - len(filled)
    assert p.distinct_count == len(seen)
    assert p.samples == seen[:4]
    groups = {}
    for v in seen:
        groups.setdefault(v.lower(), []).append(v)
    shown = ['"' + '" vs "'.join(g) + '"' for g in groups.values() if len(g) > 1][:3]
    assert "Inconsistent casing: " + ", ".join(shown) in p.issues


def test_same_result_for_any_partitioning(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("abcABC"), str(rng.randint(0, 400)), rng.choice(["", "x", "2020-01-01"]))
            for i in range(2000)]
    df = spark.createDataFrame(rows, "_ix bigint, a string, b string, c string")
    assert profile(df.repartition(1)).collect() == profile(df.repartition(8, "a")).collect()


def test_samples_when_many_rows_share_an_index(spark):
    df = spark.range(2000).select(F.lit(1).alias("_ix"), F.col("id").cast("string").alias("v"))
    assert profile(df).first().samples == ["0", "1", "10", "100"]


def test_number_of_casings_listed_can_be_bounded(spark):
    df = spark.createDataFrame([(0, "ab"), (1, "AB"), (2, "Ab"), (3, "zzzzz")], "_ix bigint, c string")
    bounded = profile(df, max_casings=2).first().issues
    assert 'Inconsistent casing: "ab" vs "AB"' in bounded
    assert 'Inconsistent casing: "ab" vs "AB" vs "Ab"' in profile(df).first().issues


def test_findings_read_only_the_columns_they_concern(spark):
    df = spark.createDataFrame([(0, "ab", "1"), (1, "AB", "2")], "_ix bigint, c string, n string")
    plan = profile(df)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*(EqualTo|In)\(pos", plan)


LONG_A, LONG_B = "word " * 60 + "end", "Other " * 50 + "text"


def test_long_values_like_short_ones(spark):
    """The findings do not change where values are told apart by hashes."""
    rng = random.Random(6)
    pools = [
        [LONG_A, LONG_A.upper(), LONG_A.title(), LONG_B, LONG_B + "x", LONG_B + "y", "", "short", "Short"],
        ["9" * 200, "1", "-" + "8" * 150, ""],
        ["1." + "5" * 200, "$" + "1," * 100 + "5", "7"],
        [" " * 200 + "2020-01-02", "2021-03-04", "Jan 5 2020" + " " * 150],
        [f"{i} " + "tail " * 40 for i in range(300)],
    ]
    rows = [(i, *[rng.choice(p) for p in pools]) for i in range(1500)]
    df = spark.createDataFrame(rows, "_ix bigint, a string, b string, c string, d string, e string")
    got = profile(df.repartition(3)).collect()
    import waybill.operators.profiling as module

    before = module.LONG
    module.LONG = 10_000
    try:
        want = profile(df.repartition(3)).collect()
    finally:
        module.LONG = before
    assert got == want
    assert got[0].issues[0].startswith('Inconsistent casing: "') and LONG_A in got[0].issues[0]
    assert [p.inferred_type for p in got] == ["string", "integer", "float", "date", "string"]


def test_long_texts_do_not_travel(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("_ix", F.col("doc_id"))
    values = column_values(docs, ["text"])
    size = sum(F.coalesce(F.octet_length(c), F.lit(0)) if c == "value" else F.lit(8) for c in values.columns)
    shuffled = values.agg(F.sum(size)).first()[0]
    assert shuffled * 10 < docs.agg(F.sum(F.octet_length("text"))).first()[0]


def test_approximate_counts(spark):
    n = 40_000
    df = spark.range(n).select(
        F.col("id").alias("_ix"),
        F.concat(F.lit("v"), F.col("id") % 30_000).alias("many"),
        (F.col("id") % 7).cast("string").alias("few"),
        F.when(F.col("id") % 2 == 0, "").otherwise(F.lit("2020-01-01")).alias("day"),
        F.concat(F.repeat(F.lit("long "), F.lit(50)), F.col("id") % 5000).alias("text"),
    )
    exact, got = profile(df).collect(), profile(df, approx=True).collect()
    for a, b in zip(exact, got):
        assert abs(a.distinct_count - b.distinct_count) <= 0.03 * a.distinct_count
        for same in ("name", "inferred_type", "null_count", "null_rate", "samples", "date_formats"):
            assert a[same] == b[same]
    plan = profile(df, approx=True)._jdf.queryExecution().executedPlan().toString()
    assert "column-values" not in plan


def test_many_datasets_in_as_many_jobs_as_one(spark):
    from waybill import profile_many

    def jobs(work):
        tag = f"jobs-{work.__name__}"
        spark.sparkContext.setJobGroup(tag, tag)
        out = work()
        spark.sparkContext.setJobGroup("other", "other")
        return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))

    tables = {
        f"d{i}": spark.createDataFrame([(0, f"x{i}", LONG_A), (1, "", "b")], f"_ix bigint, c{i} string, same string")
        for i in range(60)
    }

    def few():
        return profile_many(dict(list(tables.items())[:3])).collect()

    def many():
        return profile_many(tables).collect()

    (_, some), (got, all_) = jobs(few), jobs(many)
    assert all_ <= some + 1
    assert [(r.dataset_id, r.pos, r.name) for r in got] == [
        (f"d{i}", pos, name) for i in range(60) for pos, name in enumerate((f"c{i}", "same"))
    ]
    for i in (0, 59):
        alone = profile(tables[f"d{i}"]).collect()
        assert [r[:-1] for r in map(tuple, got) if r[-1] == f"d{i}"] == [tuple(r) for r in alone]
