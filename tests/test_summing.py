"""Exact sums against Python's own ``math.fsum``."""

import math
import random

import pytest
import waybill as w
from pyspark.sql import functions as F


def total(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    return w.exact_sums(df, [], {"s": F.col("v")}, {"n": F.lit(1)}).first()


def test_like_fsum(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for group in range(150):
        low, high = sorted((rng.randint(-1074, 1000), rng.randint(-1074, 1000)))
        values = [
            rng.choice((-1, 1)) * math.ldexp(rng.choice((rng.random(), 1.0)), rng.randint(low, high))
            for _ in range(rng.randint(1, 30))
        ]
        if group % 3 == 0:  # nearly or wholly cancelled
            values += [-v for v in values[: rng.randint(0, len(values))]]
        want[group] = math.fsum(values)
        rows += [(group, v) for v in values]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g int, v double")
    for parts in (1, 5):
        got = {r.g: r.s for r in w.exact_sums(df.repartition(parts), ["g"], {"s": F.col("v")}).collect()}
        assert got == want


@pytest.mark.parametrize(
    ("values", "want"),
    [
        ([], 0.0), ([None], 0.0), ([0.0, -0.0], 0.0), ([1e40, 1.25, -1e40], 1.25),
        ([1e40, 5.0, None], 1e40), ([1e308, 1e308, -1e308], 1e308), ([5e-324] * 3, 1.5e-323),
        ([1e308, 5e-324, -1e308], 5e-324), ([0.1] * 1000, 100.0), ([2.0**53, 1.0, 2.0**-60], 2.0**53 + 2),
        ([2.0**53, 1.0], 2.0**53), ([-65536.0, 65535.999999], -1.00000761449337e-06),
        ([1e308] * 20, math.inf), ([math.inf, 1.0], math.inf), ([1e300, -math.inf], -math.inf),
    ],
)
def test_single_sums(spark, values, want):
    row = total(spark, values)
    assert row.s == (math.fsum(v for v in values if v is not None) if abs(want) < 1e-5 else want)
    assert row.n == len(values)


def test_not_a_number_stays_one(spark):
    assert math.isnan(total(spark, [math.nan, 1.0]).s)


def test_groups_with_odd_names_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1e40, 1, 7), (None, 2.0, 2, 5), ("a", -1e40, 3, 6), ("a", 0.5, None, 9), (None, None, 4, 8)],
        "`key.0` string, limb0 double, count0 int, first0 int",
    )
    got = w.exact_sums(
        df, ["key.0"], {"sum0": F.col("limb0"), "same": F.col("limb0") * 2},
        {"count0": F.col("count0")}, {"first0": F.col("first0")},
    )
    assert got.columns == ["key.0", "sum0", "same", "count0", "first0"]
    assert {tuple(r) for r in got.collect()} == {("a", 0.5, 1.0, 4, 6), (None, 2.0, 4.0, 6, 5)}


def test_key_figures_with_absurd_costs(spark):
    """A cost of 1 with 40 zeros neither ends the query nor swallows other rows."""
    texts = ["1" + "0" * 40, "-1" + "0" * 40, "$1,200.25", "800.50", "N/A"]
    rows = [
        (i, f"S{i}", "Boise", "Omaha", "2026-01-01", "2026-01-05", "2026-01-04", "Summit", "delivered", "1", t, "100")
        for i, t in enumerate(texts)
    ]
    extract = spark.createDataFrame(
        rows,
        "_ix bigint, id string, origin string, destination string, pickup string, promised string, "
        "delivered string, carrier string, status string, weight string, cost string, miles string",
    )
    tables = w.run_pipeline({"x": (extract, "Shipment")}).tables
    figures = w.kpis(tables["Shipment"]).first()
    assert (figures.total_cost_usd, figures.cost_per_mile) == (2000.75, 4.0)
    assert w.cost_by(tables["Shipment"]).first().total_cost == 2000.75
    huge = tables["Shipment"].where("cost_usd > 0 or cost_usd is null")
    assert w.kpis(huge).first().total_cost_usd == 1e40
    assert w.cost_by(huge).first().total_cost == 1e40
