"""Bulk classification against one-by-one answers and hand-made cases."""

import pytest
import waybill as w
from pyspark.sql import functions as F
from waybill import classify_questions

CASES = [
    ("Which shipments are late to arrive?", "delayed_shipments", None, None, None),
    ("How many shipments are late", "delayed_shipments", None, None, None),
    ("overdue from fort worth into el paso", "delayed_shipments", "El Paso", "Fort Worth", None),
    ("lately there is status", "status_summary", None, None, None),
    ("at-risk", "delayed_shipments", None, None, None),
    ("Show shipments to Paso", "lane_filter", "Paso", None, None),
    ("Show shipments to EL PASO tomorrow", "lane_filter", "El Paso", None, None),
    ("shipment into el paso", "unknown", None, None, None),
    ("shipments to nowhere", "lane_filter", None, None, None),
    ("shipments to x from worth, el paso", "lane_filter", None, "Worth", None),
    ("how many shipments", "count", None, None, None),
    ("total spend", "unknown", None, None, None),
    ("total cost", "total_cost", None, None, None),
    ("spending cost BY CARRIER", "cost_by_carrier", None, None, None),
    ("avg days", "avg_transit", None, None, None),
    ("ontime", "on_time", None, None, None),
    ("on time", "on_time", None, None, None),
    ("on  time", "unknown", None, None, None),
    ("cheapest carrier", "carrier_rank", None, None, None),
    ("cheapest carriers", "unknown", None, None, None),
    ("list carriers", "carrier_list", None, None, None),
    ("shipments over 1,500.75", "cost_threshold", None, None, 1500.75),
    ("shipments above $7 or over 9", "cost_threshold", None, None, 9.0),
    ("shipments greater than  20", "cost_threshold", None, None, 20.0),
    ("shipments over ,", "cost_threshold", None, None, 0.0),
    ("moreover 12 shipments", "cost_threshold", None, None, 12.0),
    ("over 12 loads", "unknown", None, None, None),
    ("", "unknown", None, None, None),
]
PLACES = ["Fort Worth", "El Paso", "Paso", "Worth", "Winston-Salem", ""]


@pytest.fixture(scope="module")
def places(spark):
    return spark.createDataFrame(
        [(p, i, True) for i, p in enumerate(PLACES)],
        "place string, first_ix bigint, origin_first boolean",
    )


def test_rules(spark, places):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, question string")
    got = w.classify_questions(df, places).orderBy("i").collect()
    assert len(got) == len(CASES)
    for r, (text, intent, to_city, from_city, threshold) in zip(got, CASES):
        assert (r.intent, r.to_city, r.from_city, r.threshold) == (
            intent, to_city, from_city, threshold
        ), text


def test_rank_direction(spark, places):
    df = spark.createDataFrame([("cheapest carrier",), ("costliest carrier",), ("status",)], "q string")
    got = {r.q: r.cheapest for r in w.classify_questions(df, places, "q").collect()}
    assert got == {"cheapest carrier": True, "costliest carrier": False, "status": None}


def test_equally_long_places_go_to_the_one_seen_first(spark):
    known = spark.createDataFrame(
        [("Toledo", 1, True), ("Dayton", 1, False), ("Fresno", 0, False)],
        "place string, first_ix bigint, origin_first boolean",
    )
    df = spark.createDataFrame([("shipments to dayton or toledo",)], "question string")
    assert w.classify_questions(df, known).first().to_city == "Toledo"


def test_hot_phrase_keeps_every_question(spark, places):
    df = spark.range(5000).selectExpr(
        "id", "case when id % 3 = 0 then 'shipments to el paso' else 'status' end question"
    )
    got = w.classify_questions(df, places)
    assert got.count() == 5000
    assert got.filter("to_city = 'El Paso'").count() == 1667


def test_null_question(spark, places):
    df = spark.createDataFrame([(None,)], "question string")
    assert w.classify_questions(df, places).first().intent == "unknown"


def test_a_phrase_of_most_questions_is_split(spark):
    """A hot pair of phrases: adaptive execution deals its questions to several tasks."""
    places = spark.createDataFrame(
        [("Omaha", 0, True), ("Tulsa", 1, True)], "place string, first_ix bigint, origin_first boolean"
    )
    text = F.when(F.col("id") % 50 == 0, F.concat(F.lit("shipments to tulsa "), "id")).otherwise(
        F.concat(F.lit("show shipments to omaha "), F.col("id"))
    )
    asked = spark.range(0, 60_000, 1, 8).select("id", text.alias("question"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        labelled = classify_questions(asked, places)
        got = {tuple(r) for r in labelled.groupBy("to_city").count().collect()}
        assert got == {("Omaha", 58_800), ("Tulsa", 1_200)}
        labelled.write.format("noop").mode("overwrite").save()
        rows = labelled.persist()
        rows.count()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        rows.unpersist()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
