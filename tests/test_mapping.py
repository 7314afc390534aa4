import pytest
from pyspark.sql import functions as F
from waybill import apply_overrides, columns_table, mapping_of, mapping_status, suggest_mappings
from waybill import functions as fn
from waybill.operators.mapping import name_similarity
from waybill.plans.entities import FieldSpec


def suggested(spark, columns, entity="Shipment"):
    rows = suggest_mappings(columns_table(spark, {"d": (columns, entity)})).orderBy("field_pos")
    return {r.target_field: (r.source_column, r.confidence) for r in rows.collect()}


def test_headings_of_every_kind(spark):
    got = suggested(spark, [
        "ship_id", "ORIGIN", "To", "Pickup Date", "due date", "actual delivery", "scac",
        "current status", "gross weight lbs", "amount", "MILES",
    ])
    assert got == {
        "id": ("ship_id", 0.95), "origin": ("ORIGIN", 1.0), "destination": ("To", 0.95),
        "pickup_date": ("Pickup Date", 1.0), "promised_date": ("due date", 0.95),
        "delivery_date": ("actual delivery", 0.95), "carrier": ("scac", 0.95),
        "status": ("current status", 0.85), "weight_lbs": ("gross weight lbs", 0.85),
        "cost_usd": ("amount", 0.95), "miles": ("MILES", 1.0),
    }


def test_headings_of_other_entities(spark):
    got = suggested(spark, ["NAME", "Mc-Number", "size of fleet"], "Carrier")
    assert (got["name"], got["mc_number"]) == (("NAME", 1.0), ("Mc-Number", 1.0))
    assert got["fleet_size"][0] == "size of fleet"
    got = suggested(spark, ["province", "site code", "CITY"], "Facility")
    assert (got["state"], got["code"], got["city"]) == (
        ("province", 0.95), ("site code", 0.85), ("CITY", 1.0)
    )


def test_positions_may_start_anywhere(spark):
    columns = columns_table(spark, {"d": (["xx", "City"], "Facility")})
    shifted = columns.withColumn("col_pos", F.col("col_pos") + 7).filter("column = 'City'")
    rows = suggest_mappings(shifted).collect()
    assert len(rows) == 5 and {r.source_column for r in rows} == {"City", None}


def test_scoring_and_claims_share_one_shuffle(spark):
    plan = suggest_mappings(columns_table(spark, {"d": (["City"], "Facility")}))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_two_overrides_of_a_field(spark):
    mappings = suggest_mappings(columns_table(spark, {"d": (["id", "City"], "Facility")}))
    overrides = spark.createDataFrame(
        [("d", "kind", "City", 1), ("d", "kind", "id", 2)],
        "dataset_id string, target_field string, source_column string, at int",
    )
    with pytest.raises(Exception, match="several overrides of kind"):
        apply_overrides(mappings, overrides).collect()
    final = apply_overrides(mappings, overrides, order_col="at")
    assert final.count() == 5 and mapping_of(final, "d")["kind"] == "id"


@pytest.mark.parametrize(
    ("field", "column", "synonyms", "score"),
    [
        ("pickup_date", "PickupDate", [], 1.0),
        ("origin", "From", ["from"], 0.95),
        ("miles", "Total Miles Run", [], 0.85),
        ("promised_date", "date", [], 0.85),
        ("id", "identity", [], 0.0),
        ("on_time_pct", "time x on", [], 0.6 + 0.2 * 2 / 4),
        ("pickup_date", "Date of Pickup", [], 0.6 + 0.2 * 2 / 3),
        ("carrier", "weight", [], 0.0),
        ("carrier", "***", [], 0.0),
        ("carrier", "", [], 0.0),
    ],
)
def test_similarity(spark, field, column, synonyms, score):
    df = spark.createDataFrame([(column,)], "c string")
    spec = FieldSpec(field, field, synonyms=tuple(synonyms))
    key, words = fn.name_key(F.col("c")), fn.name_tokens(F.col("c"))
    got = df.select(name_similarity(spec, key, words).alias("x")).first().x
    assert got == pytest.approx(score, abs=1e-12)


def test_one_column_goes_to_one_field_and_there_is_no_second_choice(spark):
    # "State" is a synonym of status; "carrier id" would also do for carrier.
    got = suggested(spark, ["id", "carrier id"], "Carrier")
    assert got["id"] == ("id", 1.0)
    assert got["name"] == (None, 0.0)
    got = suggested(spark, ["destination origin"])
    assert got["origin"] == ("destination origin", 0.85)
    assert got["destination"] == (None, 0.0)


def test_earliest_column_wins_a_tie(spark):
    assert suggested(spark, ["x miles", "y miles"])["miles"] == ("x miles", 0.85)


def test_unmapped_fields_are_listed(spark):
    got = suggested(spark, ["nothing", "fits here"])
    assert len(got) == 11
    assert set(got.values()) == {(None, 0.0)}


def test_many_datasets_at_once(spark):
    columns = {f"d{i}": (["id", "city", f"extra {i}"], "Facility") for i in range(50)}
    rows = suggest_mappings(columns_table(spark, columns)).collect()
    assert len(rows) == 250
    assert {r.source_column for r in rows if r.target_field == "city"} == {"city"}


def test_overrides_and_status(spark):
    mappings = suggest_mappings(columns_table(spark, {"d": (["id", "City"], "Facility")}))
    overrides = spark.createDataFrame(
        [("d", "kind", "City"), ("d", "code", None)],
        "dataset_id string, target_field string, source_column string",
    )
    final = apply_overrides(mappings, overrides)
    assert mapping_of(final, "d") == {
        "code": None, "city": "City", "state": None, "kind": "City", "capacity_pallets": None,
    }
    status = {r.target_field: (r.status, r.confidence, r.overridden)
              for r in mapping_status(final).collect()}
    assert status["kind"] == ("manual", 1.0, True)
    assert status["code"] == ("unmapped", 1.0, True)
    assert status["city"] == ("auto · 100%", 1.0, False)
    assert status["state"] == ("unmapped", 0.0, False)
