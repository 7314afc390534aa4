"""The golden extracts from file to answers."""

import datetime

import pytest
import waybill as w
from pyspark.sql import functions as F

from . import golden


@pytest.fixture(scope="module")
def datasets(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("extracts")
    out = {}
    for name, entity in (("shipments", "Shipment"), ("carriers", "Carrier"),
                         ("facilities", "Facility")):
        path = folder / f"{name}.csv"
        path.write_text(getattr(golden, name.upper()))
        out[name] = (w.read_extract(spark, str(path)), entity)
    return out


@pytest.fixture(scope="module")
def result(datasets):
    return w.run_pipeline(datasets)


@pytest.fixture(scope="module")
def shipments(result):
    return result.tables["Shipment"].cache()


def ids(df, column="id"):
    return [r[column] for r in df.orderBy("_ix").collect()]


def test_profile_findings(datasets):
    p = {r.name: r for r in w.profile(datasets["shipments"][0]).collect()}
    assert p["Pickup"].inferred_type == "string"
    assert p["promised"].date_formats == ["ISO", "US", "Long", "D-Mon-Y"]
    assert p["Origin City"].issues[0] == (
        'Inconsistent casing: "Dayton" vs "dayton", "TULSA" vs "Tulsa"'
    )
    assert p["Shipment Status"].issues[0].startswith('Inconsistent casing: "delivered" vs "Delivered"')
    assert p["Cost USD"].issues == [
        "Numeric values contain currency symbols or thousands separators"
    ]
    assert p["Delivered Date"].issues[0] == "High null rate — 67% of values are empty"


def test_every_column_is_mapped(result):
    mapped = result.mappings.collect()
    assert len(mapped) == 21
    assert all(r.source_column and r.confidence >= 0.6 for r in mapped)


def test_records(shipments):
    assert ids(shipments) == ["A-1", "A-2", "A-3", "A-4", "A-5", "A-6", "A-7", "A-8"]
    r = {x.id: x for x in shipments.collect()}
    assert (r["A-2"].origin, r["A-2"].status, r["A-2"].cost_usd) == ("Dayton", "delivered", 1250.5)
    assert r["A-2"].carrier == "Marsh, Hill & Co"
    assert r["A-2"].pickup_date == datetime.date(2025, 3, 2)
    assert (r["A-3"].destination, r["A-3"].status) == ("St. Paul", "in_transit")
    assert r["A-3"].delivery_date is None
    assert r["A-4"].destination == "Winston-Salem"
    assert r["A-4"].promised_date == datetime.date(2025, 3, 7)
    assert r["A-5"].miles is None
    assert r["A-7"].status == "cancelled"
    assert r["A-8"].delivery_date is None


def test_carriers_and_facilities(result):
    assert [tuple(r)[3:] for r in result.tables["Carrier"].orderBy("_ix").collect()] == [
        ("C-1", "Red Fox Lines", "MC-1", 1200.0, 96.4),
        ("C-3", "Heron Freight", "MC-3", None, 88.5),
    ]
    assert [tuple(r)[3:] for r in result.tables["Facility"].orderBy("_ix").collect()] == [
        ("DAY-1", "Dayton", "OH", "cross_dock", 12000.0),
        ("STP-1", "St. Paul", "MN", "warehouse", None),
    ]


def test_report_and_rejects(result):
    report = {r.entity: r for r in result.report.collect()}
    assert (report["Shipment"].records, report["Shipment"].dropped) == (8, 4)
    assert report["Shipment"].warnings == [
        'Row 8 (A-8): unparseable delivery date "soon" — treated as missing',
        'Row 11 (A-11): unrecognized status "teleporting" — row dropped',
    ]
    assert (report["Carrier"].records, report["Carrier"].dropped) == (2, 1)
    assert report["Carrier"].warnings == []
    assert result.totals.first().records == 12
    rejects = {(r.entity, r.record_key): r for r in result.rejects.collect()}
    assert {k: r.reject_reason for k, r in rejects.items()} == {
        ("Shipment", ""): "missing_id",
        ("Shipment", "A-10"): "invalid_pickup_date",
        ("Shipment", "A-11"): "unrecognized_status",
        ("Shipment", "A-12"): "invalid_pickup_date",
        ("Carrier", "C-2"): "missing_name",
        ("Facility", "OMA-1"): "missing_city",
    }
    assert rejects[("Shipment", "A-12")].raw["pickup_date"] == "2025-02-31"


def test_only_eight_warnings_are_shown_but_all_rejects_kept(spark):
    df = spark.range(30).select(
        F.col("id").alias("_ix"),
        F.concat(F.lit("S"), "id").alias("id"),
        *[F.lit("2025-01-01").alias(c) for c in ("pickup_date", "promised_date")],
        F.lit("soon").alias("delivery_date"),
        F.when(F.col("id") % 2 == 0, "nowhere").otherwise("booked").alias("status"),
    )
    mapping = {c: c for c in df.columns if c != "_ix"}
    m = w.materialize(df.repartition(5), mapping, w.SHIPMENT)
    r = m.report.first()
    assert (r.records, r.dropped, len(r.warnings)) == (15, 15, 8)
    assert r.warnings[0].startswith("Row 1 (S0): unparseable delivery date")
    assert r.warnings[1] == 'Row 1 (S0): unrecognized status "nowhere" — row dropped'
    assert r.warnings[2].startswith("Row 2 (S1): unparseable")
    assert m.rejects.count() == 15


def test_lazy_form_gives_the_same(datasets, result, shipments):
    flagged = w.flag_rows(
        datasets["shipments"][0], w.mapping_of(result.mappings, "shipments"), w.SHIPMENT,
        "shipments",
    )
    lazy = w.split_flagged(flagged, w.SHIPMENT, "shipments")
    assert sorted(map(tuple, lazy.records.collect()), key=str) == sorted(
        map(tuple, shipments.drop("dataset_pos").collect()), key=str
    )
    assert lazy.report.first().warnings == result.report.filter("entity = 'Shipment'").first().warnings


def test_unmapped_fields_and_empty_tables(spark):
    df = spark.createDataFrame([(0, "x")], "_ix bigint, id string")
    m = w.materialize(df, {"id": "id"}, w.SHIPMENT)
    assert m.records.count() == 0
    assert m.rejects.first().reject_reason == "missing_pickup_date"
    m = w.materialize(df.limit(0), {"id": "id"}, w.SHIPMENT)
    assert tuple(m.report.first()) == ("Shipment", "extract", 0, 0, [])


def test_output_folder(spark, datasets, tmp_path):
    out = str(tmp_path / "out")
    w.run_pipeline(datasets, output=out)
    assert spark.read.parquet(f"{out}/shipment/accepted=true").count() == 8
    assert spark.read.parquet(f"{out}/shipment/accepted=false").count() == 4
    assert spark.read.parquet(f"{out}/report").count() == 3
    assert spark.read.parquet(f"{out}/mappings").count() == 21
    with pytest.raises(Exception, match="already exists"):
        w.run_pipeline(datasets, output=out)


def test_appended_runs_are_counted_apart(spark, datasets, tmp_path):
    out = str(tmp_path / "out")
    for n in (1, 2):
        got = w.run_pipeline({"shipments": datasets["shipments"]}, output=out, mode="append")
        assert [r.records for r in got.report.collect()] == [8]
        assert got.tables["Shipment"].count() == 8
        assert spark.read.parquet(f"{out}/shipment").where("accepted = 'true'").count() == 8 * n
        assert spark.read.parquet(f"{out}/report").count() == n
    with pytest.raises(ValueError, match="ignore"):
        w.run_pipeline(datasets, output=out, mode="ignore")


def test_large_row_indexes_do_not_mix_extracts(spark):
    rows = [(2 * 10**18 + i, f"k{i}") for i in range(3)]
    frame = spark.createDataFrame(rows, "_ix bigint, code string").selectExpr("*", "'Omaha' as city")
    got = w.run_pipeline({f"e{i}": (frame, "Facility") for i in range(3)})
    rows = got.tables["Facility"].orderBy("dataset_pos", "_ix").collect()
    assert [(r.dataset_id, r.code) for r in rows] == [
        (f"e{i}", f"k{j}") for i in range(3) for j in range(3)
    ]


def test_all_warnings_can_be_read(datasets):
    frame = datasets["shipments"][0]
    many = frame.unionAll(frame).unionAll(frame).unionAll(frame).unionAll(frame)
    got = w.run_pipeline({"shipments": (many.drop("_ix"), "Shipment")})
    assert len(got.report.first().warnings) == 8
    assert got.warnings.count() == 10


def test_many_extracts_in_one_table(spark):
    rows = [(i, f"e{i % 700}", f"k{i}", "" if i % 7 == 0 else "tulsa") for i in range(1400)]
    df = spark.createDataFrame(rows, "_ix bigint, extract string, code string, city string")
    got = w.materialize_many(df, "extract", w.FACILITY)
    report = {r.dataset_id: (r.records, r.dropped) for r in got.report.collect()}
    assert len(report) == 700 and all(sum(v) == 2 for v in report.values())
    assert got.records.count() == 1200 and {r.city for r in got.records.collect()} == {"Tulsa"}


def test_two_extracts_of_one_entity_and_one_without(spark, datasets):
    frame = datasets["shipments"][0]
    got = w.run_pipeline({"a": (frame, "Shipment"), "b": (frame, "Shipment"), "c": (frame, None)})
    t = got.tables["Shipment"]
    assert [r.dataset_id for r in t.orderBy("dataset_pos", "_ix").collect()] == ["a"] * 8 + ["b"] * 8
    warnings = {r.dataset_id: r.warnings for r in got.report.collect()}
    assert warnings["a"] == warnings["b"]
    assert list(got.tables) == ["Shipment"]


def test_overrides_reach_the_tables(spark, datasets):
    overrides = spark.createDataFrame(
        [("carriers", "mc_number", "Name"), ("carriers", "fleet_size", None)],
        "dataset_id string, target_field string, source_column string",
    )
    got = w.run_pipeline({"carriers": datasets["carriers"]}, overrides)
    assert [(r.mc_number, r.fleet_size) for r in got.tables["Carrier"].orderBy("_ix").collect()] == [
        ("Red Fox Lines", None), ("Heron Freight", None)
    ]


def test_key_figures(shipments):
    # Active: all but A-7. Delivered: A-1, A-2, A-4, A-8 (no date). On time: A-1, A-4.
    # Today is 2025-03-08: A-3 is overdue, A-5 is not. Late: A-2.
    k = w.kpis(shipments).first()
    assert (k.total_shipments, k.delivered, k.on_time, k.on_time_pct) == (7, 4, 2, 50.0)
    assert k.avg_transit_days == 3.3  # (3 + 5 + 2) / 3
    assert k.total_cost_usd == 6000.75
    assert k.cost_per_mile == 2.31  # 6000.75 / 2600
    assert k.exception_count == 2
    assert w.reference_date(shipments).first()[0] == datetime.date(2025, 3, 8)
    by = {r.carrier: r for r in w.kpis(shipments, by=["carrier"]).collect()}
    assert by["Red Fox Lines"].exception_count == 1
    assert by["Heron Freight"].on_time_pct == 0.0


def test_key_figures_of_nothing(shipments):
    none = shipments.limit(0)
    assert tuple(w.kpis(none).first()) == (0, 0, 0, 0.0, 0.0, 0.0, 0.0, 0)
    assert w.reference_date(none).first()[0] == datetime.date(2026, 9, 30)
    assert w.status_breakdown(none).count() == 0


def test_given_today(shipments):
    k = w.kpis(shipments, today=datetime.date(2025, 4, 1)).first()
    assert k.exception_count == 3


def test_status_breakdown(shipments):
    assert [tuple(r) for r in w.status_breakdown(shipments).collect()] == [
        ("booked", 1), ("in_transit", 2), ("delivered", 2), ("delayed", 2), ("cancelled", 1)
    ]
    assert [tuple(r) for r in w.status_breakdown(shipments, fold="own").collect()] == [
        ("booked", 1), ("in_transit", 1), ("delivered", 3), ("delayed", 2), ("cancelled", 1)
    ]
    with pytest.raises(ValueError):
        w.status_breakdown(shipments, fold="x")


def test_stored_delayed_status(spark, shipments):
    one = shipments.limit(1).withColumn("status", F.lit("delayed"))
    assert [tuple(r) for r in w.status_breakdown(one).collect()] == [("delayed", 1)]
    late = one.withColumn("delivery_date", F.date_add("promised_date", 1))
    # The derived number replaces the stored one, and is taken out of "delivered".
    assert [tuple(r) for r in w.status_breakdown(late).collect()] == [("delayed", 1)]
    assert [tuple(r) for r in w.status_breakdown(late, fold="own").collect()] == [("delayed", 1)]


def test_exceptions(shipments):
    assert [(r.id, r.reason) for r in w.exceptions_queue(shipments, ordered=True).collect()] == [
        ("A-2", "Delivered 2d late"), ("A-3", "In transit, promised 2025-03-06")
    ]


def test_cost_by_carrier(shipments):
    got = [(r.carrier, r.shipments, r.total_cost, r.cost_per_mile) for r in w.cost_by(shipments).collect()]
    assert got == [
        ("Marsh, Hill & Co", 2, 3250.5, 2.6),
        ("Red Fox Lines", 2, 1800.0, 2.0),
        ("Heron Freight", 3, 950.25, 2.11),
    ]


def test_known_places(shipments):
    assert [r.place for r in w.known_places(shipments).collect()] == [
        "Dayton", "St. Paul", "Omaha", "Tulsa", "Winston-Salem"
    ]


@pytest.mark.parametrize(
    ("question", "intent", "rows", "text"),
    [
        ("Tell me which loads are delayed", "delayed_shipments", ["A-2", "A-3"],
         "2 shipments are currently delayed (delivered after the promised date, or still in "
         "transit past it)."),
        ("any late loads to st. paul", "delayed_shipments", ["A-3"],
         "1 shipment is currently delayed (delivered after the promised date, or still in "
         "transit past it)."),
        ("Show shipments to OMAHA", "lane_filter", ["A-2", "A-6", "A-8"],
         "Found 3 shipments matching that lane."),
        ("shipments from Dayton to Omaha", "lane_filter", ["A-2", "A-6"],
         "Found 2 shipments matching that lane."),
        ("shipments between here and there", "lane_filter",
         ["A-1", "A-2", "A-3", "A-4", "A-5", "A-6", "A-8"],
         "Found 7 shipments matching that lane."),
        ("shipments over $1,200.50", "cost_threshold", ["A-2", "A-4", "A-7"],
         "3 shipments cost more than $1,200.50."),
        ("how is on-time performance", "on_time", ["A-2", "A-3"],
         "On-time performance is 50% — 2 of 4 delivered shipments arrived on or before the "
         "promised date."),
    ],
)
def test_questions_listing_shipments(shipments, question, intent, rows, text):
    a = w.ask(question, shipments)
    assert a.intent == intent
    assert ids(a.table, "ID") == rows
    assert a.text == text


@pytest.mark.parametrize(
    ("question", "intent", "rows", "text"),
    [
        ("How many shipments are there?", "count",
         [("Active shipments", 7), ("Delivered", 4), ("In transit", 2), ("Booked", 1),
          ("Delayed", 2)],
         "There are 7 active shipments in the modeled data (1 cancelled)."),
        ("total cost by carrier", "cost_by_carrier",
         [("Marsh, Hill & Co", 2, "$3,250.50", "$2.60"), ("Red Fox Lines", 2, "$1,800", "$2.00"),
          ("Heron Freight", 3, "$950.25", "$2.11")],
         "Total freight spend is $6,000.75 across 3 carriers."),
        ("what did we spend, what cost?", "total_cost",
         [("Total spend", "$6,000.75"), ("Cost per mile", "$2.31")],
         "Total freight spend across active shipments is $6,000.75 ($2.31 per mile)."),
        ("average days", "avg_transit", [("Avg transit (days)", 3.3)],
         "Average transit time is 3.3 days across 4 delivered shipments."),
        ("which carrier is cheapest", "carrier_rank",
         [("Red Fox Lines", 2, "$1,800", "$2.00"), ("Heron Freight", 3, "$950.25", "$2.11"),
          ("Marsh, Hill & Co", 2, "$3,250.50", "$2.60")],
         "Red Fox Lines is the cheapest at $2.00 per mile across 2 shipments."),
        ("costliest carrier", "carrier_rank",
         [("Red Fox Lines", 2, "$1,800", "$2.00"), ("Heron Freight", 3, "$950.25", "$2.11"),
          ("Marsh, Hill & Co", 2, "$3,250.50", "$2.60")],
         "Marsh, Hill & Co is the most expensive at $2.60 per mile across 2 shipments."),
        ("list carriers", "carrier_list",
         [("Marsh, Hill & Co", 2, "$3,250.50", "$2.60"), ("Red Fox Lines", 2, "$1,800", "$2.00"),
          ("Heron Freight", 3, "$950.25", "$2.11")],
         "3 carriers are active in the modeled data."),
        ("status please", "status_summary",
         [("delivered", 4), ("in_transit", 2), ("booked", 1), ("cancelled", 1)],
         "Shipment status breakdown across 8 records."),
    ],
)
def test_questions_giving_figures(shipments, question, intent, rows, text):
    a = w.ask(question, shipments)
    assert a.intent == intent
    assert [tuple(r) for r in a.table.collect()] == rows
    assert a.text == text


def test_unknown_question(shipments):
    a = w.ask("What is the meaning of life?", shipments)
    assert a.intent == "unknown"
    assert a.table.count() == 6
    assert a.text.startswith("This question is about something")


def test_rank_without_active_carriers(shipments):
    a = w.ask("cheapest carrier", shipments.filter("status = 'cancelled'"))
    assert a.table.count() == 0
    assert a.text == ""


def test_missing_values_show_as_a_dash(shipments):
    t = w.ask("shipments to omaha", shipments).table.orderBy("_ix").collect()
    assert [r["Cost (USD)"] for r in t] == ["1250.5", "—", "300"]


def test_same_figures_for_any_partitioning(spark, datasets):
    frame = datasets["shipments"][0]
    mapping = {f: c for f, c in zip(w.SHIPMENT.field_names, frame.columns)}
    seen = set()
    for n in (1, 8):
        m = w.materialize(frame.repartition(n), mapping, w.SHIPMENT)
        seen.add((tuple(w.kpis(m.records).first()), tuple(m.report.first().warnings),
                  tuple(map(tuple, w.cost_by(m.records).collect()))))
    assert len(seen) == 1
