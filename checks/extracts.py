"""Messy extracts derived from the star-schema tables, without randomness.

Each is a query over the whole of the given tables, so work grows with them.
"""

from __future__ import annotations

from math import ceil

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from waybill.sources.staging import new_staging_path

CITIES = (
    "Dayton", "Toledo", "Omaha", "St. Paul", "Winston-Salem", "El Paso", "Boise", "Tulsa",
)

# Header of the shipment extract for each target field.
SHIPMENT_HEADERS = {
    "id": "shipment_id",
    "origin": "Origin City",
    "destination": "destCity",
    "pickup_date": "PickupDate",
    "promised_date": "promised_date",
    "delivery_date": "Delivery Date",
    "carrier": "CarrierName",
    "status": "Shipment Status",
    "weight_lbs": "Weight (lbs)",
    "cost_usd": "Cost USD",
    "miles": "Distance Miles",
}
CARRIER_HEADERS = {
    "id": "CarrierID",
    "name": "carrier name",
    "mc_number": "MC",
    "fleet_size": "Fleet Size",
    "on_time_pct": "On-Time Pct",
}
FACILITY_HEADERS = {
    "code": "Facility Code",
    "city": "city",
    "state": "Province",
    "kind": "type",
    "capacity_pallets": "capacity",
}

# Spellings of each status: plain, separators and capitals, typos.
STATUS_SPELLINGS = {
    "cancelled": ("cancelled", "CANCELED", "canceled"),
    "booked": ("booked", "Booked", "boked"),
    "in_transit": ("in_transit", "IN TRANSIT", "in-transit"),
    "delivered": ("delivered", "Delivered", "delviered"),
}

# Headers under which clients send shipments: one list per style.
HEADER_STYLES = (
    ("shipment_id", "origin", "destination", "pickup_date", "promised_date", "delivery_date",
     "carrier_name", "status", "weight_lbs", "cost_usd", "miles"),
    ("ShipID", "From", "To", "TenderDate", "DueDate", "ActualDelivery",
     "SCAC", "State", "LBS", "Amount", "Distance"),
    ("Load Ref", "Origin City Name", "Dest", "Date of Pickup", "ETA Date", "Delivery Date Actual",
     "Carrier", "Shipment Status", "Gross Weight Lbs", "Freight Cost USD", "Miles Total"),
    ("id", "originCity", "destinationCity", "pickup", "promised", "delivered",
     "carrier", "carrierName", "weight", "cost", "***"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(options: tuple[str, ...], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (i + 1).cast("int"))


def _date_text(d: Column, style: Column) -> Column:
    return (
        F.when(style == 0, d.cast("string"))
        .when(style == 1, F.date_format(d, "MM/dd/yyyy"))
        .when(style == 2, F.date_format(d, "MMM d yyyy"))
        .otherwise(F.date_format(d, "d-MMM-yyyy"))
    )


def _city_text(nation: Column, line: Column) -> Column:
    city = _pick(CITIES, nation % 8)
    return F.when(line % 3 == 0, F.lower(city)).when(line % 3 == 1, F.upper(city)).otherwise(city)


_WRITTEN: dict[tuple, tuple[str, DataFrame]] = {}
TASK_LINES = 250_000
_ORDER = "order_key"  # beside the texts: tells where something is planted


def shipment_extract(spark: SparkSession, sf_dir: str, planted: bool = False) -> DataFrame:
    """The messy shipment extract; ``planted`` adds rows to reject.

    Extracts arrive as files; this writes the texts once per application, and
    reads them from then on. What is planted is put over the texts as they are
    read, so that both extracts come from the same files.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    found = None
    if key in _WRITTEN:
        path, df = _WRITTEN[key]
        try:
            found = spark.read.schema(df.schema).parquet(path)
        except AnalysisException:  # the staging folder was emptied
            pass
    if found is None:
        texts = shipment_texts(spark, sf_dir)
        path = new_staging_path(spark, "extract")
        texts.write.parquet(path)
        _WRITTEN[key] = (path, texts)
        found = spark.read.schema(texts.schema).parquet(path)
    return (with_planted(found) if planted else found).drop(_ORDER)


def with_planted(texts: DataFrame) -> DataFrame:
    """The texts with missing ids, impossible pickup dates and unknown statuses in some orders."""
    wrong = {"id": (97, ""), "pickup_date": (83, "13/45/2026"), "status": (89, "teleporting")}
    return texts.withColumns(
        {
            SHIPMENT_HEADERS[f]: F.when(F.col(_ORDER) % n == 0, F.lit(text)).otherwise(
                F.col(f"`{SHIPMENT_HEADERS[f]}`")
            )
            for f, (n, text) in wrong.items()
        }
    )


def shipment_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as messy shipments, with the order that each belongs to.

    Only used columns travel. Orders meet their customers first; the many line
    items then travel by order, and are numbered where that has brought them. A
    task gets some ``TASK_LINES`` of them, however many there are.
    """
    lines = table(spark, sf_dir, "lineitem")
    tasks = ceil(lines.count() / TASK_LINES)

    def dealt(df: DataFrame, key: str) -> DataFrame:
        # What each core takes at once is left to adaptive execution.
        return df.repartition(tasks, key) if tasks > spark.sparkContext.defaultParallelism else df

    orders = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("pickup"))
        .join(
            table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
            F.col("o_custkey") == F.col("c_custkey"),
        )
        .select("o_orderkey", "pickup", "c_nationkey")
    )
    used = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    base = (
        dealt(used, "l_orderkey")
        .join(dealt(orders, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(
            table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_name"),
            F.col("l_suppkey") == F.col("s_suppkey"),
        )
    )
    # Lines alike in all of these have the same texts, so their order does not show.
    same_line = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "pickup", "c_nationkey"
    )
    order, line, part, supp = (
        F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    )
    step, style = part % 20, order % 4
    pickup = F.col("pickup")
    promised = F.date_add(pickup, (supp % 5 + 3).cast("int"))
    delivery = F.date_add(pickup, (F.col("l_quantity").cast("bigint") % 9 + 1).cast("int"))

    ident = F.concat_ws("-", F.lit("SHP"), order, line)
    ident = F.when(line == 7, F.concat(F.lit("  "), ident, F.lit("\t"))).otherwise(ident)
    pickup_text = _date_text(pickup, style)
    status = (
        F.when(step == 0, _pick(STATUS_SPELLINGS["cancelled"], supp % 3))
        .when(step <= 2, _pick(STATUS_SPELLINGS["booked"], supp % 3))
        .when(step <= 6, _pick(STATUS_SPELLINGS["in_transit"], supp % 3))
        .otherwise(_pick(STATUS_SPELLINGS["delivered"], supp % 3))
    )
    price = F.col("l_extendedprice")
    values = {
        "id": ident,
        "origin": _city_text(F.col("s_nationkey"), line),
        "destination": _city_text(F.col("c_nationkey"), line),
        "pickup_date": pickup_text,
        "promised_date": _date_text(promised, style),
        "delivery_date": F.when(step == 3, F.lit("TBD"))
        .when(step < 7, F.lit(""))
        .otherwise(_date_text(delivery, style)),
        "carrier": F.col("s_name"),
        "status": status,
        "weight_lbs": (F.col("l_quantity") * 400).cast("bigint").cast("string"),
        "cost_usd": F.when(
            line % 3 == 0, F.concat(F.lit("$"), F.format_number(price, 2))
        ).otherwise(price.cast("string")),
        "miles": (part % 900 + 100).cast("string"),
    }
    return base.select(
        *[values[f].alias(h) for f, h in SHIPMENT_HEADERS.items()],
        # Several lines may share order and line number: they are counted apart.
        ((order * 8 + line) * (1 << 20) + F.row_number().over(same_line)).alias("_ix"),
        order.alias(_ORDER),
    )


def carrier_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as carriers; some names are blank."""
    key = F.col("s_suppkey")
    values = {
        "id": F.concat(F.lit("C-"), key),
        "name": F.when(key % 11 == 5, F.lit("  ")).otherwise(
            F.concat(F.lit(" "), F.col("s_name"), F.lit(" "))
        ),
        "mc_number": F.concat(F.lit("MC-"), key * 7 + 100000),
        "fleet_size": F.format_number(key * 13 + 900, 0),
        "on_time_pct": F.when(key % 7 == 0, F.lit("N/A")).otherwise(
            F.concat((key % 40 + 60).cast("string"), F.lit(".5"))
        ),
    }
    return table(spark, sf_dir, "supplier").select(
        *[values[f].alias(h) for f, h in CARRIER_HEADERS.items()], key.alias("_ix")
    )


def facility_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer sites as facilities; some cities are blank."""
    key = F.col("c_custkey")
    values = {
        "code": F.concat(F.lit("F"), key),
        "city": F.when(key % 13 == 4, F.lit("")).otherwise(
            _city_text(F.col("c_nationkey"), key)
        ),
        "state": F.concat(F.lit(" "), F.lower(F.substring("c_mktsegment", 1, 2))),
        "kind": F.when(key % 2 == 0, "warehouse").otherwise("cross_dock"),
        "capacity_pallets": F.concat(F.lit("$"), F.format_number(F.col("c_acctbal"), 2)),
    }
    return table(spark, sf_dir, "customer").select(
        *[values[f].alias(h) for f, h in FACILITY_HEADERS.items()], key.alias("_ix")
    )


def column_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column names of one shipment extract per customer, in the customer's style.

    Every fifth customer adds the name of its segment to each heading.
    """
    styles = spark.createDataFrame(
        [(i, pos, c) for i, style in enumerate(HEADER_STYLES) for pos, c in enumerate(style)],
        "style int, col_pos int, header string",
    )
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .withColumn("style", (key % len(HEADER_STYLES)).cast("int"))
        .join(F.broadcast(styles), "style")
        .select(
            F.concat(F.lit("extract-"), key).alias("dataset_id"),
            F.lit("Shipment").alias("entity"),
            "col_pos",
            F.when(key % 5 == 0, F.concat_ws(" ", "header", "c_mktsegment"))
            .otherwise(F.col("header"))
            .alias("column"),
        )
    )


def mapping_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-made choices of every third customer: one column set, one removed."""
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .filter(key % 3 == 0)
        .select(
            F.concat(F.lit("extract-"), key).alias("dataset_id"),
            F.inline(
                F.array(
                    F.struct(
                        F.lit("miles").alias("target_field"),
                        F.col("c_mktsegment").alias("source_column"),
                    ),
                    F.struct(
                        F.lit("carrier").alias("target_field"),
                        F.lit(None).cast("string").alias("source_column"),
                    ),
                )
            ),
        )
    )


def question_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per order, naming cities, amounts and priorities of the order."""
    key = F.col("o_orderkey")
    a, b = _pick(CITIES, key % 8), _pick(CITIES, F.col("o_custkey") % 8)
    price = F.format_number(F.col("o_totalprice"), 2)
    forms = [
        [F.lit("What is running late today, what is delayed?")],
        [F.lit("Show shipments to "), a],
        [F.lit("Show shipments from "), a, F.lit(" to "), b],
        [F.lit("How many shipments are there?")],
        [F.lit("Add up the total cost by carrier")],
        [F.lit("  Total cost please ")],
        [F.lit("How long is transit on average?")],
        [F.lit("How is our on-time performance?")],
        [F.lit("Name the cheapest carrier for a mile")],
        [F.lit("Who is the most expensive carrier?")],
        [F.lit("Any shipments over $"), price, F.lit("?")],
        [F.lit("List all carriers")],
        [F.lit("Give me a status summary")],
        [F.lit("Late loads into "), a, F.lit(" or "), b],
        [F.lit("What about priority "), F.col("o_orderpriority"), F.lit("?")],
        [F.lit("shipments that cost more than "), price, F.lit(" from "), a],
        [F.lit("shipments exceeding "), price],
    ]
    text = F.lit(None).cast("string")
    for i, parts in enumerate(forms):
        text = F.when(key % len(forms) == i, F.concat(*parts)).otherwise(text)
    shout = F.col("o_custkey") % 3 == 0
    return table(spark, sf_dir, "orders").select(
        key.alias("question_id"), F.when(shout, F.upper(text)).otherwise(text).alias("question")
    )


def conversation_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "conversations")
        .filter(F.col("role") == "user")
        .select("conv_id", "turn", F.col("text").alias("question"))
    )
