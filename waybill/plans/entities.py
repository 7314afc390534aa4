"""Entities declared as data. The freight entities are the shipped configuration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.enums import EnumRules


@dataclass(frozen=True)
class FieldSpec:
    """One target field.

    ``type`` is string, number, date or enum. ``clean`` says how a string is
    tidied: trim, place (casing of place names) or code (upper case).
    ``required`` is documentation for whoever maps the columns; rows are only
    rejected where ``drop_if_missing`` is set, or for an unknown enum value.
    """

    name: str
    label: str
    type: str = "string"
    required: bool = False
    description: str = ""
    synonyms: tuple[str, ...] = ()
    clean: str = "trim"
    drop_if_missing: bool = False
    enum: EnumRules | None = None

    @property
    def spark_type(self) -> T.DataType:
        if self.type == "number":
            return T.DoubleType()
        if self.type == "date":
            return T.DateType()
        return T.StringType()


@dataclass(frozen=True)
class EntitySpec:
    name: str
    label: str
    key: str
    fields: tuple[FieldSpec, ...]
    description: str = ""

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(f.name, f.spark_type, True, {"comment": f.description})
                for f in self.fields
            ]
        )


# The shipment statuses, and the spellings and beginnings that
# stand for each of them.
SHIPMENT_STATUS = EnumRules(
    values=("booked", "in_transit", "delivered", "delayed", "cancelled"),
    spellings=(
        ("booked", "booked"),
        ("intransit", "in_transit"),
        ("delivered", "delivered"),
        ("delayed", "delayed"),
        ("cancelled", "cancelled"),
        ("canceled", "cancelled"),
    ),
    prefixes=(
        ("deliver", "delivered"),
        ("delvier", "delivered"),
        ("intrans", "in_transit"),
    ),
)

# Field names, types and the synonyms under which clients name
# the same thing.
SHIPMENT = EntitySpec(
    name="Shipment",
    label="Shipment",
    key="id",
    description="One load moved from an origin to a destination by a carrier",
    fields=(
        FieldSpec("id", "Shipment ID", "string", True, "Identifier given by the client",
                  ("shipmentid", "shipment_id", "shipid"), drop_if_missing=True),
        FieldSpec("origin", "Origin", "string", True, "City the load leaves from",
                  ("from", "origin_city", "origincity"), clean="place"),
        FieldSpec("destination", "Destination", "string", True, "City the load goes to",
                  ("to", "dest", "destination_city", "destcity"), clean="place"),
        FieldSpec("pickup_date", "Pickup date", "date", True, "Day of pickup",
                  ("pickupdate", "pickup", "tenderdate", "shipdate"), drop_if_missing=True),
        FieldSpec("promised_date", "Promised date", "date", True, "Day delivery was promised",
                  ("promiseddate", "promised", "etadate", "duedate"), drop_if_missing=True),
        FieldSpec("delivery_date", "Delivery date", "date", False, "Day of delivery, if known",
                  ("deliverydate", "delivereddate", "actualdelivery")),
        FieldSpec("carrier", "Carrier", "string", True, "Name of the carrier",
                  ("carriername", "carrier_name", "scac")),
        FieldSpec("status", "Status", "enum", True, "State of the shipment",
                  ("shipmentstatus", "state"), enum=SHIPMENT_STATUS),
        FieldSpec("weight_lbs", "Weight (lbs)", "number", False, "Weight in pounds",
                  ("weightlbs", "weight_lbs", "weight", "lbs")),
        FieldSpec("cost_usd", "Cost (USD)", "number", False, "Price of the load in US dollars",
                  ("costusd", "cost_usd", "cost", "freightcost", "amount")),
        FieldSpec("miles", "Miles", "number", False, "Length of the route",
                  ("distance", "distancemiles")),
    ),
)

CARRIER = EntitySpec(
    name="Carrier",
    label="Carrier",
    key="id",
    description="A trucking company under contract",
    fields=(
        FieldSpec("id", "Carrier ID", "string", True, "Identifier of the carrier",
                  ("carrierid", "carrier_id", "id"), drop_if_missing=True),
        FieldSpec("name", "Carrier name", "string", True, "Name of the carrier",
                  ("carriername", "name", "carrier"), drop_if_missing=True),
        FieldSpec("mc_number", "MC number", "string", False, "Motor carrier registration",
                  ("mcnumber", "mc_number", "mc")),
        FieldSpec("fleet_size", "Fleet size", "number", False, "Number of trucks",
                  ("fleetsize", "fleet_size", "trucks")),
        FieldSpec("on_time_pct", "On-time %", "number", False, "On-time share it reports",
                  ("ontimepct", "on_time_pct", "otpct", "ontime")),
    ),
)

FACILITY = EntitySpec(
    name="Facility",
    label="Facility",
    key="code",
    description="A warehouse or a cross-dock",
    fields=(
        FieldSpec("code", "Facility code", "string", True, "Code of the site",
                  ("facilitycode", "facility_code", "code", "id"), drop_if_missing=True),
        FieldSpec("city", "City", "string", True, "City of the site",
                  ("facilitycity",), clean="place", drop_if_missing=True),
        FieldSpec("state", "State", "string", True, "State of the site",
                  ("st", "province"), clean="code"),
        FieldSpec("kind", "Kind", "string", False, "Kind of site",
                  ("facilitytype", "type")),
        FieldSpec("capacity_pallets", "Capacity (pallets)", "number", False, "Room for pallets",
                  ("capacitypallets", "capacity_pallets", "capacity")),
    ),
)

FREIGHT: tuple[EntitySpec, ...] = (SHIPMENT, CARRIER, FACILITY)


def entity_named(name: str | None, entities: tuple[EntitySpec, ...] = FREIGHT) -> EntitySpec | None:
    return next((e for e in entities if e.name == name), None)


def fields_table(
    spark: SparkSession, entities: tuple[EntitySpec, ...] = FREIGHT
) -> DataFrame:
    """The catalogue of target fields, one row each (its size is the configuration's)."""
    rows = [
        (e.name, pos, f.name, f.label, f.type, f.required,
         list(f.enum.values) if f.enum else None, list(f.synonyms), f.description)
        for e in entities
        for pos, f in enumerate(e.fields)
    ]
    return spark.createDataFrame(
        rows,
        "entity string, field_pos int, target_field string, label string, type string, "
        "required boolean, enum_values array<string>, synonyms array<string>, description string",
    )
