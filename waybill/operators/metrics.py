"""Operational figures over the shipment table.

All functions take the modelled table (``records``). "Delayed" is derived from
the dates, never read from the status text.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import half_up, ratio
from ..plans.entities import SHIPMENT_STATUS
from ..sources.extracts import ROW_INDEX, named
from .summing import exact_sums

# Fixed value: "today" for a table without rows.
EMPTY_TABLE_DATE = datetime.date(2026, 9, 30)


def reference_date(df: DataFrame) -> DataFrame:
    """One row: the latest pickup date of all rows, the stand-in for today."""
    return df.agg(
        F.coalesce(F.max("pickup_date"), F.lit(EMPTY_TABLE_DATE)).alias("reference_date")
    )


def _today(df: DataFrame, today: datetime.date | None) -> Column:
    # A scalar subquery: one pass over one column, no join. Pass ``today`` to
    # skip it when the date is known already.
    return F.lit(today) if today is not None else reference_date(df).scalar()


def is_active() -> Column:
    return F.col("status") != "cancelled"


def is_delayed(today: Column) -> Column:
    return (
        F.when(~is_active(), False)
        .when(F.col("delivery_date").isNotNull(), F.col("delivery_date") > F.col("promised_date"))
        .otherwise((F.col("status") == "in_transit") & (today > F.col("promised_date")))
    )


def is_on_time() -> Column:
    return F.coalesce(
        (F.col("status") == "delivered") & (F.col("delivery_date") <= F.col("promised_date")),
        F.lit(False),
    )


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def with_delivery_flags(df: DataFrame, today: datetime.date | None = None) -> DataFrame:
    """Add ``is_delayed`` and ``is_on_time``."""
    return df.withColumns(
        {"is_delayed": is_delayed(_today(df, today)), "is_on_time": is_on_time()}
    )


def kpis(
    df: DataFrame, by: Sequence[str] = (), today: datetime.date | None = None
) -> DataFrame:
    """The key figures, over the whole table or per group.

    "Today" is always that of the whole table.
    """
    delivered = F.col("status") == "delivered"
    arrived = delivered & F.col("delivery_date").isNotNull()
    days = days_between(F.col("pickup_date"), F.col("delivery_date"))

    def one_if(test: Column) -> Column:
        return F.when(test, 1).otherwise(0)

    timed = arrived & days.isNotNull()
    sums = exact_sums(
        df.filter(is_active()),
        by,
        {"cost": F.col("cost_usd"), "total_miles": F.col("miles")},
        {
            "total_shipments": F.lit(1),
            "delivered": one_if(delivered),
            "on_time": one_if(is_on_time()),
            "transit_days": F.when(timed, days).otherwise(0),
            "timed": one_if(timed),
            "exception_count": one_if(is_delayed(_today(df, today))),
        },
    )
    transit = ratio(F.col("transit_days"), F.col("timed"))
    return sums.select(
        *[named(c) for c in by],
        "total_shipments",
        "delivered",
        "on_time",
        (half_up(ratio(F.col("on_time"), F.col("delivered")) * 100, 1)).alias("on_time_pct"),
        half_up(transit, 1).alias("avg_transit_days"),
        half_up(F.col("cost"), 2).alias("total_cost_usd"),
        half_up(ratio(F.col("cost"), F.col("total_miles")), 2).alias("cost_per_mile"),
        "exception_count",
    )


def status_counts(df: DataFrame, order_col: str = ROW_INDEX) -> DataFrame:
    """Rows per stored status, in order of first appearance."""
    return (
        df.groupBy("status")
        .agg(F.count(F.lit(1)).alias("count"), F.min(named(order_col)).alias("first_ix"))
        .orderBy("first_ix", "status")
        .select("status", "count")
    )


def status_breakdown(
    df: DataFrame, fold: str = "delivered", today: datetime.date | None = None
) -> DataFrame:
    """Rows per status with the derived delays in a bucket of their own.

    ``fold='delivered'`` takes all delayed rows out of ``delivered``;
    ``fold='own'`` takes each out of the bucket it was in. Either way the
    ``delayed`` bucket holds the derived number, and empty buckets are left out.
    """
    if fold not in ("delivered", "own"):
        raise ValueError("fold must be 'delivered' or 'own'")
    delayed = is_delayed(_today(df, today))
    rows = df.select("status", delayed.alias("late"))
    buckets = SHIPMENT_STATUS.values
    # One aggregate with two counters per status; the list of statuses is fixed.
    counted = rows.agg(
        F.count_if("late").alias("late"),
        *[F.count_if(F.col("status") == s).alias(f"all_{s}") for s in buckets],
        *[F.count_if((F.col("status") == s) & F.col("late")).alias(f"late_{s}") for s in buckets],
    )

    def size(status: str) -> Column:
        every, late = F.col(f"all_{status}"), F.col("late")
        if status == "delayed":
            if fold == "own":
                return late + every - F.col("late_delayed")
            return F.when(late > 0, late).otherwise(every)
        if fold == "own":
            return every - F.col(f"late_{status}")
        return every - late if status == "delivered" else every

    bars = F.array(
        *[
            F.struct(F.lit(i).alias("pos"), F.lit(s).alias("status"), size(s).alias("count"))
            for i, s in enumerate(buckets)
        ]
    )
    return (
        counted.select(F.inline(bars))
        .filter(F.col("count") > 0)
        .orderBy("pos")
        .select("status", "count")
    )


def exceptions_queue(
    df: DataFrame,
    today: datetime.date | None = None,
    ordered: bool = False,
    order_col: str = ROW_INDEX,
) -> DataFrame:
    """Delayed shipments with the reason.

    The queue may be a large part of the table, so it is sorted by
    ``order_col`` only on request.
    """
    arrived = F.col("delivery_date").isNotNull()
    promised = F.col("promised_date")
    queue = df.filter(is_delayed(_today(df, today))).select(
        named(order_col),
        "id",
        "origin",
        "destination",
        "carrier",
        "promised_date",
        F.when(
            arrived,
            F.concat(
                F.lit("Delivered "),
                days_between(promised, F.col("delivery_date")).cast("string"),
                F.lit("d late"),
            ),
        )
        .otherwise(F.concat(F.lit("In transit, promised "), promised.cast("string")))
        .alias("reason"),
    )
    return queue.orderBy(named(order_col)) if ordered else queue


def cost_by(df: DataFrame, key: str = "carrier", order_col: str = ROW_INDEX) -> DataFrame:
    """Shipments, total cost and cost per mile per carrier, dearest total first."""
    return (
        exact_sums(
            df.filter(is_active()),
            [key],
            {"cost": F.col("cost_usd"), "total_miles": F.col("miles")},
            {"shipments": F.lit(1)},
            {"first_ix": named(order_col)},
        )
        .select(
            named(key),
            "shipments",
            half_up(F.col("cost"), 2).alias("total_cost"),
            half_up(ratio(F.col("cost"), F.col("total_miles")), 2).alias("cost_per_mile"),
            "first_ix",
        )
        .orderBy(F.desc("total_cost"), "first_ix", named(key))
    )


def known_places(
    df: DataFrame, order_col: str = ROW_INDEX, ordered: bool = True
) -> DataFrame:
    """Every origin and destination once, in order of first appearance.

    For looking places up, as ``classify_questions`` does, ``ordered=False``
    spares the sort.
    """
    ix = named(order_col)
    sides = F.array(
        F.struct(F.col("origin").alias("place"), F.lit(True).alias("is_origin")),
        F.struct(F.col("destination").alias("place"), F.lit(False).alias("is_origin")),
    )
    first_as_origin = F.min(F.when(F.col("is_origin"), F.col("ix")))
    first_as_destination = F.min(F.when(~F.col("is_origin"), F.col("ix")))
    places = (
        df.select(ix.alias("ix"), F.inline(sides))
        .groupBy("place")
        .agg(first_as_origin.alias("o"), first_as_destination.alias("d"))
        .select(
            "place",
            F.least("o", "d").alias("first_ix"),
            F.coalesce(F.col("o") <= F.col("d"), F.col("o").isNotNull()).alias("origin_first"),
        )
    )
    return places.orderBy("first_ix", F.desc("origin_first"), "place") if ordered else places
