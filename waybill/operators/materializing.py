"""From mapped text columns to typed records, rejected rows and a report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import (
    canonical_value,
    parse_date,
    parse_number,
    title_case_place,
    wide_trim,
)
from ..plans.entities import EntitySpec, FieldSpec
from ..sources.extracts import ROW_INDEX, named
from ..sources.sinks import ACCEPTED, write_flagged
from ..sources.staging import new_staging_path

WARNINGS_SHOWN = 8


@dataclass(frozen=True)
class Materialized:
    """What became of one extract."""

    flagged: DataFrame
    records: DataFrame
    rejects: DataFrame
    report: DataFrame


def _typed(spec: FieldSpec, text: Column) -> Column:
    """The value of a field from its trimmed text."""
    if spec.type == "number":
        return parse_number(text)
    if spec.type == "date":
        return parse_date(text, trimmed=True)
    if spec.type == "enum":
        return canonical_value(text, spec.enum)
    if spec.clean == "place":
        return title_case_place(text)
    if spec.clean == "code":
        return F.upper(text)
    return text


def _missing_reason(spec: FieldSpec, text: str, value: str) -> Column:
    """Why a field that must be there makes the row unusable, or null."""
    if spec.type in ("date", "number"):
        return F.when(
            F.col(value).isNull(),
            F.when(F.col(text) == "", f"missing_{spec.name}").otherwise(f"invalid_{spec.name}"),
        )
    return F.when(F.col(value) == "", f"missing_{spec.name}")


def flag_rows(
    df: DataFrame,
    mapping: dict[str, str | None],
    entity: EntitySpec,
    dataset_id: str | Column = "extract",
    order_col: str = ROW_INDEX,
) -> DataFrame:
    """Project a text table onto an entity, marking the rows that cannot be kept.

    Output: ``order_col``, ``dataset_id``, the typed fields, ``reject_reason``
    (null for a good row), ``warnings``, and ``raw``, the mapped source texts,
    for rejected rows only. A plain projection: no shuffle, and it works on
    streaming tables.
    """
    fields = entity.fields
    dataset = F.lit(dataset_id) if isinstance(dataset_id, str) else dataset_id
    texts = df.select(
        named(order_col),
        dataset.alias("dataset_id"),
        *[
            (
                F.coalesce(named(mapping[f.name]).cast("string"), F.lit(""))
                if mapping.get(f.name)
                else F.lit("")
            ).alias(f"raw_{f.name}")
            for f in fields
        ],
    )
    # Each step is a projection of its own, so that the text of a field is
    # trimmed and read once although later steps look at it several times.
    trimmed = texts.withColumns(
        {f"txt_{f.name}": wide_trim(F.col(f"raw_{f.name}")) for f in fields}
    )
    typed = trimmed.withColumns(
        {f"val_{f.name}": _typed(f, F.col(f"txt_{f.name}")) for f in fields}
    )

    def raw(f: FieldSpec) -> str:
        return f"raw_{f.name}"

    def text(f: FieldSpec) -> str:
        return f"txt_{f.name}"

    def value(f: FieldSpec) -> str:
        return f"val_{f.name}"

    dropped_silently = F.coalesce(
        *[_missing_reason(f, text(f), value(f)) for f in fields if f.drop_if_missing],
        F.lit(None).cast("string"),
    )
    unknown_enum = F.coalesce(
        *[
            F.when(F.col(value(f)).isNull(), f"unrecognized_{f.name}")
            for f in fields
            if f.type == "enum"
        ],
        F.lit(None).cast("string"),
    )

    def warning(f: FieldSpec, problem: str, outcome: str) -> Column:
        return F.concat(
            F.lit("("), F.col(f"val_{entity.key}"), F.lit(f'): {problem} {f.label.lower()} "'),
            F.col(raw(f)), F.lit(f'" — {outcome}'),
        )

    notes = [
        F.when(
            F.col(value(f)).isNull() & (F.col(text(f)) != ""),
            warning(f, "unparseable", "treated as missing"),
        )
        for f in fields
        if f.type == "date" and not f.drop_if_missing
    ] + [
        F.when(F.col(value(f)).isNull(), warning(f, "unrecognized", "row dropped"))
        for f in fields
        if f.type == "enum"
    ]
    no_notes = F.array().cast("array<string>")
    warnings = (
        F.when(dropped_silently.isNull(), F.array_compact(F.array(*notes))).otherwise(no_notes)
        if notes
        else no_notes
    )
    reason = F.coalesce(dropped_silently, unknown_enum)
    raw_map = F.create_map(*[x for f in fields for x in (F.lit(f.name), F.col(raw(f)))])
    return typed.select(
        named(order_col),
        "dataset_id",
        *[
            F.col(value(f)).alias(f.name, metadata={"comment": f.description})
            for f in fields
        ],
        reason.alias("reject_reason"),
        warnings.alias("warnings"),
        F.when(reason.isNotNull(), raw_map).alias("raw"),
    )


def records_of(flagged: DataFrame, entity: EntitySpec, order_col: str = ROW_INDEX) -> DataFrame:
    """The rows that were kept, with the entity's fields.

    Of a written table this reads the folder of the kept rows and no further
    column. Of an unwritten one the test is on the fields themselves, the same
    as a null ``reject_reason``, which keeps the wording of the reasons out of
    the plan.
    """
    if ACCEPTED in flagged.columns:
        kept = F.col(ACCEPTED)
    else:
        present = [
            F.col(f.name) != "" if f.type == "string" else F.col(f.name).isNotNull()
            for f in entity.fields
            if f.drop_if_missing or f.type == "enum"
        ]
        kept = reduce(and_, present, F.lit(True))
    place = [c for c in ("dataset_pos",) if c in flagged.columns]
    return flagged.filter(kept).select(named(order_col), "dataset_id", *place, *entity.field_names)


def rejects_of(flagged: DataFrame, entity: EntitySpec, order_col: str = ROW_INDEX) -> DataFrame:
    """Every row that was dropped, with the reason and its source texts."""
    dropped = ~F.col(ACCEPTED) if ACCEPTED in flagged.columns else F.col("reject_reason").isNotNull()
    return flagged.filter(dropped).select(
        named(order_col),
        "dataset_id",
        F.lit(entity.name).alias("entity"),
        F.col(entity.key).alias("record_key"),
        "reject_reason",
        "raw",
    )


def warnings_of(flagged: DataFrame, entity: EntitySpec, order_col: str = ROW_INDEX) -> DataFrame:
    """Every warning, one row each: of which row, the how many-th of it, and its text."""
    return flagged.filter(F.size("warnings") > 0).select(
        named(order_col),
        "dataset_id",
        F.lit(entity.name).alias("entity"),
        F.col(entity.key).alias("record_key"),
        F.posexplode("warnings").alias("pos", "warning"),
    )


def report_of(
    flagged: DataFrame,
    entity: EntitySpec,
    dataset_ids: str | Sequence[str] | DataFrame = "extract",
    order_col: str = ROW_INDEX,
) -> DataFrame:
    """One row per dataset: records kept, rows dropped, the first eight warnings.

    Warnings name the 1-based row. Numbering the rows would take an ordered
    pass over everything, so only the few warned rows are looked up: a top-n
    finds their indexes, and one aggregate of at most nine groups per dataset
    counts the rows before each.
    """
    if isinstance(dataset_ids, DataFrame):
        listed = dataset_ids
    else:
        ids = [dataset_ids] if isinstance(dataset_ids, str) else list(dataset_ids)
        listed = flagged.sparkSession.createDataFrame([(d,) for d in ids], "dataset_id string")
    ix = named(order_col)
    rank = F.row_number().over(W.partitionBy("dataset_id").orderBy("ix", "pos", "text"))
    first_warnings = (
        flagged.filter(F.size("warnings") > 0)
        .select("dataset_id", ix.alias("ix"), F.posexplode("warnings").alias("pos", "text"))
        .withColumn("rank", rank)
        .filter(F.col("rank") <= WARNINGS_SHOWN)
        .groupBy("dataset_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "ix", "text"))).alias("shown"))
        .withColumn("marks", F.array_distinct(F.col("shown.ix")))
    )
    # How many of the warned rows a row comes after, or is.
    passed = F.coalesce(F.size(F.filter("marks", lambda m: m <= F.col("ix"))), F.lit(0))
    # One short row per dataset. Of named ones there are a few, and all rows may be of one, so
    # rows stay where they are; of a table of them adaptive execution decides how to join it.
    marks = first_warnings.select("dataset_id", "marks")
    if not isinstance(dataset_ids, DataFrame):
        marks = F.broadcast(marks)
    counted = (
        flagged.select(
            "dataset_id", ix.alias("ix"), F.col("reject_reason").isNull().alias("kept")
        )
        .join(marks, "dataset_id", "left")
        .select("dataset_id", passed.alias("passed"), "kept")
        .groupBy("dataset_id", "passed")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("kept"))
        .groupBy("dataset_id")
        .agg(
            F.sum("kept").alias("records"),
            F.sum(F.col("n") - F.col("kept")).alias("dropped"),
            F.collect_list(F.struct("passed", "n")).alias("counts"),
        )
    )

    def row_number(mark_pos: Column) -> Column:
        before = F.filter("counts", lambda c: c["passed"] < mark_pos)
        return F.aggregate(before, F.lit(1).cast("bigint"), lambda acc, c: acc + c["n"])

    warnings = F.transform(
        "shown",
        lambda w: F.concat(
            F.lit("Row "),
            row_number(F.array_position(F.col("marks"), w["ix"])).cast("string"),
            F.lit(" "),
            w["text"],
        ),
    )
    return (
        listed.join(counted, "dataset_id", "left")
        .join(first_warnings, "dataset_id", "left")
        .select(
            F.lit(entity.name).alias("entity"),
            "dataset_id",
            F.coalesce("records", F.lit(0).cast("bigint")).alias("records"),
            F.coalesce("dropped", F.lit(0).cast("bigint")).alias("dropped"),
            F.coalesce(warnings, F.array().cast("array<string>")).alias("warnings"),
        )
    )


def split_flagged(
    flagged: DataFrame,
    entity: EntitySpec,
    dataset_id: str = "extract",
    order_col: str = ROW_INDEX,
) -> Materialized:
    """Records, rejects and report of checked rows."""
    return Materialized(
        flagged=flagged,
        records=records_of(flagged, entity, order_col),
        rejects=rejects_of(flagged, entity, order_col),
        report=report_of(flagged, entity, dataset_id, order_col),
    )


def materialize(
    df: DataFrame,
    mapping: dict[str, str | None],
    entity: EntitySpec,
    dataset_id: str = "extract",
    order_col: str = ROW_INDEX,
) -> Materialized:
    """Typed records, rejects and report of one extract.

    The checked rows are staged at once, so that the extract is read and its
    texts are parsed a single time whatever is made of the result.
    ``split_flagged(flag_rows(...), ...)`` is the lazy form.
    """
    flagged = write_flagged(
        flag_rows(df, mapping, entity, dataset_id, order_col),
        new_staging_path(df.sparkSession, entity.name.lower()),
    )
    return split_flagged(flagged, entity, dataset_id, order_col)


def record_totals(reports: DataFrame) -> DataFrame:
    """Records kept over all entities."""
    return reports.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"))
