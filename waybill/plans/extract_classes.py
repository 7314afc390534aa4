"""Any number of extracts with headings of their own, materialized in one pass.

The extracts are data: one table of rows, whose cells are an array, and one of
headings. What a row's cells mean is looked up in a third, the positions of the
entity's fields by extract. So the plan is the same for three extracts and for
thousands, and suggestions are made once for each class of equal headings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import wide_trim
from ..operators.mapping import apply_overrides, suggest_mappings
from ..operators.materializing import (
    Materialized,
    flag_rows,
    records_of,
    rejects_of,
    report_of,
)
from ..sources.extracts import CSV_OPTIONS, ROW_INDEX, named
from ..sources.heads import file_heads
from ..sources.sinks import write_flagged
from ..sources.staging import new_staging_path, stage
from .entities import EntitySpec


def read_cells(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """CSV files as extracts of their own: rows (dataset_id, _ix, cells), headings.

    Headings: (dataset_id, col_pos, column). All files are one read, as wide as
    the widest of them; a file's name is its ``dataset_id``. Only the start of
    each file is read for its headings.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    heads = stage(file_heads(spark, paths), "csv-heads")
    width = heads.agg(F.max(F.size("fields"))).first()[0] or 0
    if not width:
        raise ValueError(f"no columns found in {paths}")
    headings = heads.select(
        F.col("path").alias("dataset_id"), F.posexplode("fields").alias("col_pos", "text")
    ).select(
        "dataset_id",
        "col_pos",
        F.coalesce(
            F.nullif(wide_trim(F.col("text")), F.lit("")), F.concat(F.lit("_c"), "col_pos")
        ).alias("column"),
    )
    fields = [f"_c{i}" for i in range(width)]
    raw = (
        spark.read.options(**CSV_OPTIONS, header=True, enforceSchema=True, multiLine=multi_line)
        .schema(T.StructType([T.StructField(f, T.StringType()) for f in fields]))
        .csv(paths)
    )
    rows = raw.select(
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file"),
        F.monotonically_increasing_id().alias(ROW_INDEX),
        F.array(*[wide_trim(F.col(f)) for f in fields]).alias("cells"),
    )
    # Listings write a local file as file:/x and scans as file:///x.
    short = F.regexp_replace("file", r"^([A-Za-z][\w+.-]*:)///(?=[^/])", "$1/")
    return rows.select(short.alias("dataset_id"), ROW_INDEX, "cells"), headings


def field_positions(
    headings: DataFrame, entity: EntitySpec, overrides: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(dataset_id, positions): where each field of an extract is; and the mappings.

    ``positions`` maps a field's name to the place of its column. Of two columns
    with the same name the last one counts. Equal headings are scored once.
    """
    last = headings.groupBy("dataset_id", "column").agg(F.max("col_pos").alias("col_pos"))
    ordered = F.array_sort(F.collect_list(F.struct("col_pos", "column")))
    listed = last.groupBy("dataset_id").agg(ordered.alias("columns"))
    listed = stage(listed.withColumn("class", F.sha2(F.to_json("columns"), 256)), "extract-classes")
    classes = (
        listed.groupBy("class")
        .agg(F.first("columns").alias("columns"))
        .select(
            F.col("class").alias("dataset_id"),
            F.lit(entity.name).alias("entity"),
            F.inline("columns"),
        )
    )
    suggested = suggest_mappings(classes, (entity,)).withColumnRenamed("dataset_id", "class")
    mappings = listed.select("dataset_id", "class").join(suggested, "class").drop("class")
    if overrides is not None:
        mappings = apply_overrides(mappings, overrides)
    mappings = stage(mappings, "extract-mappings")
    placed = mappings.join(
        last.withColumnRenamed("column", "source_column"), ["dataset_id", "source_column"]
    )
    positions = placed.groupBy("dataset_id").agg(
        F.map_from_entries(F.collect_list(F.struct("target_field", "col_pos"))).alias("positions")
    )
    return positions, mappings


def materialize_cells(
    rows: DataFrame,
    headings: DataFrame,
    entity: EntitySpec,
    overrides: DataFrame | None = None,
    order_col: str = ROW_INDEX,
) -> tuple[Materialized, DataFrame]:
    """Records, rejects and report of any number of extracts, and their mappings.

    ``rows``: (dataset_id, ``order_col``, cells), ``headings``: (dataset_id,
    col_pos, column), ``overrides``: (dataset_id, target_field, source_column).
    An extract without rows is in the report with none; rows without headings
    have blank fields. The positions have one row per extract, and adaptive
    execution decides how they meet the rows.
    """
    positions, mappings = field_positions(headings, entity, overrides)
    met = rows.join(positions.withColumnRenamed("dataset_id", "owner"), F.col("dataset_id") == F.col("owner"), "left")
    values = {
        f: F.get("cells", F.try_element_at("positions", F.lit(f))) for f in entity.field_names
    }
    fields = met.select(
        named(order_col), F.col("dataset_id").alias("__extract"), *[v.alias(f) for f, v in values.items()]
    )
    flagged = write_flagged(
        flag_rows(fields, {f: f for f in values}, entity, F.col("__extract"), order_col),
        new_staging_path(rows.sparkSession, entity.name.lower()),
    )
    ids = headings.select("dataset_id").distinct()
    found = Materialized(
        flagged=flagged,
        records=records_of(flagged, entity, order_col),
        rejects=rejects_of(flagged, entity, order_col),
        report=report_of(flagged, entity, ids, order_col),
    )
    return found, mappings


def cells_of(df: DataFrame, dataset_id: str, order_col: str = ROW_INDEX) -> tuple[DataFrame, DataFrame]:
    """A table as an extract of this kind: its rows and its headings."""
    columns = [c for c in df.columns if c != order_col]
    rows = df.select(
        F.lit(dataset_id).alias("dataset_id"),
        named(order_col).alias(order_col),
        F.array(*[F.coalesce(named(c).cast("string"), F.lit("")) for c in columns]).alias("cells"),
    )
    headings = df.sparkSession.createDataFrame(
        [(dataset_id, i, c) for i, c in enumerate(columns)],
        "dataset_id string, col_pos int, column string",
    )
    return rows, headings
