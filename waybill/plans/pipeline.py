"""The whole way from extracts to modelled tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mapping import (
    apply_overrides,
    columns_table,
    mappings_by_dataset,
    suggest_mappings,
)
from ..operators.materializing import (
    Materialized,
    flag_rows,
    record_totals,
    records_of,
    rejects_of,
    report_of,
    warnings_of,
)
from ..operators.profiling import profile_many
from ..sources.extracts import ROW_INDEX, named, with_row_index
from ..sources.runs import commit_run, committed_runs, read_table
from ..sources.sinks import write_flagged, write_table
from ..sources.staging import new_staging_path, stage
from .entities import FREIGHT, EntitySpec, entity_named

# The place of an extract among those of its entity: rows follow each other by
# this and then by the row index.
EXTRACT_POS = "dataset_pos"


@dataclass(frozen=True)
class PipelineResult:
    """``tables`` holds the records per entity; an entity without extract has none.

    ``report`` shows the first warnings of each dataset, ``warnings`` has all of
    them, one row each.
    """

    mappings: DataFrame | None
    tables: dict[str, DataFrame]
    rejects: DataFrame | None
    report: DataFrame | None
    warnings: DataFrame | None = None

    @property
    def totals(self) -> DataFrame | None:
        return record_totals(self.report) if self.report is not None else None


def dataset_summary(
    datasets: dict[str, tuple[DataFrame, str | None]], order_col: str = ROW_INDEX
) -> DataFrame:
    """One row per dataset: its entity, if any, and its numbers of rows and columns."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(dataset_id).alias("dataset_id"),
                F.lit(entity).cast("string").alias("entity"),
                "row_count",
                F.lit(len([c for c in df.columns if c != order_col])).alias("column_count"),
            )
            for dataset_id, (df, entity) in datasets.items()
        ],
    )


def profile_all(
    datasets: dict[str, tuple[DataFrame, str | None]], order_col: str = ROW_INDEX
) -> DataFrame:
    """Profiles of several datasets in one table, with their ``dataset_id``, in one pass."""
    return profile_many({d: df for d, (df, _) in datasets.items()}, order_col=order_col)


def map_all(
    spark: SparkSession,
    datasets: dict[str, tuple[DataFrame, str | None]],
    overrides: DataFrame | None = None,
    entities: tuple[EntitySpec, ...] = FREIGHT,
    order_col: str = ROW_INDEX,
) -> DataFrame:
    """Suggested mappings, with overrides, of all datasets that have an entity."""
    columns = columns_table(
        spark,
        {
            dataset_id: ([c for c in df.columns if c != order_col], entity)
            for dataset_id, (df, entity) in datasets.items()
            if entity_named(entity, entities)
        },
    )
    mappings = suggest_mappings(columns, entities)
    return apply_overrides(mappings, overrides) if overrides is not None else mappings


def run_pipeline(
    datasets: dict[str, tuple[DataFrame, str | None]],
    overrides: DataFrame | None = None,
    output: str | None = None,
    entities: tuple[EntitySpec, ...] = FREIGHT,
    order_col: str = ROW_INDEX,
    mode: str = "errorifexists",
) -> PipelineResult:
    """Map, check and write some datasets: ``{id: (table, entity name or None)}``.

    Every extract is read and parsed once: its checked rows are written, below
    ``output`` or else in the staging folder, and records, rejects and report
    all come from there. Extracts of the same entity follow each other in the
    order given: by ``dataset_pos``, then by the row index. Datasets without an
    entity are skipped.

    ``mode="append"`` adds a run below a folder of its own (``run=<id>``) and
    returns that run only; ``overwrite`` does so too and hides all earlier runs;
    ``ignore`` would return rows of an earlier run as this one's and is refused.
    What a folder holds is read with ``read_modelled``: a run is there with all
    its tables or, until the last is written, with none.
    """
    if mode == "ignore":
        raise ValueError("mode 'ignore' would report the rows of an earlier run")
    run_id = uuid.uuid4().hex
    run = f"/run={run_id}" if mode in ("append", "overwrite") else ""
    write_mode = "errorifexists" if mode == "overwrite" else mode
    written: dict[str, tuple[str, DataFrame]] = {}
    if not datasets:
        raise ValueError("no datasets given")
    for dataset_id, (df, _) in datasets.items():
        if not [c for c in df.columns if c != order_col]:
            raise ValueError(f"dataset {dataset_id!r} has no columns")
    spark = next(iter(datasets.values()))[0].sparkSession
    mappings = stage(map_all(spark, datasets, overrides, entities, order_col), "mappings")

    mapping = mappings_by_dataset(mappings)

    tables: dict[str, DataFrame] = {}
    rejects: list[DataFrame] = []
    reports: list[DataFrame] = []
    warnings: list[DataFrame] = []
    for entity in entities:
        ids = [d for d, (_, name) in datasets.items() if name == entity.name]
        if not ids:
            continue
        parts = []
        for i, dataset_id in enumerate(ids):
            source = with_row_index(datasets[dataset_id][0], order_col)
            part = flag_rows(source, mapping[dataset_id], entity, dataset_id, order_col)
            parts.append(part.withColumn(EXTRACT_POS, F.lit(i)))
        path = (
            f"{output.rstrip('/')}/{entity.name.lower()}{run}"
            if output
            else new_staging_path(spark, entity.name.lower())
        )
        flagged = write_flagged(reduce(DataFrame.unionByName, parts), path, write_mode)
        written[entity.name] = (path, flagged)
        tables[entity.name] = records_of(flagged, entity, order_col)
        rejects.append(rejects_of(flagged, entity, order_col))
        reports.append(report_of(flagged, entity, ids, order_col))
        warnings.append(warnings_of(flagged, entity, order_col))
    report = reduce(DataFrame.unionByName, reports) if reports else None
    if output and report is not None:
        base = output.rstrip("/")
        report = write_table(report, f"{base}/report{run}", write_mode)
        write_table(mappings, f"{base}/mappings{run}", write_mode)
        extras = {
            "report": (f"{base}/report{run}", report),
            "mappings": (f"{base}/mappings{run}", mappings),
        }
        commit_run(spark, base, run_id, written, extras, mode == "overwrite")
    return PipelineResult(
        mappings=mappings,
        tables=tables,
        rejects=reduce(DataFrame.unionByName, rejects) if rejects else None,
        report=report,
        warnings=reduce(DataFrame.unionByName, warnings) if warnings else None,
    )


def read_modelled(
    spark: SparkSession,
    output: str,
    entities: tuple[EntitySpec, ...] = FREIGHT,
    order_col: str = ROW_INDEX,
) -> PipelineResult:
    """What the finished runs below ``output`` hold together.

    A run that did not end is not seen, nor are runs before one that replaced them.
    Without a finished run there are no tables.
    """
    found: dict[str, list[DataFrame]] = {}
    for row in committed_runs(spark, output):
        found.setdefault(row.name, []).append(
            read_table(spark, row).withColumn("run", F.lit(row.run))
        )
    joined = {name: reduce(DataFrame.unionByName, parts) for name, parts in found.items()}
    known = [e for e in entities if e.name in joined]

    def together(parts: list[DataFrame]) -> DataFrame | None:
        return reduce(DataFrame.unionByName, parts) if parts else None

    return PipelineResult(
        mappings=joined.get("mappings"),
        tables={e.name: records_of(joined[e.name], e, order_col) for e in known},
        rejects=together([rejects_of(joined[e.name], e, order_col) for e in known]),
        report=joined.get("report"),
        warnings=together([warnings_of(joined[e.name], e, order_col) for e in known]),
    )


def materialize_many(
    df: DataFrame,
    dataset_col: str,
    entity: EntitySpec,
    overrides: dict[str, str | None] | None = None,
    order_col: str = ROW_INDEX,
) -> Materialized:
    """Any number of extracts with the same headings, in one table and one pass.

    ``dataset_col`` names each row's extract. One mapping serves all of them
    (``overrides`` by target field), the rows are checked in one stage, and the
    report has a row for each extract.
    """
    spark = df.sparkSession
    headings = [c for c in df.columns if c not in (order_col, dataset_col)]
    found = suggest_mappings(columns_table(spark, {"all": (headings, entity.name)}), (entity,))
    mapping = mappings_by_dataset(found)["all"] | (overrides or {})
    source = with_row_index(df, order_col)
    flagged = write_flagged(
        flag_rows(source, mapping, entity, named(dataset_col).cast("string"), order_col),
        new_staging_path(spark, entity.name.lower()),
    )
    ids = flagged.select("dataset_id").distinct()
    return Materialized(
        flagged=flagged,
        records=records_of(flagged, entity, order_col),
        rejects=rejects_of(flagged, entity, order_col),
        report=report_of(flagged, entity, ids, order_col),
    )
