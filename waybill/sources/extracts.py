"""Reading extracts: CSV files or existing tables, as text columns in a known order."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import WIDE_SPACE, wide_trim
from .heads import file_heads
from .staging import stage

ROW_INDEX = "_ix"
_PLACE = "\0place"  # of a row of a split file; no heading is called so

CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
}


def quoted(name: str) -> str:
    """A column name as it must be written to be taken literally."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    return F.col(quoted(name))


def _names(values) -> tuple[str, ...]:
    names = [(v or "").strip(WIDE_SPACE) for v in values]
    return tuple(name or f"_c{i}" for i, name in enumerate(names)) if any(names) else ()


def _literal_path(path: str) -> str:
    """A file's path in a form that a reader takes as it stands."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _headers(spark: SparkSession, paths) -> dict[tuple[str, ...], list[str]]:
    """The files of each distinct header; of every file only the start is read.

    The driver gets one row per file, as it does when it lists them.
    """
    found: dict[tuple[str, ...], list[str]] = {}
    for r in file_heads(spark, paths).orderBy("path").collect():
        if names := _names(r.fields):
            found.setdefault(names, []).append(_literal_path(r.path))
    return found


def read_extract(
    spark: SparkSession,
    paths: str | Sequence[str],
    multi_line: bool | str = True,
) -> DataFrame:
    """Read CSV files with a header row as trimmed text columns plus ``_ix``.

    Every file is read by its own header: columns meet by name, and a file
    without one of them gives ``''`` there. Blank values become ``''``; short
    rows are filled up, surplus fields are dropped, and of two columns with the
    same name the last one counts. ``_ix`` grows with the row order inside each
    file; files with the same header follow each other in the order in which
    Spark scans them.

    ``multi_line`` allows line breaks inside quotes, at the price of one task
    per file. Turn it off for large files without such breaks, so that they
    are split. ``"split"`` allows both: line breaks in quotes and files read in
    many tasks, for files where quotes stand only around values and doubled
    inside them; the lines are shuffled once by block, and not sorted as a whole:
    a table with one row per block tells how many lines come before it.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    found = _headers(spark, paths)
    if not found:
        raise ValueError(f"no columns found in {paths}")
    if multi_line == "split":
        parts = [_read_split(spark, f, n, i) for i, (n, f) in enumerate(found.items())]
    else:
        parts = [_read_alike(spark, f, n, bool(multi_line)) for n, f in found.items()]
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    index = named(_PLACE) if multi_line == "split" else F.monotonically_increasing_id()
    return table.select(
        *[F.coalesce(named(c), F.lit("")).alias(c) for c in table.columns if c != _PLACE],
        index.alias(ROW_INDEX),
    )


def _read_alike(
    spark: SparkSession, paths, names: Sequence[str], multi_line: bool
) -> DataFrame:
    """Files with the same header as trimmed text columns."""
    raw = (
        spark.read.options(**CSV_OPTIONS, header=True, enforceSchema=True, multiLine=multi_line)
        .schema(T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))]))
        .csv(paths)
    )
    last = {name: i for i, name in enumerate(names)}
    return raw.select(
        *[wide_trim(F.col(f"_c{i}")).alias(name) for name, i in last.items()]
    )


def _joined_lines(lines: DataFrame) -> DataFrame:
    """Records (file, ix, text) from lines (file, block, at, line), read in any number of tasks.

    A line starts a record if an even number of quotes comes before it in its
    file. Lines and quotes are counted per block of a file; a table with one row
    per block carries the number of lines before it, parity, and the record that
    is open, from block to block. ``ix`` is the place of the record's first line
    among all lines. Only records of several lines are grouped.
    """
    block = W.partitionBy("file", "block").orderBy("ix")
    in_file = W.partitionBy("file").orderBy("block")
    earlier = in_file.rowsBetween(W.unboundedPreceding, -1)
    in_all = W.orderBy("file", "block").rowsBetween(W.unboundedPreceding, -1)
    before = block.rowsBetween(W.unboundedPreceding, -1)
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit('"'), F.lit("")))
    counted = lines.withColumn("odd", quotes % 2)
    # One row per block of a file. The lines of a block are numbered without gaps.
    blocks = (
        counted.groupBy("file", "block")
        .agg(
            (F.sum("odd") % 2).alias("own"),
            F.min("at").alias("first"),
            F.count(F.lit(1)).alias("size"),
        )
        .select(
            "file",
            "block",
            F.coalesce(F.sum("own").over(earlier) % 2, F.lit(0)).alias("given"),
            (F.coalesce(F.sum("size").over(in_all), F.lit(0)) - F.col("first")).alias("shift"),
        )
    )
    known = (
        counted.join(blocks, ["file", "block"])
        .withColumn("ix", F.col("at") + F.col("shift"))
        .withColumn(
            "inside",
            (F.col("given") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2 == 1,
        )
    )
    started = known.withColumn(
        "start", F.last(F.when(~F.col("inside"), F.col("ix")), ignorenulls=True).over(block)
    )
    open_at = (
        started.groupBy("file", "block")
        .agg(F.max("start").alias("own"))
        .select(
            "file", "block", F.last("own", ignorenulls=True).over(earlier).alias("carried")
        )
    )
    whole = ~F.col("inside") & (F.col("odd") == 0)
    single = started.where(whole).select("file", "ix", F.col("line").alias("text"))
    joined = (
        started.where(~whole)
        .join(open_at, ["file", "block"])
        .withColumn("record", F.coalesce("start", "carried"))
        .groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("ix", "line"))).alias("parts"))
        .select("file", F.col("record").alias("ix"), F.array_join("parts.line", "\n").alias("text"))
    )
    return single.unionByName(joined)


def _read_split(spark: SparkSession, paths, names: Sequence[str], number: int) -> DataFrame:
    """Like ``_read_alike``, but with the files cut into blocks, and with each row's place.

    ``number`` tells the files of one header from those of others: places of a
    higher number come later.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )
    # The second look at the lines must number them alike, so they are kept.
    records = _joined_lines(stage(lines, "csv-lines")).where(wide_trim(F.col("text")) != "")
    # The header is the first record of each file.
    first = records.groupBy("file").agg(F.min("ix").alias("header"))
    rows = records.join(first, "file").where(F.col("ix") != F.col("header"))
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
    options = {k: str(v) for k, v in CSV_OPTIONS.items()}
    fields = F.lit(schema.simpleString()[7:-1].replace(":", " "))
    raw = rows.select(F.from_csv("text", fields, options).alias("r"), "ix")
    last = {name: i for i, name in enumerate(names)}
    return raw.select(
        *[wide_trim(F.col(f"r._c{i}")).alias(name) for name, i in last.items()],
        (F.col("ix") + F.lit(number << 48)).alias(_PLACE),
    )


def with_row_index(df: DataFrame, order_col: str = ROW_INDEX) -> DataFrame:
    """Add a row index in scan order unless the table already has one."""
    if order_col in df.columns:
        return df
    return df.withColumn(order_col, F.monotonically_increasing_id())


def as_text(
    df: DataFrame, columns: Sequence[str] | None = None, order_col: str = ROW_INDEX
) -> DataFrame:
    """Any table as an extract: every column as text with ``''`` for null."""
    df = with_row_index(df, order_col)
    columns = columns or [c for c in df.columns if c != order_col]
    if not columns:
        raise ValueError("the table has no columns")
    return df.select(
        *[
            F.coalesce(named(c).cast("string"), F.lit("")).alias(c)
            for c in columns
        ],
        named(order_col),
    )


def preview(df: DataFrame, n: int = 8, order_col: str = ROW_INDEX) -> DataFrame:
    """The first rows as they were read (top-n, not a full sort)."""
    return df.orderBy(named(order_col)).limit(n)
