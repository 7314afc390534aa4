"""Column statistics and data-quality findings.

The table is unpivoted and grouped once by (column, value); this table of
distinct values is staged and everything else is computed from it:

* one aggregate per column gives counts, types and date formats;
* samples, casing groups and typo pairs read only the columns they concern.

Values of more than ``LONG`` characters do not travel. They are told apart by 128
bits of hashes, of the value and of its lower case, and what the rules say of
them is decided where they stand. The few long values that a profile shows are
fetched by a second read of just those columns, joined with the list of what is
shown.

Per column at most four samples and 25 values for the typo check meet in one
place, and the casings of three values. A value has as many casings as were
written; ``max_casings`` bounds how many of them a finding lists.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import DATE_FORMATS, date_format_of, half_up, parse_number, wide_trim
from ..sources.extracts import ROW_INDEX, as_text, named, with_row_index
from ..sources.staging import stage

# Fixed values of the findings.
SAMPLES = 4
HIGH_NULL_RATE = 0.2
CASING_GROUPS_SHOWN = 3
TYPO_MAX_VALUES = 25
TYPO_MAX_EDITS = 2
TYPO_PAIRS_SHOWN = 3
BOOLEAN_WORDS = ("true", "false", "yes", "no", "y", "n", "1", "0")

# Tables of at least WIDE columns are dealt out by rows if a task would count more than
# TASK_CELLS cells; then it counts half as many. In narrower ones files bound the tasks.
WIDE = 24
TASK_CELLS = 4_000_000
TASK_BYTES = 16 << 20  # of distinct values, as shuffled, that one task merges

_SAMPLE_SLICES = 16
LONG = 128  # characters; longer values are told apart by hashes
LEAD = 16  # characters of a long value that are kept, to order values with the same index
APPROX_ERROR = 0.01  # relative standard deviation of approximate distinct counts

# What the rules say of a long value, as bits; the date format follows above them.
_INTEGER, _NUMBER, _MARKED, _PADDED, _FORMAT = 1, 2, 4, 8, 16


# (positions or None for all) -> cells of these columns: (pos, ix, text)
Cells = Callable[[set[int] | None], DataFrame]


def _dealt(df: DataFrame, names: Sequence[str], order_col: str) -> DataFrame:
    """A wide table in parts of ``TASK_CELLS`` cells at most: a task keeps its distinct values.

    Only equal rows stay together, and they add no values. Counting the rows of each task is
    a pass that reads no column.
    """
    if len(names) < WIDE:
        return df
    by_task = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"))
    found = by_task.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    if (found.most or 0) * len(names) <= TASK_CELLS:
        return df
    parts = math.ceil(found.rows * len(names) / (TASK_CELLS / 2))
    text = as_text(df, names, order_col)
    return text.repartition(parts, named(order_col), *[named(n) for n in names])


def _cells_of(
    df: DataFrame, names: Sequence[str], order_col: str, first_pos: int = 0, dealt: bool = True
) -> Cells:
    """The cells of a table, whose columns are numbered from ``first_pos``.

    ``dealt`` is for cells that are grouped by their values.
    """
    df = with_row_index(df, order_col)

    def cells(positions: set[int] | None) -> DataFrame | None:
        wanted = [
            (first_pos + i, name)
            for i, name in enumerate(names)
            if positions is None or first_pos + i in positions
        ]
        if not wanted:
            return None
        rows = _dealt(df, names, order_col) if dealt and positions is None else df
        text = as_text(rows, [name for _, name in wanted], order_col)
        return text.select(
            named(order_col).cast("bigint").alias("ix"),
            F.inline(
                F.array(
                    *[F.struct(F.lit(p).alias("pos"), named(n).alias("text")) for p, n in wanted]
                )
            ),
        )

    return cells


def _hashes(text: Column, when: Column, prefix: str) -> list[Column]:
    """128 bits of a text, as two columns that are null unless ``when``."""
    return [
        F.when(when, F.xxhash64(text)).alias(f"{prefix}1"),
        F.when(when, F.xxhash64(F.lit(1), text)).alias(f"{prefix}2"),
    ]


def _verdict(text: Column) -> Column:
    """What the rules say of a text, in one number."""
    fmt = date_format_of(text)
    which = F.coalesce(F.array_position(F.array(*[F.lit(f) for f in DATE_FORMATS]), fmt), F.lit(0))

    def bit(test: Column, value: int) -> Column:
        return F.when(test, value).otherwise(0)

    return (
        bit(text.rlike(_INTEGER_TEXT), _INTEGER)
        + bit(parse_number(text).isNotNull(), _NUMBER)
        + bit(text.contains("$") | text.contains(","), _MARKED)
        + bit(text != wide_trim(text), _PADDED)
        + which * _FORMAT
    ).cast("int")


_INTEGER_TEXT = r"^-?\d+\z"
_KEYS = ["pos", "value", "h1", "h2", "f1", "f2", "verdict"]


def _distinct(cells: DataFrame) -> DataFrame:
    """Every distinct value of every column, from cells (pos, ix, text)."""
    text = F.col("text")
    long = F.length(text) > LONG
    return (
        cells.select(
            "pos",
            "ix",
            F.when(long, F.substring(text, 1, LEAD)).otherwise(text).alias("value"),
            *_hashes(text, long, "h"),
            *_hashes(F.lower(text), long, "f"),
            F.when(long, _verdict(text)).alias("verdict"),
        )
        .groupBy(*_KEYS)
        .agg(F.count(F.lit(1)).alias("n"), F.min("ix").alias("first_ix"))
    )


def column_values(
    df: DataFrame, columns: Sequence[str] | None = None, order_col: str = ROW_INDEX
) -> DataFrame:
    """Every distinct value of every column: (pos, value, ..., n, first_ix).

    The unpivot multiplies rows by columns inside a task only; values are
    counted there before they are shuffled. One pass, however wide the table.
    Of a value above ``LONG`` characters, ``value`` is the beginning, ``h1`` and
    ``h2`` are its hash, ``f1`` and ``f2`` that of its lower case, and
    ``verdict`` is what the rules say of it; they are null for others.
    """
    df = with_row_index(df, order_col)
    names = list(columns or [c for c in df.columns if c != order_col])
    return _distinct(_cells_of(df, names, order_col)(None))


def _rules(values: DataFrame) -> dict[str, Column]:
    """The tests on a value, by its text or, if it is long, by its verdict."""
    value, long = F.col("value"), F.col("h1").isNotNull()
    verdict = F.col("verdict")

    def rule(bit: int, test: Column) -> Column:
        return F.when(long, verdict.bitwiseAND(bit) != 0).otherwise(test)

    fmt = F.get(
        F.array(*[F.lit(f) for f in DATE_FORMATS]), F.floor(verdict / _FORMAT).cast("int") - 1
    )
    return {
        "is_integer": rule(_INTEGER, value.rlike(_INTEGER_TEXT)),
        "is_number": rule(_NUMBER, parse_number(value).isNotNull()),
        "is_boolean": ~long & F.lower(value).isin(*BOOLEAN_WORDS),
        "is_marked": rule(_MARKED, value.contains("$") | value.contains(",")),
        "is_padded": rule(_PADDED, value != wide_trim(value)),
        "fmt": F.when(long, fmt).otherwise(F.when(value != "", date_format_of(value))),
    }


def _column_stats(
    values: DataFrame, n: Column | None = None, distinct: Column | None = None
) -> DataFrame:
    """One row per column, from fixed-size counters only."""
    value, ix, long = F.col("value"), F.col("first_ix"), F.col("h1").isNotNull()
    n = F.col("n") if n is None else n
    filled = value != ""
    fmt = F.col("fmt")

    def always(rule: str) -> Column:
        # A column without values passes every rule.
        return F.coalesce(F.bool_and(F.when(filled, F.col(rule))), F.lit(True))

    def ever(rule: str) -> Column:
        return F.coalesce(F.bool_or(F.col(rule)), F.lit(False))

    # Bound for the samples: the smallest index in each of 16 slices of the
    # values belongs to a different value, so the 4th smallest of these is not
    # below the 4th smallest of all.
    slice_no = F.pmod(F.hash("value", "h1"), F.lit(_SAMPLE_SLICES))
    firsts = F.array_sort(
        F.array_compact(
            F.array(
                *[F.min(F.when(filled & (slice_no == i), ix)) for i in range(_SAMPLE_SLICES)]
            )
        )
    )
    formats = F.array(
        *[
            F.struct(F.min(F.when(fmt == f, ix)).alias("ix"), F.lit(f).alias("fmt"))
            for f in DATE_FORMATS
        ]
    )
    seen = F.array_sort(F.filter(formats, lambda f: f["ix"].isNotNull()))
    return (
        values.withColumns(_rules(values))
        .groupBy("pos")
        .agg(
            F.sum(n).alias("total"),
            F.sum(F.when(filled, 0).otherwise(n)).alias("null_count"),
            (F.count_if(filled) if distinct is None else distinct).alias("distinct_count"),
            always("is_integer").alias("all_integer"),
            always("is_number").alias("all_number"),
            always("is_boolean").alias("all_boolean"),
            F.coalesce(F.bool_and(F.when(filled, fmt.isNotNull())), F.lit(True)).alias("all_date"),
            F.transform(seen, lambda f: f["fmt"]).alias("formats"),
            ever("is_marked").alias("marked"),
            ever("is_padded").alias("padded"),
            F.get(firsts, F.lit(SAMPLES - 1)).alias("sample_bound"),
            F.coalesce(F.bool_or(long), F.lit(False)).alias("has_long"),
        )
        .withColumn(
            "inferred_type",
            F.when(F.col("all_integer"), "integer")
            .when(F.col("all_number"), "float")
            .when(F.col("all_boolean"), "boolean")
            .when(F.col("all_date"), "date")
            .otherwise("string"),
        )
    )


_STATS_SCHEMA = (
    "pos int, column string, inferred_type string, total bigint, null_count bigint, "
    "distinct_count bigint, formats array<string>, marked boolean, padded boolean, "
    "sample_bound bigint"
)
_SHOWN = ["pos", "kind", "grp", "first_ix", "n", "value", "h1", "h2"]


def _shown(values: DataFrame, kind: str, grp: Column) -> DataFrame:
    return values.withColumn("kind", F.lit(kind)).withColumn("grp", grp).select(*_SHOWN)


def _sample_values(values: DataFrame, stats: DataFrame) -> DataFrame:
    """The first distinct values of each column."""
    bounds = stats.select("pos", "sample_bound")
    rank = F.row_number().over(W.partitionBy("pos").orderBy("first_ix", "value", "h1", "h2"))
    early = (
        values.filter(F.col("value") != "")
        .join(F.broadcast(bounds), "pos")  # a row per column
        .filter(F.col("sample_bound").isNull() | (F.col("first_ix") <= F.col("sample_bound")))
        .withColumn("rank", rank)
        .filter(F.col("rank") <= SAMPLES)
    )
    return _shown(early, "sample", F.lit(0))


def _casing_values(
    values: DataFrame, string_columns: list[int], max_casings: int | None = None
) -> DataFrame:
    """Values written in several casings: the first three groups of each column.

    Of each group the first ``max_casings`` spellings, or all.
    """
    lower = F.lower("value")
    text = values.filter(F.col("pos").isin(string_columns) & (F.col("value") != "")).select(
        "*",
        F.coalesce("f1", F.xxhash64(lower)).alias("g1"),
        F.coalesce("f2", F.xxhash64(F.lit(1), lower)).alias("g2"),
    )
    rank = F.row_number().over(W.partitionBy("pos").orderBy("group_ix", "folded", "g1", "g2"))
    groups = (
        text.groupBy("pos", "g1", "g2")
        # Values are distinct, so a group of several rows has several casings.
        .agg(
            F.count(F.lit(1)).alias("casings"),
            F.min("first_ix").alias("group_ix"),
            F.min(lower).alias("folded"),
        )
        .filter("casings > 1")
        .select("pos", "g1", "g2", rank.alias("grp"))
        .filter(F.col("grp") <= CASING_GROUPS_SHOWN)
    )
    # At most three rows per column of the table's schema.
    spellings = text.join(F.broadcast(groups), ["pos", "g1", "g2"])
    if max_casings is not None:
        in_group = W.partitionBy("pos", "grp").orderBy("first_ix", "value", "h1", "h2")
        spellings = spellings.withColumn("nth", F.row_number().over(in_group)).filter(
            F.col("nth") <= max_casings
        )
    return _shown(spellings, "casing", F.col("grp"))


def _texts_of(shown: DataFrame, cells: DataFrame) -> DataFrame:
    """``shown`` with the texts of its long values, from cells of the columns that have any."""
    wanted = shown.filter(F.col("h1").isNotNull()).select("pos", "h1", "h2", "first_ix").distinct()
    found = (
        cells.filter(F.length("text") > LONG)
        .join(wanted.withColumnRenamed("first_ix", "ix"), ["pos", "ix"])
        .filter(
            (F.xxhash64("text") == F.col("h1")) & (F.xxhash64(F.lit(1), F.col("text")) == F.col("h2"))
        )
        .groupBy("pos", "h1", "h2")
        .agg(F.min("text").alias("text"))
    )
    return shown.join(found, ["pos", "h1", "h2"], "left").withColumn(
        "value", F.coalesce("text", "value")
    )


def _samples(shown: DataFrame) -> DataFrame:
    return (
        shown.filter("kind = 'sample'")
        .groupBy("pos")
        .agg(F.array_sort(F.collect_list(F.struct("first_ix", "value"))).alias("s"))
        .select("pos", F.col("s.value").alias("samples"))
    )


def _casing(shown: DataFrame) -> DataFrame:
    variants = (
        shown.filter("kind = 'casing'")
        .groupBy("pos", "grp")
        .agg(F.array_sort(F.collect_list(F.struct("first_ix", "value"))).alias("v"))
        .select(
            "pos",
            "grp",
            F.concat(F.lit('"'), F.array_join(F.col("v.value"), '" vs "'), F.lit('"')).alias("g"),
        )
    )
    return (
        variants.groupBy("pos")
        .agg(F.array_sort(F.collect_list(F.struct("grp", "g"))).alias("groups"))
        .select("pos", F.array_join(F.col("groups.g"), ", ").alias("casing"))
    )


def _typos(shown: DataFrame, min_length: int) -> DataFrame:
    """Pairs of similar values in columns that hold only a few values."""
    listed = (
        shown.filter("kind = 'few'")
        .groupBy("pos")
        # At most 25 values per column: others are not among the shown.
        .agg(F.array_sort(F.collect_list(F.struct("first_ix", "value", "n"))).alias("v"))
    )
    left = listed.select("pos", "v", F.posexplode("v").alias("i", "a"))
    both = left.select("pos", "i", "a", F.posexplode("v").alias("j", "b")).filter(
        F.col("i") < F.col("j")
    )
    a, b = F.lower(F.col("a.value")), F.lower(F.col("b.value"))
    alike = (
        (a != b)
        & (F.levenshtein(a, b, TYPO_MAX_EDITS) >= 0)
        & (F.least(F.length(a), F.length(b)) >= min_length)
    )
    later_is_typo = F.col("a.n") >= F.col("b.n")
    typo = F.when(later_is_typo, F.col("b.value")).otherwise(F.col("a.value"))
    canon = F.when(later_is_typo, F.col("a.value")).otherwise(F.col("b.value"))
    pair = F.concat(F.lit('"'), typo, F.lit('" ≈ "'), canon, F.lit('"'))
    return (
        both.filter(alike)
        .groupBy("pos")
        .agg(F.array_sort(F.collect_list(F.struct("i", "j", pair.alias("p")))).alias("pairs"))
        .select(
            "pos",
            F.array_join(F.slice(F.col("pairs.p"), 1, TYPO_PAIRS_SHOWN), ", ").alias("typos"),
        )
    )


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order_col: str = ROW_INDEX,
    typo_min_length: int = 0,
    max_casings: int | None = None,
    approx: bool = False,
) -> DataFrame:
    """One row per column, in column order (``pos``).

    Columns: pos, name, inferred_type, null_count, null_rate, distinct_count,
    samples, issues, date_formats. Null means the empty text. ``order_col``
    tells which value was seen first; rows sharing an index are taken in the
    order of their texts (long ones by their first ``LEAD`` characters).

    ``approx`` counts distinct values by sketches, within some percent, so that
    no values are shuffled; casings and typos are then not looked for.

    Staging the distinct values and the per-column counters (one row per
    column) run at once; the findings are lazy.
    """
    names = list(columns or [c for c in df.columns if c != order_col])
    cells = _cells_of(df, names, order_col, dealt=not approx)
    found = profile_cells(df.sparkSession, cells, names, typo_min_length, max_casings, approx)
    return found.orderBy("pos")


def profile_many(
    datasets: dict[str, DataFrame],
    order_col: str = ROW_INDEX,
    typo_min_length: int = 0,
    max_casings: int | None = None,
    approx: bool = False,
) -> DataFrame:
    """Profiles of any number of datasets, with their ``dataset_id``, in one pass over all.

    The columns of all datasets are numbered through, so however many there are,
    the jobs are those of one profile.
    """
    names: list[str] = []
    owners: list[tuple[int, str, int]] = []
    parts: list[Cells] = []
    for dataset_id, df in datasets.items():
        own = [c for c in df.columns if c != order_col]
        parts.append(_cells_of(df, own, order_col, len(names), dealt=not approx))
        owners += [(len(names) + i, dataset_id, i) for i in range(len(own))]
        names += own

    def cells(positions: set[int] | None) -> DataFrame:
        wanted = [c for part in parts if (c := part(positions)) is not None]
        return reduce(DataFrame.unionByName, wanted)

    spark = next(iter(datasets.values())).sparkSession
    found = profile_cells(spark, cells, names, typo_min_length, max_casings, approx)
    owner = spark.createDataFrame(owners, "pos int, dataset_id string, own_pos int")
    return (
        found.join(F.broadcast(owner), "pos")  # a row per column of the schemas
        .orderBy("pos")
        .withColumn("pos", F.col("own_pos"))
        .drop("own_pos")
    )


def _sketched(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-column counters over all cells, and early values, without grouping by value."""
    text = F.col("text")
    long = F.length(text) > LONG
    rows = cells.select(
        "pos",
        F.col("ix").alias("first_ix"),
        F.when(long, F.substring(text, 1, LEAD)).otherwise(text).alias("value"),
        *_hashes(text, long, "h"),
        F.when(long, _verdict(text)).alias("verdict"),
        F.when(text != "", F.xxhash64(text)).alias("whole"),
    )
    distinct = F.approx_count_distinct("whole", APPROX_ERROR)
    stats = stage(_column_stats(rows, F.lit(1), distinct), "column-sketches")
    early = (
        cells.join(F.broadcast(stats.select("pos", "sample_bound")), "pos")  # a row per column
        .filter(F.col("sample_bound").isNull() | (F.col("ix") <= F.col("sample_bound")))
        .select("pos", "ix", "text")
    )
    return stats, _distinct(early)


def profile_cells(
    spark: SparkSession,
    cells: Cells,
    names: Sequence[str],
    typo_min_length: int = 0,
    max_casings: int | None = None,
    approx: bool = False,
) -> DataFrame:
    """The profile of columns ``names``, whose cells (pos, ix, text) ``cells`` gives."""
    if approx:
        counters, values = _sketched(cells(None))
    else:
        values = stage(_distinct(cells(None)), "column-values", TASK_BYTES)
        counters = _column_stats(values)
    found = {r.pos: r for r in counters.collect()}
    rows = []
    for pos, name in enumerate(names):
        r = found.get(pos)
        rows.append(
            (pos, name, r.inferred_type, r.total, r.null_count, r.distinct_count,
             list(r.formats), r.marked, r.padded, r.sample_bound)
            if r is not None
            else (pos, name, "integer", 0, 0, 0, [], False, False, None)
        )
    stats = spark.createDataFrame(rows, _STATS_SCHEMA)
    string_columns = [p for p, r in found.items() if r.inferred_type == "string" and not approx]
    few = [p for p in string_columns if 1 < found[p].distinct_count <= TYPO_MAX_VALUES]

    shown = _sample_values(values, stats)
    if string_columns:
        shown = shown.union(_casing_values(values, string_columns, max_casings))
    if few:
        filled = values.filter(F.col("pos").isin(few) & (F.col("value") != ""))
        shown = shown.union(_shown(filled, "few", F.lit(0)))
    if long_columns := {p for p, r in found.items() if r.has_long}:
        shown = stage(_texts_of(shown, cells(long_columns)), "shown-values")

    rate = F.coalesce(F.try_divide("null_count", "total"), F.lit(0.0))
    numeric = F.col("inferred_type").isin("integer", "float")
    is_date = F.col("inferred_type") == "date"
    formats = F.when(is_date, F.col("formats")).otherwise(F.array().cast("array<string>"))
    percent = half_up(rate * 100, 0).cast("bigint").cast("string")
    issues = F.array_compact(
        F.array(
            F.when(
                rate > HIGH_NULL_RATE,
                F.concat(F.lit("High null rate — "), percent, F.lit("% of values are empty")),
            ),
            F.when(
                F.size(formats) > 1,
                F.concat(
                    F.lit("Mixed date formats in one column: "), F.array_join(formats, ", ")
                ),
            ),
            F.when(
                numeric & F.col("marked"),
                "Numeric values contain currency symbols or thousands separators",
            ),
            F.when(
                F.col("casing").isNotNull(),
                F.concat(F.lit("Inconsistent casing: "), F.col("casing")),
            ),
            F.when(
                F.col("typos").isNotNull(), F.concat(F.lit("Possible typos: "), F.col("typos"))
            ),
            F.when(F.col("padded"), "Values contain leading or trailing whitespace"),
        )
    )
    return (
        stats.join(_samples(shown), "pos", "left")
        .join(_casing(shown), "pos", "left")
        .join(_typos(shown, typo_min_length), "pos", "left")
        .select(
            "pos",
            F.col("column").alias("name"),
            "inferred_type",
            "null_count",
            rate.alias("null_rate"),
            "distinct_count",
            F.coalesce("samples", F.array().cast("array<string>")).alias("samples"),
            issues.alias("issues"),
            formats.alias("date_formats"),
        )
    )


def issue_total(profiles: DataFrame) -> DataFrame:
    """How many findings a dataset has."""
    return profiles.agg(F.coalesce(F.sum(F.size("issues")), F.lit(0)).alias("issue_total"))
