"""Matching source columns to target fields, for a whole catalogue of tables at once."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import half_up, name_key, name_tokens
from ..plans.entities import FREIGHT, EntitySpec, FieldSpec

# What each kind of name match scores, and the score from which
# a column is taken.
SAME_NAME = 1.0
SYNONYM = 0.95
CONTAINED = 0.85
SHARED_WORDS_FROM, SHARED_WORDS_BASE, SHARED_WORDS_WEIGHT = 0.5, 0.6, 0.2
TAKE_FROM = 0.6


def columns_table(spark: SparkSession, datasets: dict[str, tuple[list[str], str]]) -> DataFrame:
    """Column names of some datasets as a table: ``{id: (columns, entity)}``."""
    return spark.createDataFrame(
        [
            (dataset_id, entity, pos, column)
            for dataset_id, (columns, entity) in datasets.items()
            for pos, column in enumerate(columns)
        ],
        "dataset_id string, entity string, col_pos int, column string",
    )


def _key(name: str) -> str:
    """``name_key`` of a name that is known beforehand."""
    return re.sub("[^a-z0-9]", "", name.lower())


def _tokens(name: str) -> list[str]:
    """``name_tokens`` of a name that is known beforehand."""
    spaced = re.sub("([a-z])([A-Z])", r"\1 \2", name).lower()
    return list(dict.fromkeys(t for t in re.split("[^a-z0-9]+", spaced) if t))


def name_similarity(field: FieldSpec, key: Column, words: Column) -> Column:
    """How well a column name, given as its key and its words, fits a field, 0 to 1."""
    field_words = _tokens(field.name)
    # The words of either side are distinct, so counting is all that the sets need.
    shared = sum((F.array_contains(words, w).cast("int") for w in field_words), F.lit(0))
    synonym = key.isin(*sorted({_key(s) for s in field.synonyms}))
    return _similarity(F.lit(_key(field.name)), synonym, F.lit(len(field_words)), shared, key, words)


def _similarity(
    f: Column, synonym: Column, n_words: Column, shared: Column, key: Column, words: Column
) -> Column:
    """``name_similarity`` for a field of key ``f`` and ``n_words`` words, ``shared`` of them in common."""
    union = F.size(words) + n_words - shared
    jaccard = F.when(union > 0, shared.cast("double") / union).otherwise(0.0)
    contained = (F.length(f) > 2) & (key != "") & (F.contains(key, f) | F.contains(f, key))
    return (
        F.when(key == f, SAME_NAME)
        .when(synonym, SYNONYM)
        .when(contained, CONTAINED)
        .when(jaccard >= SHARED_WORDS_FROM, SHARED_WORDS_BASE + SHARED_WORDS_WEIGHT * jaccard)
        .otherwise(0.0)
    )


def _by_entity(
    entity: Column,
    entities: tuple[EntitySpec, ...],
    of_field: Callable[[int, FieldSpec], Column],
) -> Column:
    """A value for every field of a named entity, as an array; null for other entities."""
    out = F.when(F.lit(False), F.lit(None))
    for e in entities:
        out = out.when(entity == e.name, F.array(*[of_field(i, f) for i, f in enumerate(e.fields)]))
    return out


def _keyed(columns: DataFrame) -> DataFrame:
    return columns.select(
        "dataset_id",
        "entity",
        "col_pos",
        "column",
        name_key(F.col("column")).alias("key"),
        name_tokens(F.col("column")).alias("words"),
    )


def _dealt(columns: DataFrame, *by: str) -> DataFrame:
    """Headings dealt out to as many tasks as a shuffle has.

    The number is given, since scoring costs more than the few bytes suggest.
    """
    partitions = int(columns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return columns.repartition(partitions, *by)


def score_columns(
    columns: DataFrame, entities: tuple[EntitySpec, ...] = FREIGHT
) -> DataFrame:
    """Every column of a dataset scored against every field of its entity.

    Field names and synonyms are constants of the configuration: no join. They come
    as an array of rows, since one expression over all fields is too long for Java to
    compile. Headings are few bytes and much to score, so a file of many is dealt out.
    """

    def texts(found: list[str]) -> Column:
        return F.array(*[F.lit(x) for x in found]).cast("array<string>")

    def field(pos: int, f: FieldSpec) -> Column:
        return F.struct(
            F.lit(pos).alias("field_pos"),
            F.lit(f.name).alias("target_field"),
            F.lit(_key(f.name)).alias("field_key"),
            texts(sorted({_key(s) for s in f.synonyms})).alias("field_synonyms"),
            texts(_tokens(f.name)).alias("field_words"),
        )

    keyed = _keyed(_dealt(columns, "dataset_id", "col_pos", "column"))
    key, words, field_words = F.col("key"), F.col("words"), F.col("field_words")
    score = _similarity(
        F.col("field_key"),
        F.array_contains("field_synonyms", key),
        F.size(field_words),
        F.size(F.array_intersect(words, field_words)),
        key,
        words,
    )
    return keyed.select("*", F.inline(_by_entity(F.col("entity"), entities, field))).select(
        "dataset_id", "entity", "field_pos", "target_field", "col_pos", "column",
        score.alias("score"),
    )


def suggest_mappings(
    columns: DataFrame, entities: tuple[EntitySpec, ...] = FREIGHT
) -> DataFrame:
    """The suggested source column of every field of every dataset.

    ``columns`` holds (dataset_id, entity, col_pos, column). Each field picks its best column, the earliest on a tie. Of the
    fields that picked the same column the best scoring one gets it (the
    earlier field on a tie); the others stay unmapped.
    """
    # One shuffle of the headings by dataset serves the maxima and the claims.
    scored = _keyed(_dealt(columns, "dataset_id")).select(
        "dataset_id",
        "entity",
        (-F.col("col_pos")).alias("rank"),
        "column",
        _by_entity(
            F.col("entity"),
            entities,
            lambda pos, f: name_similarity(f, F.col("key"), F.col("words")),
        ).alias("scores"),
    )
    def best_of(pos: int, f: FieldSpec) -> Column:
        return F.struct(
            F.lit(pos).alias("field_pos"),
            F.lit(f.name).alias("target_field"),
            F.col(f"best{pos}").alias("best"),
        )

    most = max(len(e.fields) for e in entities)
    bests = scored.groupBy("dataset_id", "entity").agg(
        *[
            F.max(F.struct(F.get("scores", i).alias("score"), "rank", "column")).alias(f"best{i}")
            for i in range(most)
        ]
    )
    best = bests.select(
        "dataset_id", "entity", F.inline(_by_entity(F.col("entity"), entities, best_of))
    ).select(
        "dataset_id", "entity", "field_pos", "target_field",
        F.col("best.score").alias("score"),
        F.when(F.col("best.score") >= TAKE_FROM, F.col("best.column")).alias("wanted"),
    )
    # At most one row per field in each group.
    claim = F.row_number().over(
        W.partitionBy("dataset_id", "wanted").orderBy(F.desc("score"), "field_pos")
    )
    taken = F.col("wanted").isNotNull() & (F.col("claim") == 1)
    return best.withColumn("claim", claim).select(
        "dataset_id",
        "entity",
        "field_pos",
        "target_field",
        F.when(taken, F.col("wanted")).alias("source_column"),
        F.when(taken, half_up(F.col("score"), 2)).otherwise(0.0).alias("confidence"),
        F.lit(False).alias("overridden"),
    )


def apply_overrides(
    mappings: DataFrame, overrides: DataFrame, order_col: str | None = None
) -> DataFrame:
    """Replace suggestions by hand-made choices.

    ``overrides`` holds (dataset_id, target_field, source_column); a null source
    column unmaps the field. If a field is overridden more than once, the row
    with the largest ``order_col`` counts; without such a column that is an
    error.
    """
    source = F.col("source_column")
    if order_col:
        last = F.max_by(F.struct(source), F.col(order_col))["source_column"]
    else:
        twice = F.concat(F.lit("several overrides of "), F.first("target_field"))
        last = F.when(F.count(F.lit(1)) > 1, F.raise_error(twice).cast("string")).otherwise(
            F.first(source)
        )
    chosen = overrides.groupBy("dataset_id", "target_field").agg(
        last.alias("chosen"), F.lit(True).alias("by_hand")
    )
    by_hand = F.col("by_hand").isNotNull()
    return mappings.join(chosen, ["dataset_id", "target_field"], "left").select(
        "dataset_id",
        "entity",
        "field_pos",
        "target_field",
        F.when(by_hand, F.col("chosen")).otherwise(F.col("source_column")).alias("source_column"),
        F.when(by_hand, 1.0).otherwise(F.col("confidence")).alias("confidence"),
        (by_hand | F.col("overridden")).alias("overridden"),
    )


def mapping_status(mappings: DataFrame) -> DataFrame:
    """Add a readable ``status``: unmapped, manual, or auto with its confidence."""
    percent = half_up(F.col("confidence") * 100, 0).cast("bigint").cast("string")
    return mappings.withColumn(
        "status",
        F.when(F.col("source_column").isNull(), "unmapped")
        .when(F.col("overridden"), "manual")
        .otherwise(F.concat(F.lit("auto · "), percent, F.lit("%"))),
    )


def mappings_by_dataset(mappings: DataFrame) -> dict[str, dict[str, str | None]]:
    """The mapping of each dataset as a dictionary: one entry per field."""
    out: dict[str, dict[str, str | None]] = {}
    for r in mappings.select("dataset_id", "target_field", "source_column").collect():
        out.setdefault(r.dataset_id, {})[r.target_field] = r.source_column
    return out


def mapping_of(mappings: DataFrame, dataset_id: str) -> dict[str, str | None]:
    return mappings_by_dataset(mappings.filter(F.col("dataset_id") == dataset_id))[dataset_id]
