"""Mixing sources to target weights along a curriculum.

Every source has a weight at some knots of the training run (0 to 1), linear in
between. The integral of that schedule is the source's share of all words; a
source repeats at most ``max_repeats`` times, and what is over is shared among
the others by weight. Inside a source the documents stand in the order of a
hash; a document's words take the place [start, start + size) of the source's
demand, once per round through the source. Inverting the cumulative demand
gives the point of training where they are due. The result is sorted by it.

Running sums over a source never sort it in one task: documents fall in buckets
of the hash (about the square root of the number of rows), the bucket sums are
added up per source, and documents only inside their bucket. The table of
sources (one row each) is the only thing handled as a whole.

Special cases: null or empty texts have size 0, are taken 0 words and have no
position. The last document of a source is taken up to its target. Sources
whose documents are all empty have target 0. Null sources are a source, last in
order. Repeated rows are documents of their own; ties in the order key are
broken by id and size, rows that agree in all of these are interchangeable.
An empty table gives an empty result. Extra columns are handed through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .words import free_name, quoted, word_count

# Weight at the start and at the end of training, by the rank of the source;
# the means are 5, 2 and 1.
CLASSES = (((0.0, 6.0), (1.0, 4.0)), ((0.0, 1.5), (1.0, 2.5)), ((0.0, 0.5), (1.0, 1.5)))

_OWN = "__mix_"  # columns of this module while it works


def _own(name: str) -> Column:
    return F.col(_OWN + name)


def _area(knots: tuple[tuple[float, float], ...]) -> list[float]:
    """Integral of a piecewise linear schedule up to each knot."""
    sums = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        if t1 <= t0 or min(w0, w1) < 0:
            raise ValueError("knots must rise in time and weights be 0 or more")
        sums.append(sums[-1] + (t1 - t0) * (w0 + w1) / 2)
    if knots[0][0] != 0 or knots[-1][0] != 1 or sums[-1] <= 0:
        raise ValueError("a schedule runs from 0 to 1 and has some weight")
    return sums


def _by_class(classes, values: list[Column]) -> Column:
    out = F.lit(None)
    for i, v in enumerate(values):
        out = F.when(_own("class") == i, v).otherwise(out)
    return out


def due_at(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time when ``share`` (0 to 1) of a schedule's whole demand is used up."""
    sums = _area(knots)
    need = share * F.lit(sums[-1])
    out = F.lit(1.0)
    for i in reversed(range(len(knots) - 1)):
        (t0, w0), (t1, w1) = knots[i], knots[i + 1]
        slope = (w1 - w0) / (t1 - t0)
        rest = need - F.lit(sums[i])
        # w0 x + slope x^2 / 2 = rest, in the form that also holds for slope 0
        x = F.lit(2.0) * rest / (
            F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2.0 * slope) * rest, F.lit(0.0)))
        )
        at = F.when(rest <= 0, F.lit(t0)).otherwise(F.least(F.lit(t0) + x, F.lit(t1)))
        out = F.when(need < F.lit(sums[i + 1]), at).otherwise(out)
    return out


def source_targets(
    sizes: DataFrame, classes=CLASSES, max_repeats: int = 3, share: float = 1.0
) -> DataFrame:
    """Targets from ``(source, source_size)``, one row per source.

    Sources take the schedules of ``classes`` in turn, by code point, null last.
    Fixing capped sources one after the other, in the order of cap per weight,
    is the fixed point of sharing the excess again and again.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    total = Window.partitionBy()
    weights = [_area(k)[-1] for k in classes]
    # Every window runs over one row per source, not over documents.
    rows = (
        sizes.withColumn(_OWN + "class", (F.row_number().over(order) - 1) % len(classes))
        .withColumn("weight", _by_class(classes, [F.lit(w) for w in weights]))
        .withColumn("cap", F.col("source_size") * F.lit(max_repeats))
    )
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = (
        rows.withColumn("whole", F.sum("source_size").over(total) * F.lit(float(share)))
        .withColumn("left", F.col("whole") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onward))
        .withColumn("free", F.col("cap") > F.col("level") * F.col("weight"))
    )
    # The level of the first source that stays below its cap holds for all that follow.
    need = F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    open_level = F.min_by(
        F.when(F.col("free"), F.col("level")), F.when(F.col("free"), need)
    ).over(total)
    cap = F.col("cap").cast("double")
    return rows.withColumn("open_level", open_level).select(
        "source",
        "source_size",
        "weight",
        _own("class"),
        F.coalesce(F.least(cap, F.col("open_level") * F.col("weight")), cap).alias("target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    classes=CLASSES,
    max_repeats: int = 3,
    share: float = 1.0,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` and ``rounds``.

    ``rounds`` is an array of (round, words, position): how many of its words
    are taken in each round through the source, and when. The names are added
    behind the columns of ``docs``; a column of the same name is replaced.
    """
    spark = docs.sparkSession
    added = ["size", "source_size", "target", "taken", "rounds"]
    # Columns called like those of this module while it works step aside until the end.
    clashing = [c for c in docs.columns if c.lower().startswith(_OWN)]
    aside = {c: free_name(docs.columns, f"aside{i}") for i, c in enumerate(clashing)}
    docs = docs.withColumnsRenamed(aside)
    id_col, text_col, source_col = (aside.get(c, c) for c in (id_col, text_col, source_col))
    keep = [c for c in docs.columns if c.lower() not in added]
    ident = F.coalesce(quoted(id_col).cast("string"), F.lit(""))
    work = docs.select(
        *[quoted(c) for c in keep],
        quoted(source_col).alias(_OWN + "source"),
        quoted(id_col).alias(_OWN + "id"),
        word_count(quoted(text_col)).alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), ident)).alias(_OWN + "order"),
    )
    source = _own("source")
    base = stage(
        work.groupBy(source.alias("source"), F.substring(_own("order"), 1, 5).alias("fine")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")
        ),
        "mix-sums",
    )
    n = base.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    digits = min(5, max(1, math.ceil(math.log(max(n, 1), 16) / 2)))
    bucket = F.substring(_own("order"), 1, digits)
    targets = source_targets(
        base.groupBy("source").agg(F.sum("size").alias("source_size")), classes, max_repeats, share
    )
    starts = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        base.groupBy("source", F.substring("fine", 1, digits).alias("bucket"))
        .agg(F.sum("size").alias("in_bucket"))
        .withColumn("offset", F.coalesce(F.sum("in_bucket").over(starts), F.lit(0)))
    )
    # Source and bucket are one column, so that documents are dealt out once for the sums and the join.
    places = stage(
        offsets.join(targets, offsets["source"].eqNullSafe(targets["source"])).select(
            F.struct(offsets["source"], "bucket").alias(_OWN + "place"),
            F.col("offset").alias(_OWN + "offset"),
            "source_size",
            "target",
            _own("class"),
        ),
        "mix-places",
    )
    place = F.struct(source.alias("source"), bucket.alias("bucket"))
    place = place.cast(places.schema[_OWN + "place"].dataType)  # else the join deals out a cast of it
    work = work.withColumn(_OWN + "place", place)
    inside = Window.partitionBy(_own("place")).orderBy(
        _own("order"), _own("id"), F.col("size")
    ).rowsBetween(Window.unboundedPreceding, -1)
    placed = work.withColumn(_OWN + "before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = placed.join(places, _OWN + "place", "left")
    limit = F.round("target").cast("bigint")
    start = _own("offset") + _own("before")

    def words(r: int) -> Column:
        at = start + F.lit(r) * F.col("source_size")
        return F.greatest(F.least(F.col("size"), limit - at), F.lit(0)).cast("bigint")

    def one(r: int) -> Column:
        at = start + F.lit(r) * F.col("source_size")
        due = at.cast("double") / F.greatest(F.col("target"), F.lit(1.0))
        return F.struct(
            F.lit(r + 1).alias("round"),
            words(r).alias("words"),
            _by_class(classes, [due_at(due, k) for k in classes]).alias("position"),
        )

    every = F.array(*[one(r) for r in range(max_repeats)])
    return joined.select(
        *[quoted(c) for c in keep],
        "size",
        "source_size",
        "target",
        sum((words(r) for r in range(1, max_repeats)), words(0)).alias("taken"),
        F.filter(every, lambda x: x["words"] > 0).alias("rounds"),
    ).withColumnsRenamed({b: a for a, b in aside.items()})


def in_training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document and round that is taken, range-sorted by ``position``."""
    at = free_name(mixed.columns, "taken_at")
    rest = [c for c in mixed.columns if c.lower() not in ("rounds", "round", "words", "position")]
    return (
        mixed.select(*[quoted(c) for c in rest], F.explode("rounds").alias(at))
        .select(*[quoted(c) for c in rest],
                *[F.col(at)[c].alias(c) for c in ("round", "words", "position")])
        .orderBy("position", quoted(id_col), "round")
    )
