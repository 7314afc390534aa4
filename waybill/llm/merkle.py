"""A Merkle manifest of a dataset: every row can be proved to belong to one root digest.

A row's leaf is the SHA-256 of its fields, each written with its length. The
leaves of a group (a source) ascend by id and are hashed by threes until one
node, the group's subroot, is left; the subroots, in order of the groups, are
hashed in the same way to the root.

**Method.** Rows are ranked, and a rank is written in digits of base three. A
block holds the rows that agree in all but their last ``DIGITS`` digits, 729 at
most. Within a block the digits are grouped away one after the other, the last
one first: each step nests the structs of up to three children in the struct of
their parent and hashes them. All steps share the one shuffle by (group, block).
The nested struct of a block holds all siblings that its rows need, so one
transform over it and an explode write the proofs: rows are joined with nothing.
Blocks are the rows of the next tier, 729 times fewer, until each group has one;
on the way down a block gets the path above it by an equi-join of blocks.

Ranks come from a range sort by (group, id, leaf) whose parts are counted: the
place in a part, plus the sizes of the group's parts before. A group that holds a
third of all rows spans many parts, and so do equal rows, which are told apart
by a running number. No window runs over the rows of a group; the one over the
sizes has a row per part and group.

Special cases: a null field is ``-``, which no written value is. A null group is
a group of its own, before all others; null ids come first in their group. Rows
with the same id are ordered by their leaves, so which of them is which is
decided by content. Repeated rows are leaves of their own. A group of one row
has its leaf as subroot, and a single subroot is the root; their proofs are the
digest of nothing. An empty table has no rows and no root. Texts are hashed whole
in the first pass and not shuffled. Columns other than the named ones play no
part, and output names cannot clash with them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage
from .words import quoted

WAYS = 3  # nodes that are hashed together
DIGITS = 6  # levels within a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left: string, right: string>>"


def leaf_of(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields: ``-`` for null, else byte count, colon and value."""
    texts = [f.cast("string") for f in fields]
    written = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts
    ]
    return F.sha2(F.concat(*written), 256)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on a path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(
        path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256)
    )


def _height(n: Column) -> Column:
    """How many times ``n`` nodes are hashed by threes until one is left."""
    powers = F.array(*[F.lit(WAYS**k).cast("bigint") for k in range(39)])
    return F.size(F.filter(powers, lambda p: p < n))


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` (staged) with ``rank`` from 0 within the group, and ``n``, the group's size."""
    told_apart = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = [group, *order, "tie"]
    placed = stage(
        told_apart.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("tie")
        .withColumn("at", F.monotonically_increasing_id()),  # part, and place in it
        "merkle-sorted",
    ).withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy(group, "part").agg(
        F.count(F.lit(1)).alias("size"), F.min("at").alias("first")
    )
    whole = W.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select(
        group,
        "part",
        "first",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.sum("size").over(whole).alias("n"),
    )
    return placed.join(starts, [group, "part"]).select(
        *rows.columns, (F.col("start") + F.col("at") - F.col("first")).alias("rank"), "n"
    )


def _blocks(items: DataFrame) -> DataFrame:
    """Blocks of (grp, rank, height, node, payload): their node and nested children."""
    level = items.select(
        "grp",
        "height",
        F.expr(f"rank div {WAYS**DIGITS}").alias("block"),
        *[
            F.expr(f"cast(rank div {WAYS**k} % {WAYS} as int)").alias(f"digit{k}")
            for k in range(DIGITS)
        ],
        "node",
        F.col("payload").alias("below"),
    ).repartition("grp", "block")
    for k in range(DIGITS):
        kid = F.struct(F.col(f"digit{k}").alias("digit"), "node", "below")
        keys = ["grp", "height", "block", *[f"digit{j}" for j in range(k + 1, DIGITS)]]
        grouped = level.groupBy(*keys).agg(F.array_sort(F.collect_list(kid)).alias("below"))
        nodes = F.col("below")["node"]
        hashed = F.sha2(F.array_join(nodes, ""), 256)
        node = F.when(F.col("height") > k, hashed).otherwise(F.get(nodes, F.lit(0)))
        level = grouped.withColumn("node", node)
    return level


def _walked(kids: Column, level: int, place: Column, path: Column) -> Column:
    """The rows below nested children: (place, node, payload, path from the row up)."""

    def side(test) -> Column:
        return F.array_join(F.transform(F.filter(kids, test), lambda k: k["node"]), "")

    def below(kid: Column) -> Column:
        siblings = F.struct(
            side(lambda k: k["digit"] < kid["digit"]).alias("left"),
            side(lambda k: k["digit"] > kid["digit"]).alias("right"),
        )
        longer = F.when(F.col("height") > level, F.array_prepend(path, siblings)).otherwise(path)
        here = place * WAYS + kid["digit"]
        if level:
            return _walked(kid["below"], level - 1, here, longer)
        return F.array(
            F.struct(
                here.alias("place"),
                kid["node"].alias("node"),
                kid["below"].alias("payload"),
                longer.alias("path"),
            )
        )

    return F.flatten(F.transform(kids, below))


def _tiers(items: DataFrame, height: int) -> list[DataFrame]:
    """Staged blocks of every tier, from the rows up to one block per group."""
    tiers = []
    while True:
        tiers.append(stage(_blocks(items), "merkle-blocks"))
        height -= DIGITS
        if height <= 0:
            return tiers
        items = tiers[-1].select(
            "grp",
            F.col("block").alias("rank"),
            (F.col("height") - DIGITS).alias("height"),
            "node",
            F.lit(None).cast("int").alias("payload"),
        )


def _proved(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """(grp, place, node, payload, path, subroot, root) of the rows below the tiers' blocks.

    ``above``: (grp, block, path, subroot, root) of the one block of each group.
    """
    for tier in reversed(tiers):
        rows = _walked(F.col("below"), DIGITS - 1, F.col("block"), F.col("path"))
        found = tier.join(above, ["grp", "block"]).select(
            "grp", "subroot", "root", F.inline(rows)
        )
        above = found.select("grp", F.col("place").alias("block"), "path", "subroot", "root")
    return found


def _tree(items: DataFrame) -> list[DataFrame]:
    """Tiers over (grp, rank, n, node, payload)."""
    tall = items.withColumn("height", _height(F.col("n")))
    height = tall.agg(F.max("height")).first()[0] or 0
    return _tiers(tall.drop("n"), height)


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    group_col: str = "source",
    carried: dict[str, Column] | None = None,
) -> DataFrame:
    """(id, group, leaf, subroot, root, path, and what is ``carried``) of every row.

    ``path`` holds the siblings left and right of the row's node at each level
    from the leaf to the root. ``carried`` are columns over ``docs`` that pass
    through, such as the leaf of another state of the row; keep them small.
    """
    carried = carried or {}
    group = quoted(group_col).cast("string")
    # '-' sorts before '=', so null comes first and the others by their bytes.
    key = F.coalesce(F.concat(F.lit("="), group), F.lit("-"))
    leaves = stage(
        docs.select(
            key.alias("grp"),
            quoted(id_col).alias("id"),
            leaf_of([quoted(f) for f in fields]).alias("node"),
            F.struct(F.lit(0).alias("none"), *[c.alias(n) for n, c in carried.items()]).alias(
                "carried"
            ),
        ),
        "merkle-leaves",
    )
    placed = ranked(leaves, "grp", ["id", "node"]).withColumn(
        "payload", F.struct("id", "carried")
    )
    tiers = _tree(placed.select("grp", "rank", "n", "node", "payload"))

    subroots = stage(tiers[-1].select("grp", F.col("node")), "merkle-subroots")
    top = ranked(subroots.withColumn("all", F.lit("")), "all", ["grp"])
    sources = _tree(
        top.select(
            F.col("all").alias("grp"), "rank", "n", "node", F.struct("grp").alias("payload")
        )
    )
    no_path = F.array().cast(_PATH)
    root = sources[-1].select(
        "grp",
        "block",
        no_path.alias("path"),
        F.lit("").alias("subroot"),
        F.col("node").alias("root"),
    )
    above = _proved(sources, root).select(
        F.col("payload")["grp"].alias("grp"),
        F.lit(0).cast("bigint").alias("block"),
        "path",
        F.col("node").alias("subroot"),
        "root",
    )
    proved = _proved(tiers, above)
    return proved.select(
        F.col("payload")["id"].alias("id"),
        F.when(F.col("grp") != "-", F.substring("grp", 2, 2**31 - 1)).alias("group"),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        "path",
        *[F.col("payload")["carried"][n].alias(n) for n in carried],
    )
