"""Connected components by alternating large-star and small-star steps.

Each step rewires links towards smaller nodes with joins and minimum
aggregates; nothing gathers the neighbours of a node, so a hub may have any
number of links. The links are staged after each round (a written table in the
shared folder), which cuts the lineage and survives lost executors. Rounds grow
with the logarithm of the largest component, not with its diameter. At most
``FEW`` links, a few megabytes, are joined by one task instead of in rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staging import drop_staged, stage

FEW = 1 << 17  # links that one task joins


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b"), F.col("a")))


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), "m")


def _large_star(links: DataFrame) -> DataFrame:
    """Neighbours above a node are linked to the smallest of the node and its neighbours."""
    pairs = _both_ways(links)
    joined = pairs.where("b > a").join(_least(pairs), F.col("a") == F.col("of"))
    return joined.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Neighbours below a node, and the node, are linked to the smallest of them. a > b."""
    least = _least(links)
    joined = links.join(least, F.col("a") == F.col("of"))
    lower = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.union(least.select(F.col("of").alias("a"), F.col("m").alias("b"))).distinct()


def _mark(links: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b")
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.bit_xor(hashed), F.sum(F.shiftright(hashed, 20))
        ).first()
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of all links and the smallest node of their component."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns)):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    if up:
        nodes = list(up)
        columns = [pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "root"])


def connected(links: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``links`` (a, b); root is the smallest of the component.

    Links from a node to itself are ignored. No links give no rows.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    now = stage(
        links.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "links"
    )
    mark = _mark(now)
    if 0 < mark[0] <= FEW and now.schema["a"].dataType == now.schema["b"].dataType == T.LongType():
        roots = now.select("a", "b").coalesce(1).mapInArrow(_joined, "node bigint, root bigint")
        roots = stage(roots, "links")
        drop_staged(now)
        return roots
    while mark[0]:
        now = stage(_small_star(_large_star(now)), "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
