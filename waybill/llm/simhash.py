"""SimHash near-dedup by the generalised pigeonhole principle.

1. ``fingerprints``: 64-bit SimHash of word shingles, in Arrow batches.
2. Equal fingerprints become one node; a group of exact copies costs one row.
3. ``plan_partitions``: the 64 bits are grouped so that correlated bits share a
   partition. If thresholds e_i of m partitions sum to k - m + 1, two
   fingerprints at k or fewer differing bits lie within e_i of each other in
   some partition i (-1 means that a partition is not searched). Dynamic
   programming allots the thresholds so that probes and estimated candidates
   cost least; the estimate uses the moments of every pair of bits over all
   fingerprints, added up in the tasks (64 x 64 numbers reach the driver).
4. Every node is indexed by its value in each searched partition and probes all
   values within that partition's threshold. Rows meet by (partition, value) in
   one shuffle; whole 64-bit fingerprints are compared in sorted runs, and each
   task passes on a spanning forest of the links it verified, never all pairs.
   Values that hold more than ``RUN`` nodes are cut into blocks: an index row
   stands in one block, the probing rows are copied to every block.
5. ``connected`` joins the forests to components with staged steps.

A text within the threshold of another is always found: there is no cap on
buckets, candidates or partners.

Special cases: null, empty or blank texts have fingerprint 0 and are linked like
any other. Texts with fewer words than a shingle are one shingle. Null ids take
no part in the choice of a component's id, which is null if all are. Repeated
rows and ids keep a row each. Columns of the input are not handed through by
``near_duplicates``; ``drop_near_duplicates`` keeps them all.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staging import stage
from .components import connected
from .words import free_name, quoted

BITS = 64
SEED = 42
RUN = 8192  # nodes of one value that are compared in one block
ROW_COST = 100.0  # of shuffling one probe, in comparisons of two fingerprints


# --- fingerprints ---------------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text as a signed 64-bit number."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and ASCII white space only
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= shingle:
        value = xxhash.xxh64_intdigest(joined, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = [0, *(ends[: n - shingle] + 1).tolist()]
        digest = xxhash.xxh64_digest
        hashes = b"".join(
            [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
        )
        set_bits = _bit_counts(np.frombuffer(hashes, np.uint8).reshape(-1, 8))
        value = int.from_bytes(np.packbits(2 * set_bits > len(starts)).tobytes(), "big")
    return value - (1 << 64) if value >> 63 else value


def _bit_counts(rows: np.ndarray) -> np.ndarray:
    """How many rows have each bit set: sums of 255 rows fit in a byte."""
    total = np.zeros(BITS, np.int64)
    whole = len(rows) // 255 * 255
    for at in range(0, whole, 255 * 64):
        bits = np.unpackbits(rows[at : min(at + 255 * 64, whole)], axis=1)
        total += bits.reshape(-1, 255, BITS).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return total + np.unpackbits(rows[whole:], axis=1).sum(0, dtype=np.int64)


def fingerprints(
    docs: DataFrame, text_col: str = "text", out_col: str = "fp", shingle: int = 4
) -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a bigint."""

    @F.pandas_udf("bigint")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return docs.withColumn(out_col, simhash(quoted(text_col)))


def fingerprint_hex(c: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))


# --- plan ------------------------------------------------------------------------------------


def bit_moments(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j both set, over all of them."""
    names = [f"c{j}" for j in range(BITS)]
    schema = T.StructType(
        [T.StructField("bit", T.IntegerType()), T.StructField("n", T.LongType())]
        + [T.StructField(c, T.LongType()) for c in names]
    )

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            raw = batch.column(0).to_numpy().astype(">i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1).astype(np.float32)
            both += bits.T @ bits
            n += len(bits)
        counts = both.astype(np.int64)
        columns = [np.arange(BITS, dtype=np.int32), np.full(BITS, n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in [*columns, *counts.T]], names=["bit", "n", *names]
        )

    rows = (
        nodes.select("fp")
        .mapInArrow(moments, schema)
        .groupBy("bit")
        .agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])
        .collect()
    )  # 64 rows
    both = np.zeros((BITS, BITS))
    for r in rows:
        both[r.bit] = [r[c] for c in names]
    return (rows[0].n if rows else 0), both


def _groups(correlation: np.ndarray, m: int) -> list[list[int]]:
    """64 bits in m groups of about equal size; each grows by the bit most correlated with it."""
    left, groups = set(range(BITS)), []
    for g in range(m):
        size = len(left) // (m - g)
        seed = max(left, key=lambda b: (sum(correlation[b, c] for c in left if c != b), -b))
        group = [seed]
        left.discard(seed)
        while len(group) < size:
            best = max(left, key=lambda b: (sum(correlation[b, c] for c in group), -b))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def _within(differ: np.ndarray, pairs: np.ndarray, group: list[int], most: int) -> list[float]:
    """Estimated share of pairs at 0..most or fewer differing bits inside a group.

    Mean and variance of the number of differing bits follow from the moments;
    a beta-binomial with the same two stands for its distribution.
    """
    w = len(group)
    d = differ[group]
    mean = float(d.sum())
    spread = float(pairs[np.ix_(group, group)].sum())
    p = min(max(mean / w, 1e-6), 1 - 1e-6)
    rho = (spread / (w * p * (1 - p)) - 1) / (w - 1) if w > 1 else 0.0
    rho = min(max(rho, 1e-6), 0.999)
    a, b = p * (1 / rho - 1), (1 - p) * (1 / rho - 1)

    def share(k: int) -> float:
        choose = lgamma(w + 1) - lgamma(k + 1) - lgamma(w - k + 1)
        beta = lgamma(k + a) + lgamma(w - k + b) - lgamma(w + a + b)
        return exp(choose + beta - lgamma(a) - lgamma(b) + lgamma(a + b))

    return list(np.cumsum([share(k) for k in range(min(most, w) + 1)]))


def _ball(w: int, e: int) -> int:
    return sum(round(exp(lgamma(w + 1) - lgamma(k + 1) - lgamma(w - k + 1))) for k in range(e + 1))


def allot(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """Thresholds with the least total cost whose (threshold + 1) sum to ``units``.

    ``costs[i][e]`` is the cost of searching partition i within e; -1 costs nothing.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for e in range(-1, min(len(row), units - used)):
                now = cost + (row[e] if e >= 0 else 0.0)
                if used + e + 1 not in grown or now < grown[used + e + 1][0]:
                    grown[used + e + 1] = (now, [*chosen, e])
        best = grown
    return best.get(units, (float("inf"), []))


def plan_partitions(n: int, both: np.ndarray, radius: int = 4) -> list[tuple[list[int], int]]:
    """The searched partitions as (bits, threshold), cheapest for n fingerprints."""
    n = max(n, 1)
    mean = np.diag(both) / n
    cov = both / n - np.outer(mean, mean)
    sd = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
    correlation = np.abs(cov / np.outer(sd, sd))
    # For two independent fingerprints in +-1 form: E[differ_i], Cov[differ_i, differ_j].
    mu = 1 - 2 * mean
    second = 4 * cov + np.outer(mu, mu)
    differ = (1 - mu**2) / 2
    pairs = (second**2 - np.outer(mu**2, mu**2)) / 4
    np.fill_diagonal(pairs, differ * (1 - differ))
    best: tuple[float, list[tuple[list[int], int]]] = (float("inf"), [])
    for m in range(1, radius + 5):
        groups = _groups(correlation, m)
        costs = []
        for group in groups:
            near = _within(differ, pairs, group, radius)
            costs.append([_ball(len(group), e) * ROW_COST + n * p for e, p in enumerate(near)])
        # thresholds sum to radius - m + 1, so thresholds + 1 to radius + 1
        cost, chosen = allot(costs, radius + 1)
        if cost < best[0]:
            best = (cost, [(g, e) for g, e in zip(groups, chosen) if e >= 0])
    return best[1]


# --- probe and verify ------------------------------------------------------------------------


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _masks(bits: list[int], e: int) -> list[int]:
    """The patterns of up to e of these bits, as signed numbers; bit 0 is the highest."""
    out, layer = [0], [(0, 0)]
    for _ in range(e):
        layer = [
            (mask | 1 << (63 - bits[j]), j + 1)
            for mask, first in layer
            for j in range(first, len(bits))
        ]
        out += [mask for mask, _ in layer]
    return [_signed(m) for m in out]


def _at(part: int, value: Column, role: int) -> Column:
    return F.struct(F.lit(part).alias("part"), value.alias("value"), F.lit(role).alias("role"))


def _places(part: int, bits: list[int], e: int) -> Column:
    """Where a fingerprint stands in a partition: its own value, and those within e of it."""
    whole = _signed(sum(1 << (63 - b) for b in bits))
    value = F.col("fp").bitwiseAND(F.lit(whole).cast("bigint"))
    own = F.array(_at(part, value, 0))
    near = [F.lit(m).cast("bigint") for m in _masks(bits, e) if m]
    if not near:
        return own
    return F.concat(
        own, F.transform(F.array(*near), lambda m: _at(part, value.bitwiseXOR(m), 1))
    )


def _probes(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """Rows (part, value, role, fp): role 0 is indexed and probes itself, role 1 only probes."""
    places = F.concat(*[_places(i, bits, e) for i, (bits, e) in enumerate(plan)])
    exploded = nodes.select("fp", F.explode(places).alias("at"))
    return exploded.select("at.part", "at.value", "at.role", "fp")


_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _blocks(probes: DataFrame) -> DataFrame:
    """Values with many nodes cut into blocks of about ``RUN``; the others are block 0."""
    big = (
        probes.where(F.col("role") == 0)
        .groupBy("part", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > RUN)
        .select(
            F.col("part").alias("big_part"),
            F.col("value").alias("big_value"),
            F.ceil(F.col("n") / RUN).cast("int").alias("cuts"),
        )
    )
    joined = probes.join(
        big, (F.col("part") == F.col("big_part")) & (F.col("value") == F.col("big_value")), "left"
    )
    cuts = F.coalesce("cuts", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), cuts).cast("int")
    every = F.sequence(F.lit(0), cuts - 1)
    # An indexed row also probes the blocks after its own; one that only probes, all of them.
    places = F.when(F.col("role") == 1, every).otherwise(F.filter(every, lambda b: b >= own))
    return joined.select("part", "value", "role", "fp", own.alias("own"), F.explode(places).alias("block")).select(
        "part",
        "value",
        "block",
        F.when((F.col("role") == 0) & (F.col("block") == F.col("own")), 0)
        .otherwise(1)
        .alias("role"),
        "fp",
    )


def _verify(radius: int):
    """Compare the rows of each run with its indexed rows; yield forests of verified links."""

    def forest(key: np.ndarray, role: np.ndarray, fp: np.ndarray) -> np.ndarray:
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
        run = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(key)]))
        indexed = np.bincount(run, weights=role == 0, minlength=len(start)).astype(np.int64)
        first, many = start[run], indexed[run]
        # a row of role 0 looks at those before it, a row of role 1 at all indexed ones
        look = np.where(role == 0, np.arange(len(key)) - first, many)
        label: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := label.get(x, x)) != x:
                label[x] = x = label.get(up, up)
            return x

        found = []
        rows = np.flatnonzero(look > 0)
        shift = 0
        while len(rows):
            other = fp[first[rows] + shift]
            differ = fp[rows] ^ other
            hits = np.flatnonzero((np.bitwise_count(differ) <= radius) & (differ != 0))
            for a, b in zip(fp[rows[hits]].tolist(), other[hits].tolist()):
                x, y = top(a), top(b)
                if x != y:
                    label[x] = y
                    found.append((a, b))
            shift += 1
            rows = rows[look[rows] > shift]
        return np.array(found, np.uint64).reshape(-1, 2).view(np.int64)

    def out(links: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"]
        )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            part, value, block, role, fp = (c.to_numpy() for c in batch.columns)
            if not len(fp):
                continue
            key = np.stack([part.astype(np.int64), value, block.astype(np.int64)], axis=1)
            held.append((key, role, fp.view(np.uint64)))
            size += len(fp)
            if size < 50_000 or (key[0] == key[-1]).all():
                continue
            key, role, fp = (np.concatenate(x) for x in zip(*held))
            cut = len(key) - int(np.argmax((key[::-1] != key[-1]).any(1)))  # the last run waits
            yield out(forest(key[:cut], role[:cut], fp[:cut]))
            held, size = [(key[cut:], role[cut:], fp[cut:])], len(key) - cut
        if held:
            yield out(forest(*(np.concatenate(x) for x in zip(*held))))

    return verify


def links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) whose components are those of all pairs at ``radius`` or fewer bits.

    ``nodes``: distinct fingerprints in column ``fp``.
    """
    plan = plan_partitions(*bit_moments(nodes), radius)
    rows = _blocks(_probes(nodes, plan))
    return (
        rows.repartition("part", "value", "block")
        .sortWithinPartitions("part", "value", "block", "role")
        .mapInArrow(_verify(radius), _LINKS)
    )


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """(id, t, fp, component, component_id) per row; ``t`` hashes the text, ``component`` is a fp."""
    narrow = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    rows = stage(
        fingerprints(narrow, shingle=shingle).select("id", F.xxhash64("text").alias("t"), "fp"),
        "simhash",
    )
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    return label_rows(rows, nodes, connected(links(nodes, radius)))


def label_rows(rows: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``rows`` (id, t, fp) with the component of their node ``fp`` and its smallest id."""
    labelled = nodes.join(
        members.select(F.col("node").alias("fp"), "root"), "fp", "left"
    ).select("fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    # Staged, so that the join can split the rows of a fingerprint that many copies share.
    classes = stage(
        labelled.join(roots, "root").select(
            F.col("fp").alias("class_fp"), F.col("root").alias("component"), "component_id"
        ),
        "simhash-classes",
    )
    return rows.join(classes, F.col("fp") == F.col("class_fp")).drop("class_fp")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
) -> DataFrame:
    """One row per document: its id, ``fp`` and ``component_id`` (smallest id reachable)."""
    found = _classes(docs, id_col, text_col, shingle, radius)
    return found.select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    radius: int = 4,
) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id.

    Of rows that share this id the one with the smaller hash of its text stays,
    of rows that share both any one. A null id stands behind all others.
    """
    return keep_first(docs, _classes(docs, id_col, text_col, shingle, radius), id_col, text_col)


def keep_first(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with the first document of each component of ``found`` (id, t, component)."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t"))
    key = free_name(docs.columns, "survivor")
    best = found.groupBy("component").agg(first.alias("best"))
    survivors = best.select(F.struct("best.id", "best.t").alias(key))
    # One column, in which a null id is like another: the texts are dealt out once for join and choice.
    own = F.struct(quoted(id_col).alias("id"), F.xxhash64(quoted(text_col)).alias("t"))
    own = own.cast(survivors.schema[key].dataType)  # else the join deals out a cast of it
    kept = docs.withColumn(key, own).join(survivors, key, "left_semi")
    return kept.dropDuplicates([key]).drop(key)
