"""Near copies by the exact Jaccard similarity of word-shingle sets.

Two texts are near copies if the sets of their five-word shingles have a Jaccard
similarity of at least 0.8; copies of copies form one component.

1. Texts with the same set become one node. Nodes whose SimHash fingerprints of the
   same shingles are linked within ``RADIUS`` bits (``simhash.links``) are verified
   against the first of their component on the whole sets; what is then joined
   needs no further pairs.
2. Fingerprints miss most pairs at 0.8, so the rest is found exactly. In one order of all shingles, two sets at 0.8 share a shingle among the first
   n - ceil(0.8 n) + 1 of each (prefix filter), so nodes meet by these shingles
   in one shuffle. Any order gives the same result; shingles that are frequent
   in a sample come last, as a passage that many texts share would else bring
   all of them together. A sample of fixed size misses more of them the larger
   the table is. So where nodes make more than ``PAIRS`` pairs each, the shingles
   by which most of them meet join those that come last, and the prefixes are
   taken again. Where more than ``HOT`` nodes meet by one shingle, so do all
   frequent shingles of a sample of the texts that hold it.
3. Every pair that met, and for which the sizes and the number of shingles that
   both prefixes share allow 0.8, is verified on the whole sets.
   Where there still are too many pairs, one leader of each shingle that many nodes
   share is compared with the others first; a shingle whose nodes are all of one
   component by then needs no more pairs, so a large group of near copies is not
   compared pair by pair.
4. ``connected`` joins the verified links to components.

No pair is lost and no link stays unverified; shingles and sets are known by
hashes of 64 bits. Texts that meet by a shingle of at most ``HOT`` nodes may be
compared pair by pair; beyond that only those of which all shingles are frequent.
Staged tables are dropped as soon as the next one has been made from them.

Special cases: null, empty and blank texts have the empty set and are copies of
each other. Texts of fewer words than a shingle are one shingle. Null ids and
repeated rows are treated as in ``simhash``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import drop_staged, shuffles_freed, stage
from .components import connected
from .simhash import SEED, _bit_counts, keep_first, label_rows
from .simhash import links as simhash_links
from .words import quoted

SHINGLE = 5
RADIUS = 4  # bits in which the fingerprints of linked nodes differ, at most
SAMPLE = 10_000  # texts, about, whose shingles are counted for the order
FREQUENT = 1 << 18  # shingles that come last, at most
SLOTS = 1 << 20  # of the filter that spares texts without a partner the shuffle
PAIRS = 8  # pairs for each node and shingle that are compared without another look or leaders
ROUNDS = 6  # of leaders
HOT = 10_000  # nodes by one shingle from which the order of shingles is looked at again
REFINES = 3  # times that the order may be looked at again


def shingle_set(text: str | None) -> np.ndarray:
    """The hashes of the shingles of a text, sorted, each once."""
    return fingerprint_and_set(text)[0]


def fingerprint_and_set(text: str | None) -> tuple[np.ndarray, int]:
    """``shingle_set`` and, from the same shingles with repeats, the SimHash as a signed number."""
    import xxhash

    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and ASCII white space only
    n = len(words)
    if not n:
        return np.empty(0, np.int64), 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    width = min(SHINGLE, n)
    starts = [0, *(ends[: n - width] + 1).tolist()]
    digest = xxhash.xxh64_digest
    hashes = b"".join(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
    )
    set_bits = _bit_counts(np.frombuffer(hashes, np.uint8).reshape(-1, 8))
    value = int.from_bytes(np.packbits(2 * set_bits > len(starts)).tobytes(), "big", signed=True)
    return np.unique(np.frombuffer(hashes, ">i8").astype(np.int64)), value


def set_hash(shingles: np.ndarray) -> int:
    """A set as a signed 64-bit number."""
    import xxhash

    value = xxhash.xxh64_intdigest(shingles.tobytes(), SEED)
    return value - (1 << 64) if value >> 63 else value


def prefix(shingles: np.ndarray, often: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set, of which another set at 0.8 shares at least one."""
    n = len(shingles)
    if not n:
        return shingles
    seen = np.zeros(n, np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, shingles), len(often) - 1)
        seen = np.where(often[at] == shingles, counts[at], 0)
    return shingles[np.lexsort((shingles, seen))[: n - (4 * n + 4) // 5 + 1]]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays)))


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            sets = [shingle_set(t) for t in batch.slice(at, 256).column(0).to_pylist()]
            names = pa.array([set_hash(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([names, _lists(sets)], names=["fp", "shingles"])


_SETS = "fp bigint, shingles array<bigint>"


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles found most often in a sample of the texts, sorted, and how often."""
    share = min(1.0, SAMPLE / max(texts.count(), 1))
    bound = F.lit(min(-(1 << 63) + int(share * (1 << 64)), (1 << 63) - 1))
    found = (
        texts.where(F.xxhash64("text") <= bound)
        .select("text")
        .distinct()
        .mapInArrow(_shingled, _SETS)
        .select(F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 2")
        .orderBy(F.desc("n"), "shingle")
        .limit(FREQUENT)
        .toArrow()
    )
    often, counts = (found.column(c).to_numpy() for c in ("shingle", "n"))
    order = np.argsort(often)
    return often[order], counts[order]


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets have a similarity of 0.8 or more, staged."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    wanted = stage(named.join(nodes.select("fp", "t"), "fp").select("t").distinct(), "copies-wanted")
    slot = F.pmod("t", F.lit(SLOTS))
    slots = wanted.select(slot.alias("slot")).distinct()  # at most SLOTS rows
    near = texts.withColumn("t", F.xxhash64("text")).withColumn("slot", slot)
    own = (
        near.join(F.broadcast(slots), "slot", "left_semi")
        .groupBy("t")
        .agg(F.first("text").alias("text"))
        .join(wanted, "t", "left_semi")
    )
    sets = stage(own.select("text").mapInArrow(_shingled, _SETS), "copies-sets")
    once = sets.dropDuplicates(["fp"])
    left, right = (
        once.select(F.col("fp").alias(c), F.col("shingles").alias(f"{c}_set")) for c in ("a", "b")
    )
    common = F.size(F.array_intersect("a_set", "b_set"))
    # common / (n + m - common) >= 4 / 5
    similar = 9 * common >= 4 * (F.size("a_set") + F.size("b_set"))
    found = pairs.join(left, "a").join(right, "b").where(similar).select("a", "b")
    found = stage(found, "copies-links")
    for table in (wanted, sets):
        drop_staged(table)
    return found


def by_fingerprint(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) of nodes at 0.8 or more whose SimHash fingerprints are linked by at most
    ``RADIUS`` bits: each node with the first of its fingerprints' component."""
    sims = nodes.select(F.col("sim").alias("fp")).distinct()
    members = connected(simhash_links(sims, RADIUS)).select(F.col("node").alias("sim"), "root")
    placed = nodes.join(members, "sim", "left").select("fp", F.coalesce("root", "sim").alias("up"))
    firsts = placed.groupBy("up").agg(F.min("fp").alias("a"))
    pairs = placed.join(firsts, "up").where("fp <> a").select("a", F.col("fp").alias("b"))
    return _verified(stage(pairs, "copies-alike"), nodes, texts)


def _sized(n: str, m: str):
    return 5 * F.least(n, m) >= 4 * F.greatest(n, m)


def _enough(n: str, m: str, c: str):
    """Whether sets with c shingles in both prefixes can be at 0.8.

    What else they share lies behind the prefix of the one whose prefix ends first.
    """
    behind = F.expr(f"(4 * greatest({n}, {m}) + 4) div 5 - 1")
    return 9 * (F.col(c) + behind) >= 4 * (F.col(n) + F.col(m))


def _mixed(met: DataFrame) -> DataFrame:
    """The shingles whose nodes are of more than one component, and their number of nodes ``k``."""
    return (
        met.groupBy("shingle")
        .agg(
            F.count(F.lit(1)).cast("double").alias("k"),
            F.min("root").alias("low"),
            F.max("root").alias("high"),
        )
        .where("low <> high")
        .select("shingle", "k")
    )


def _rooted(met: DataFrame, members: DataFrame) -> DataFrame:
    """``met`` with the roots that its nodes have in ``members``, staged; drops ``met``."""
    tops = members.select(F.col("node").alias("fp"), F.col("root").alias("top"))
    placed = met.select("shingle", "fp", "n").join(tops, "fp", "left")
    now = stage(
        placed.select("shingle", "fp", "n", F.coalesce("top", "fp").alias("root")), "copies-met"
    )
    drop_staged(met)
    return now


def links(met: DataFrame, nodes: DataFrame, texts: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` and further links (a, b) whose components are those of all pairs of nodes at 0.8 or more.

    ``met``: (shingle, fp, n, root), the nodes, their sizes and their roots by ``found``, by the
    shingles of their prefixes; a staged table, which is dropped.
    """
    rows = _mixed(met).agg(F.sum("k")).first()[0]
    if not rows:
        drop_staged(met)
        return found
    # Where few nodes share a shingle, their pairs are fewer than PAIRS for each of them.
    crowd, led = met, _mixed(met).where(F.col("k") > 2 * PAIRS + 1)
    for turn in range(ROUNDS):
        pairs = led.agg(F.sum(F.expr("k * (k - 1) / 2"))).first()[0]
        if not pairs or pairs <= PAIRS * rows:
            break
        order = F.struct(F.xxhash64("fp", F.lit(turn)).alias("at"), "fp", "n", "root")
        heads = crowd.join(led.select("shingle"), "shingle", "left_semi")
        heads = heads.groupBy("shingle").agg(F.min(order).alias("head"))
        others = stage(crowd.join(heads, "shingle").where("fp <> head.fp"), "copies-led")
        both = others.where("root <> head.root").select(
            F.col("fp").alias("a"), "n", F.col("head.fp").alias("b"), F.col("head.n").alias("m")
        )
        both = stage(both.where(_sized("n", "m")).select("a", "b").distinct(), "copies-pairs")
        found = found.union(_verified(both, nodes, texts))
        drop_staged(both)
        if turn:
            drop_staged(crowd)
        # A leader has been compared with all others of its shingle.
        members = connected(found)
        crowd = _rooted(others, members)
        led = _mixed(crowd)
    if crowd is not met:
        drop_staged(crowd)
        met = _rooted(met, members)
    # All nodes of different components that share a shingle are there, leaders too, so that c counts
    # all that a pair shares in both prefixes.
    left = stage(met.join(_mixed(met).select("shingle"), "shingle", "left_semi"), "copies-met")
    drop_staged(met)
    side = left.select("shingle", F.col("fp").alias("b"), F.col("n").alias("m"), F.col("root").alias("up"))
    both = left.withColumnRenamed("fp", "a").join(side, "shingle").where("a < b and root <> up")
    both = both.where(_sized("n", "m")).groupBy("a", "b", "n", "m").agg(F.count(F.lit(1)).alias("c"))
    both = stage(both.where(_enough("n", "m", "c")).select("a", "b"), "copies-pairs")
    drop_staged(left)
    found = found.union(_verified(both, nodes, texts))
    drop_staged(both)
    return found


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    narrow = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    texts = narrow.select("text")
    order = _frequent(texts)
    rows, nodes, met = _placed(narrow, order)
    known = by_fingerprint(nodes, texts)
    joined = connected(known)
    met, before = _rooted(met, joined), None
    for _ in range(REFINES):
        total, pairs, most = _mixed(met).agg(
            F.sum("k"), F.sum(F.expr("k * (k - 1) / 2")), F.max("k")
        ).first()
        if not total or (pairs <= PAIRS * total and most <= HOT):
            break
        if before and pairs > before / 2:  # near copies of each other, of which all shingles are frequent
            break
        before, had = pairs, len(order[0])
        order = _looked_again(order, met, nodes, texts, most > HOT)
        if len(order[0]) == had:
            break
        for table in (rows, nodes, met):
            drop_staged(table)
        rows, nodes, met = _placed(narrow, order)
        met = _rooted(met, joined)
    members = connected(links(met, nodes, texts, known))
    found = label_rows(rows, nodes, members)
    drop_staged(nodes)
    return found


def _looked_again(
    order: tuple[np.ndarray, np.ndarray],
    met: DataFrame,
    nodes: DataFrame,
    texts: DataFrame,
    hot: bool,
) -> tuple[np.ndarray, np.ndarray]:
    """``order`` and the shingles by which many nodes meet; if ``hot``, all frequent ones of such texts."""
    met_by = _mixed(met)
    many = (
        met_by.where(F.col("k") > max(2 * PAIRS, 2))
        .orderBy(F.desc("k"), "shingle")
        .limit(FREQUENT)
        .toArrow()
    )
    often, counts = (many.column(c).to_numpy() for c in ("shingle", "k"))
    order = _merged(order, (often, counts))
    if not hot:
        return order
    crowd = met.join(met_by.where(F.col("k") > HOT), "shingle", "left_semi").select("fp").distinct()
    some = crowd.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE)
    wanted = nodes.join(some, "fp").select("t")  # at most SAMPLE rows
    again = texts.where(F.col("text").isNotNull()).withColumn("t", F.xxhash64("text"))
    return _merged(order, _frequent(again.join(F.broadcast(wanted), "t").select("text")))


def _merged(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Two lists of frequent shingles as one, with their counts added up."""
    often, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return often, np.bincount(at, np.concatenate([a[1], b[1]]), len(often)).astype(np.int64)


def _placed(
    narrow: DataFrame, order: tuple[np.ndarray, np.ndarray]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (id, t, fp), nodes (fp, least, t, sim), and nodes by the shingles of their prefixes."""
    index = narrow.sparkSession.sparkContext.broadcast(order)

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = index.value
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                both = [fingerprint_and_set(t) for t in part.column("text").to_pylist()]
                sets = [b[0] for b in both]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("t"),
                        pa.array([set_hash(s) for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        _lists([prefix(s, often, counts) for s in sets]),
                        pa.array([b[1] for b in both], pa.int64()),
                    ],
                    names=["id", "t", "fp", "n", "first", "sim"],
                )

    kind = narrow.schema["id"].dataType.simpleString()
    whole = stage(
        narrow.withColumn("t", F.xxhash64("text")).mapInArrow(
            shingled, f"id {kind}, t bigint, fp bigint, n int, first array<bigint>, sim bigint"
        ),
        "copies",
    )
    nodes = stage(
        whole.groupBy("fp").agg(
            F.min("id").alias("least"), F.min("t").alias("t"), F.min("sim").alias("sim")
        ),
        "copies-nodes",
    )
    places = (
        whole.groupBy("fp")
        .agg(F.first("n").alias("n"), F.first("first").alias("first"))
        .select(F.explode("first").alias("shingle"), "fp", "n")
    )

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows whose shingle the row before or after has too."""
        held, known = None, False  # the last row waits; whether the row before it is like it
        for batch in batches:
            if not len(batch):
                continue
            batch = batch if held is None else pa.concat_batches([held, batch])
            key = batch.column("shingle").to_numpy()
            same = key[1:] == key[:-1]
            before = np.r_[known, same]
            yield batch.slice(0, len(same)).filter(pa.array(before[:-1] | same))
            held, known = batch.slice(len(same)), bool(before[-1])
        if held is not None and known:
            yield held

    met = stage(
        places.repartition("shingle")
        .sortWithinPartitions("shingle")
        .mapInArrow(shared, "shingle bigint, fp bigint, n int"),
        "copies-met",
    )
    rows = stage(whole.select("id", "t", "fp"), "copies-rows")
    drop_staged(whole)
    return rows, nodes, met


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``component_id`` (smallest id reachable)."""
    with shuffles_freed(docs.sparkSession):
        found = _classes(docs, id_col, text_col)
    return found.select(F.col("id").alias(id_col), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component, chosen as in ``drop_near_duplicates``."""
    with shuffles_freed(docs.sparkSession):
        found = _classes(docs, id_col, text_col)
    return keep_first(docs, found, id_col, text_col)
