"""Audit of how far the sources of a language differ in the words that they use.

Every language keeps the terms found in at least ``min_docs`` of its documents.
A source's share of a term is smoothed to a whole number of billionths, p; two
sources differ by the sum of ``(p - q)² div (p + q)`` over all kept terms, and a
source's telling terms are those with the largest such value against its
language. All arithmetic is in whole numbers, so results do not depend on order.

**Counting.** Texts are cut at bytes: all separators are ASCII, so one byte
translation and a split give the terms. A task adds its documents up by
(language, source, term) and sends partial sums, at most ``FLUSH`` at a time, so
a word of every document is one row per task. One shuffle by (language, term)
then serves the sums by source, the count of documents, and the list of a term's
counts.

**Pairs by run-length columns.** The counts of a term by source are its vector.
Equal vectors are put together and counted, and the vocabulary is range-sorted by
vector, the smallest sources first: those have the fewest different counts, so
equal counts lie side by side. Sorted stretches are cut into blocks of at most
``ENTRIES`` counts; in a block each source is a column of runs of equal counts,
zeros included. For a pair, the run boundaries of both columns are put together,
and each piece between two of them adds f times its length. Columns meet in tiles
of ``TILE`` by ``TILE`` sources, so that no task holds all sources of a language;
the sums of the blocks are added up by Spark.

Special cases: null text, language and source are empty strings. A source without
kept terms, or without terms, takes part with count 0 everywhere. A language
without kept terms has value 0 for all pairs. A language with one source has no
pairs. Ties in value are ordered by item, by UTF-8 bytes. Repeated rows are
documents of their own. An empty table gives no rows. Whole texts are read,
long ones piece by piece; the distinct terms of one document are held by its
task. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage
from .words import quoted

MIN_DOCS = 10  # documents of its language that a kept term is found in
TOP = 10  # telling terms of a source
UNIT = 1_000_000_000  # shares are whole numbers of this
FLUSH = 300_000  # partial sums that a task holds before it sends them
PIECE = 4 << 20  # bytes of a text that are split at a time
ENTRIES = 1 << 20  # counts in a block of the vocabulary
TILE = 32  # sources along a side of a tile

# Bytes of terms: ASCII letters, lower-cased, and all of other characters. The rest is a blank.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a piece of it at a time."""
    plain = text.translate(_TERM_BYTES)
    at = 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE) if len(plain) - at > PIECE else -1
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by (lang, source, term); a row without a term says that the group occurs."""
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in found.items():
            size = len(n) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()),
                    pa.array([source] * size, pa.string()),
                    pa.array([None, *n], pa.binary()).cast(pa.string()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *map(docs.__getitem__, n)], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        found.clear()

    held = 0
    for batch in batches:
        for at in range(0, len(batch), 256):
            for lang, source, text in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                if (sums := found.get((lang, source))) is None:
                    sums = found[lang, source] = (Counter(), Counter())
                n, docs = sums
                before = len(n)
                seen: set[bytes] = set()
                for terms in _terms(text):
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                held += len(n) - before
            if held >= FLUSH:
                yield from flushed()
                held = 0
    yield from flushed()


def vocabulary(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """(lang, term, total, counts): kept terms with their counts by source, staged.

    The row of a language whose term is null lists all its sources.
    """

    def text(name: str) -> Column:
        return F.coalesce(quoted(name).cast("string"), F.lit(""))

    rows = docs.select(
        text(lang_col).alias("lang"),
        text(source_col).alias("source"),
        text(text_col).cast("binary").alias("text"),
    )
    partial = rows.mapInArrow(
        _partial_counts, "lang string, source string, term string, n bigint, docs bigint"
    )
    return stage(
        partial.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum("n").alias("total"),
            F.collect_list(F.struct("source", "n")).alias("counts"),
        )
        .where(F.col("term").isNull() | (F.col("docs") >= min_docs))
        .select("lang", "term", "total", "counts"),
        "divergence-terms",
    )


def _groups(terms: DataFrame) -> DataFrame:
    """(lang, source, size, lang_size, v, pos, n_sources): a row per group, staged.

    ``size`` and ``lang_size`` are counts over kept terms, ``v`` is their number in
    the language, and ``pos`` the place of the source, the smallest first.
    """
    kept = terms.groupBy("lang").agg(
        F.count("term").alias("v"), F.coalesce(F.sum("total"), F.lit(0)).alias("lang_size")
    )
    sizes = (
        terms.select("lang", F.inline("counts"))
        .groupBy("lang", "source")
        .agg(F.sum("n").alias("size"))
    )
    in_lang = W.partitionBy("lang")
    return stage(
        sizes.join(kept, "lang").select(
            "lang",
            "source",
            "size",
            "lang_size",
            "v",
            (F.row_number().over(in_lang.orderBy("size", "source")) - 1).alias("pos"),
            F.count(F.lit(1)).over(in_lang).alias("n_sources"),
        ),
        "divergence-groups",
    )


def share(n: str, size: str) -> Column:
    """1 + floor(UNIT * (n + 2) / (size + 2 * v)), exactly."""
    return F.expr(
        f"1 + (cast({UNIT} as decimal(10,0)) * cast({n} + 2 as decimal(20,0)))"
        f" div cast({size} + 2 * v as decimal(20,0))"
    )


def difference(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def telling_terms(terms: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source uses above its language."""
    entries = (
        terms.where(F.col("term").isNotNull())
        .select("lang", F.col("term").alias("item"), "total", F.inline("counts"))
        .where("n > 0")
        .join(groups, ["lang", "source"])
        .withColumn("p", share("n", "size"))
        .withColumn("q", share("total", "lang_size"))
        .where("p > q")
    )
    best = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        entries.select("lang", "source", "item", difference("p", "q").alias("value"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
    )


# --- runs ------------------------------------------------------------------------------------


def _columns_of(
    sizes: np.ndarray, row: np.ndarray, pos: np.ndarray, n: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(pos, ends, counts) of each source that occurs: its runs over the whole block.

    Row ``i`` of the block stands for ``sizes[i]`` terms; entries are (row, pos, n).
    """
    ends = np.cumsum(sizes)
    order = np.lexsort((row, pos))
    row, pos, n = row[order], pos[order], n[order]
    cuts = np.flatnonzero(np.diff(pos)) + 1
    for part in np.split(np.arange(len(pos)), cuts):
        at, count = row[part], n[part]
        stop = ends[at]
        start = stop - sizes[at]
        before = np.concatenate([[0], stop[:-1]])
        # each entry is preceded by a run of zeros, which may be empty
        all_ends = np.column_stack([start, stop]).ravel()
        counts = np.column_stack([np.zeros_like(count), count]).ravel()
        filled = np.column_stack([start > before, np.ones(len(at), bool)]).ravel()
        all_ends, counts = all_ends[filled], counts[filled]
        if all_ends[-1] < ends[-1]:
            all_ends, counts = np.append(all_ends, ends[-1]), np.append(counts, 0)
        last = np.append(counts[1:] != counts[:-1], True)
        yield int(pos[part[0]]), all_ends[last], counts[last]


def _run_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (lang, vector, terms) to (lang, block, pos, length, ends, counts)."""
    part = TaskContext.get().partitionId()
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    lang, entries, block = None, 0, 0

    def closed() -> pa.RecordBatch:
        rows = np.cumsum([0, *(len(h[0]) for h in held)])
        sizes = np.concatenate([h[0] for h in held])
        row = np.concatenate([h[1] + at for h, at in zip(held, rows)])
        pos, n = (np.concatenate([h[i] for h in held]) for i in (2, 3))
        columns = list(_columns_of(sizes, row, pos, n))
        k = len(columns)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * k, pa.string()),
                pa.array([f"{part}-{block}"] * k, pa.string()),
                pa.array([c[0] for c in columns], pa.int32()),
                pa.array([int(sizes.sum())] * k, pa.int64()),
                pa.array([c[1] for c in columns], pa.list_(pa.int64())),
                pa.array([c[2] for c in columns], pa.list_(pa.int64())),
            ],
            names=["lang", "block", "pos", "length", "ends", "counts"],
        )

    for batch in batches:
        langs = batch.column(0).to_pylist()
        vector = batch.column(1)
        offsets = vector.offsets.to_numpy()
        flat = vector.values
        pos = flat.field("pos").to_numpy()
        n = flat.field("n").to_numpy()
        terms = batch.column(2).to_numpy()
        at = 0
        while at < len(langs):
            if held and (langs[at] != lang or entries >= ENTRIES):
                yield closed()
                held, entries, block = [], 0, block + 1
            lang = langs[at]
            end = at + 1
            room = offsets[at] + ENTRIES - entries
            while end < len(langs) and langs[end] == lang and offsets[end] < room:
                end += 1
            low, high = offsets[at], offsets[end]
            row = np.repeat(np.arange(end - at), np.diff(offsets[at : end + 1]))
            held.append((terms[at:end], row, pos[low:high], n[low:high]))
            entries += int(high - low)
            at = end
    if held:
        yield closed()


def _shares(counts: np.ndarray, size: int, v: int) -> np.ndarray:
    """``share`` of counts; by Python's integers where 64 bits are too few."""
    whole = size + 2 * v
    if not whole:
        return np.ones(len(counts), np.int64)
    if int(counts.max(initial=0)) + 2 > (1 << 62) // UNIT:
        return np.array([1 + UNIT * (int(c) + 2) // whole for c in counts], np.int64)
    return 1 + UNIT * (counts + 2) // whole


def piecewise(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
) -> int:
    """Sum of f over two columns of (run ends, shares): boundaries put together, f times length."""
    ends = np.union1d(a[0], b[0])
    p = a[1][np.searchsorted(a[0], ends)]
    q = b[1][np.searchsorted(b[0], ends)]
    f = (p - q) * (p - q) // (p + q)
    return int((f * np.diff(ends, prepend=0)).sum())


def _tile(table: pa.Table) -> pa.Table:
    """Pairs of one tile: (lang, source, item, value) with the first source before the second."""
    rows = table.to_pylist()
    low, high = rows[0]["low"], rows[0]["high"]
    columns = []
    for r in sorted(rows, key=lambda r: r["pos"]):
        ends = np.array(r["ends"] or [r["length"]], np.int64)
        counts = np.array(r["counts"] or [0], np.int64)
        columns.append((r["pos"] // TILE, r["source"], (ends, _shares(counts, r["size"], r["v"]))))
    pairs = [
        (a[1], b[1], piecewise(a[2], b[2]))
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
        if (a[0], b[0]) == (low, high)
    ]
    return pa.Table.from_arrays(
        [
            pa.array([rows[0]["lang"]] * len(pairs), pa.string()),
            pa.array([p[0] for p in pairs], pa.string()),
            pa.array([p[1] for p in pairs], pa.string()),
            pa.array([p[2] for p in pairs], pa.int64()),
        ],
        names=["lang", "source", "item", "value"],
    )


def run_columns(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, block, pos, length, ends, counts) of the reordered vocabulary, staged."""
    vectors = (
        terms.where(F.col("term").isNotNull())
        .select("lang", "term", F.inline("counts"))
        .where("n > 0")
        .join(groups.select("lang", "source", "pos"), ["lang", "source"])
        .groupBy("lang", "term")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "n"))).alias("vector"))
        .groupBy("lang", "vector")
        .agg(F.count(F.lit(1)).alias("terms"))
    )
    return stage(
        vectors.repartitionByRange("lang", "vector")
        .sortWithinPartitions("lang", "vector")
        .mapInArrow(
            _run_columns,
            "lang string, block string, pos int, length bigint, "
            "ends array<bigint>, counts array<bigint>",
        ),
        "divergence-runs",
    )


def source_pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank) for every source and every other of its language."""
    runs = run_columns(terms, groups)
    # A language without kept terms has one empty block, so that its pairs are there.
    empty = groups.where("v = 0").select(
        "lang", F.lit("").alias("block"), F.lit(0).cast("bigint").alias("length")
    )
    blocks = runs.select("lang", "block", "length").union(empty).distinct()
    tiles = F.ceil(F.col("n_sources") / TILE).cast("int")
    own = F.floor(F.col("pos") / TILE).cast("int")
    columns = (
        blocks.join(groups, "lang")
        .join(runs.drop("length"), ["lang", "block", "pos"], "left")
        .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
        .withColumn("low", F.least(own, "other"))
        .withColumn("high", F.greatest(own, "other"))
        .select(
            "lang", "block", "low", "high", "pos", "source", "size", "v", "length", "ends", "counts"
        )
    )
    half = (
        columns.groupBy("lang", "block", "low", "high")
        .applyInArrow(_tile, "lang string, source string, item string, value bigint")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    both = F.array(
        F.struct("source", "item"),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item")),
    )
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return half.select("lang", "value", F.inline(both)).select(
        "lang", "source", "item", "value", F.row_number().over(order).alias("rank")
    )


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and telling terms."""
    terms = vocabulary(docs, text_col, lang_col, source_col, min_docs)
    groups = _groups(terms)

    def part(name: str, rows: DataFrame) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")

    return part("pair", source_pairs(terms, groups)).union(
        part("term", telling_terms(terms, groups, top))
    )
