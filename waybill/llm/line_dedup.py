"""Line dedup: lines found in many documents are dropped from all of them.

Lines are exploded with their position and hashed; the distinct documents of
each hash are counted (partial counts before the shuffle, so a line that a
third of the documents share is one row per task); the positions of lines over
the threshold are gathered per document, and each text is put together again
from the positions that remain.

Only hashes and positions are shuffled for the count; the texts are shuffled
once, to meet the positions they lose. A line's key is held as 128 bits.

Special cases: a null or empty text is one empty line and comes back as the
empty text. A repeated row (same id and text) is one document to the count, and
every such row comes back, cleaned alike. Rows that share an id count as one
document, rows without an id too. Columns other than id and text
are handed through; columns called like the two counts are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .words import WHITE, free_name, lower_ascii, quoted


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _hashes(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def line_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line with a key: ``doc`` (id, hash and length of the text), ``pos``, ``h``."""
    text = F.coalesce(quoted(text_col), F.lit(""))
    doc = F.struct(
        quoted(id_col).alias("id"), F.xxhash64(text).alias("t"), F.length(text).alias("n")
    )
    return (
        docs.select(doc.alias("doc"), F.posexplode(_lines(text)).alias("pos", "line"))
        .select("doc", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= 1)
        .select("doc", "pos", _hashes(F.col("key")).alias("h"))
    )


def common_lines(positions: DataFrame, min_docs: int = 10) -> DataFrame:
    """Hashes of the lines found in at least ``min_docs`` distinct documents."""
    return (
        positions.groupBy("h", "doc.id")
        .agg(F.lit(1).alias("one"))
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )


def drop_common_lines(
    docs: DataFrame,
    min_docs: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    counts: tuple[str, str] = ("n_lines", "n_dropped"),
) -> DataFrame:
    """``docs`` with cleaned texts and, after them, the numbers of lines and of dropped lines."""
    positions = stage(line_positions(docs, id_col, text_col), "line-positions")
    # Staged, so that the join can broadcast a small table or split the rows of a hot line.
    common = stage(
        common_lines(positions, min_docs).select(F.col("h").alias("common")), "common-lines"
    )
    gone = (
        positions.join(common, F.col("h") == F.col("common"), "left_semi")
        .groupBy("doc")
        .agg(F.collect_set("pos").alias("gone"))
        .select(F.col("doc").alias("gone_doc"), "gone")
    )
    side = free_name(docs.columns, "lines_gone")
    key = free_name(docs.columns, "lines_doc")
    gone = gone.select(F.col("gone_doc").alias(key), F.col("gone").alias(side))
    text = F.coalesce(quoted(text_col), F.lit(""))
    same = (
        quoted(id_col).eqNullSafe(F.col(f"{key}.id"))
        & (F.xxhash64(text) == F.col(f"{key}.t"))
        & (F.length(text) == F.col(f"{key}.n"))
    )
    lines = _lines(text)
    # array_except keeps the order and looks positions up in a hash set.
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(side))
    cleaned = F.when(F.col(side).isNull(), text).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    )
    joined = docs.join(gone, same, "left")
    return joined.select(
        *[
            cleaned.alias(c) if c == text_col else quoted(c)
            for c in docs.columns
            if c.lower() not in counts
        ],
        F.size(lines).cast("bigint").alias(counts[0]),
        F.coalesce(F.size(F.col(side)), F.lit(0)).cast("bigint").alias(counts[1]),
    )
