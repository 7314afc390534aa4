"""From raw documents to training tokens: five stages over the ``llm`` operators.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that the
stage before it kept; its result is written as Parquet in the shared folder and
read back as the next one's ``docs``. All but the last return the columns of
``documents``, with ``n_chars`` brought up to date where texts change. Null and
empty texts, repeated rows, empty tables and extra columns are handled as the
operators' own descriptions say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm import bpe, line_dedup, mixing, near_copies, quality
from waybill.llm.words import quoted
from waybill.sources.staging import stage


BATCH_BYTES = 8 << 20  # of rows that travel to Python at once
_USED = ("doc_id", "text", "source")  # columns that the operators read


def _packed(docs: DataFrame) -> DataFrame:
    """The used columns, and all others in one struct, out of the way of the operators' names."""
    rest = [quoted(c) for c in docs.columns if c not in _USED]
    return docs.select(
        *[c for c in docs.columns if c in _USED],
        F.struct(*(rest or [F.lit(1).alias("none")])).alias("corpus_rest"),
    )


def _like(result: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return result.select(
        *[
            F.col(c) if c in _USED else F.col("corpus_rest").getField(c).alias(c)
            for c in docs.columns
        ]
    )


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rule or the classifier go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _like(quality.judge(_packed(docs), model).where("kept"), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines found in ten documents or more go from all texts."""
    cleaned = _like(line_dedup.drop_common_lines(_packed(docs)), docs)
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.length("text").cast(kind))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-dedup: one document of each group at Jaccard 0.8 of five-word shingles stays."""
    return _like(near_copies.drop_near_copies(_packed(docs)), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a row for each time that the mix takes a document, in training order."""
    return _like(mixing.in_training_order(mixing.mix(_packed(docs))), docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: ids of every text, and the SHA-256 of the text decoded from them."""
    coded = bpe.encode(
        docs.select("doc_id", "source", "text"), digest_col="decoded_sha256"
    )
    n = F.size("ids").cast("bigint").alias("n_tokens")
    return coded.select("doc_id", "source", "ids", n, "decoded_sha256")


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_copies),
    ("mixing", mix_sources),
    ("bpe", to_tokens),
]

# Fingerprints, a trained classifier and BPE are beyond SQL: tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read back."""
    # Batches of texts to Python stay small: workers and the JVM hold several side by side.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
