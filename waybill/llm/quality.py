"""Quality rules: counts on whole texts, and a classifier on hashed n-grams.

A logistic regression on hashed words, word pairs and character n-grams learns
from labelled documents; its probability is calibrated on rows that it was not
fitted on (Platt scaling) and compared with a fixed threshold. Texts are scored
in Arrow batches, one document at a time, in memory that follows the longest
text of a batch and not the table.

The fit uses at most ``max_rows`` labelled documents of each class (the smallest
hashes of the ids, so a rerun takes the same ones); that bound is a parameter.
Counts, scores and verdicts cover every row and every whole text.

Special cases: a null or empty text has no words and fails the base rule.
Labels are joined by id; contradicting labels of an id count as the lower one,
null labels not at all, labels without a document not at all. With fewer than
``MIN_CLASS`` labelled documents of either class there is no classifier, and
what passes the base rule is kept. Repeated rows are judged alike. Extra columns
are handed through; columns called like an added one are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import hash_sample
from .words import free_name, quoted

DIMENSIONS = 1 << 16
SPARSE = 4096  # n-grams; shorter texts are scored without an array of all dimensions
CHARACTERS = (2, 3, 4)  # lengths of the character n-grams, in bytes of UTF-8
MAX_ROWS = 1000  # labelled documents of each class that are fitted, at most
MIN_CLASS = 5
THRESHOLD = 0.5  # of the calibrated probability that a document is good
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in repeated windows

_SYMBOLS = regex.compile(r"[#*$%&|<>]")
_ADDED = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "base_failed", "probability", "kept",
]


# --- counts ----------------------------------------------------------------------------------


def repeated_words(words: list, window: int = 3) -> int:
    """Words that lie in a window of ``window`` words that the text holds twice or more."""
    n = len(words)
    if n <= window:
        return 0
    numbers: dict = {}
    ids = np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], np.int64, n)
    key = ids[: n - window + 1]
    for shift in range(1, window):
        # numbers of the longer windows, renumbered so that they always fit
        joined = key * len(numbers) + ids[shift : n - window + 1 + shift]
        key = np.unique(joined, return_inverse=True)[1] if shift < window - 1 else joined
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[inverse] > 1
    covered = np.zeros(n, bool)
    for shift in range(window):
        covered[shift : n - window + 1 + shift] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


# --- features --------------------------------------------------------------------------------


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread 32-bit numbers over the buckets."""
    return ((h * np.uint32(2654435769)) >> np.uint32(16)).astype(np.int64) & (DIMENSIONS - 1)


def ngram_buckets(raw: bytes, words: list[bytes]) -> Iterator[np.ndarray]:
    """Buckets of each family of n-grams of a text, repeats included."""
    if words:
        w = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        yield _mix(w)
        if len(w) > 1:
            yield _mix(w[:-1] * np.uint32(31) + w[1:] + np.uint32(7))
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    for n in CHARACTERS:
        if len(b) >= n:
            h = np.full(len(b) - n + 1, n, np.uint32)
            for i in range(n):
                h = h * np.uint32(16777619) + b[i : len(b) - n + 1 + i]
            yield _mix(h)


def features(raw: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their values: every family weighs 1, whatever the text's length."""
    total = np.zeros(DIMENSIONS)
    for buckets in ngram_buckets(raw, words):
        total += np.bincount(buckets, minlength=DIMENSIONS) / len(buckets)
    at = np.flatnonzero(total)
    return at, np.sqrt(total[at])


def _scored(raw: bytes, words: list[bytes], weights: np.ndarray) -> float:
    families = list(ngram_buckets(raw, words))
    if not families:
        return 0.0
    # One count over all families, each n-gram weighing as much as its family allows.
    shares = np.repeat([1.0 / len(f) for f in families], [len(f) for f in families])
    at = np.concatenate(families)
    if len(at) < SPARSE:
        at, places = np.unique(at, return_inverse=True)
        return float(np.sqrt(np.bincount(places, weights=shares)) @ weights[at])
    total = np.bincount(at, weights=shares, minlength=DIMENSIONS)
    return float(np.sqrt(total, out=total) @ weights)


# --- model -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """p(good) = sigmoid(slope * (weights . x + bias) + shift)."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, margin):
        z = self.slope * (margin + self.bias) + self.shift
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _fit(
    row: np.ndarray, at: np.ndarray, value: np.ndarray, y: np.ndarray, rounds: int = 200
) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression, classes weighed equally, by accelerated descent.

    ``row``, ``at`` and ``value`` are the places and values of the sparse feature matrix.
    """
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    most = max(float(np.bincount(row, weights=value**2).max()), 1e-9)
    step = 4.0 / (most + 1.0)
    penalty = 1e-5
    w, b = np.zeros(DIMENSIONS), 0.0
    ahead_w, ahead_b, t = w, b, 1.0
    for _ in range(rounds):
        margin = np.bincount(row, weights=value * ahead_w[at], minlength=len(y)) + ahead_b
        error = share * (1.0 / (1.0 + np.exp(-np.clip(margin, -500, 500))) - y)
        slope = np.bincount(at, weights=value * error[row], minlength=DIMENSIONS)
        next_w = ahead_w - step * (slope + penalty * ahead_w)
        next_b = ahead_b - step * error.sum()
        next_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead_w = next_w + (t - 1) / next_t * (next_w - w)
        ahead_b = next_b + (t - 1) / next_t * (next_b - b)
        w, b, t = next_w, next_b, next_t
    return w, float(b)


def _calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling with his smoothed targets, by Newton's method; the slope stays positive."""
    good, bad = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    theta = np.array([1.0, 0.0])
    design = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ theta, -500, 500)))
        gradient = design.T @ (p - target) + 1e-6 * theta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, gradient)
        theta = theta - move / max(1.0, float(np.abs(move).max()))
        if np.abs(move).max() < 1e-9:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str, label_col: str,
    label_id_col: str = "doc_id",
) -> DataFrame:
    """(id, y, text) of at most ``max_rows`` labelled documents of each class."""
    ids = docs.select(quoted(id_col).alias("id")).where("id is not null").distinct()
    known = (
        labels.select(quoted(label_id_col).alias("id"), quoted(label_col).alias("y"))
        .where("id is not null and y is not null")
        .groupBy("id")
        .agg(F.min("y").alias("y"))
        .join(ids, "id", "left_semi")
    )
    sizes = {r.y: r["count"] for r in known.where("y in (0, 1)").groupBy("y").count().collect()}
    good, bad = (
        hash_sample(known.where(F.col("y") == y), F.col("id"), max_rows, sizes.get(y, 0))
        for y in (1, 0)
    )
    chosen = good.union(bad)
    # At most 2 * max_rows rows of two numbers: small enough to broadcast by construction.
    texts = docs.select(
        quoted(id_col).alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text")
    )
    return texts.join(F.broadcast(chosen), "id").groupBy("id").agg(
        F.min("y").alias("y"), F.min("text").alias("text")
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = MAX_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    label_id_col: str = "doc_id",
) -> Model | None:
    """Fit on four fifths of the sample, calibrate on the rest; None without enough labels."""

    @F.pandas_udf("struct<at: array<int>, value: array<float>>")
    def vectors(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = [features(raw := t.encode("utf-8"), raw.split()) for t in batch]
            yield pd.DataFrame({"at": [a for a, _ in rows], "value": [v for _, v in rows]})

    sample = labelled_sample(
        docs, labels, max_rows, id_col, text_col, label_col, label_id_col
    )
    # At most 2 * max_rows rows, as Arrow arrays; only the fit holds them.
    table = sample.select("id", "y", vectors("text").alias("x")).toArrow().combine_chunks()
    y = table.column("y").to_numpy().astype(np.float64)
    if min((y == 0).sum(), (y == 1).sum()) < MIN_CLASS:
        return None
    x = table.column("x").chunk(0)
    sizes = pc.list_value_length(x.field("at")).to_numpy()
    at = x.field("at").flatten().to_numpy()
    value = x.field("value").flatten().to_numpy()
    # Rows in the order of ids, so that a rerun adds up in the same order.
    order = np.argsort(table.column("id").to_numpy(), kind="stable")
    start = np.cumsum(sizes) - sizes
    place = np.concatenate([np.arange(start[i], start[i] + sizes[i], dtype=np.int32) for i in order])
    y, sizes, at, value = y[order], sizes[order], at[place], value[place]
    row = np.repeat(np.arange(len(y), dtype=np.int32), sizes)
    held = np.zeros(len(y), bool)
    for k in (0, 1):  # every fifth row of each class
        held[np.flatnonzero(y == k)[::5]] = True
    number = np.cumsum(~held) - 1
    fitted = ~held[row]
    weights, bias = _fit(
        number[row[fitted]].astype(np.int32), at[fitted], value[fitted], y[~held]
    )
    margin = np.bincount(row, weights=value * weights[at], minlength=len(y))[held] + bias
    slope, shift = _calibrate(margin, y[held])
    return Model(weights, bias, slope, shift)


def judge(
    docs: DataFrame,
    model: Model | None,
    text_col: str = "text",
    threshold: float = THRESHOLD,
    min_words: int = MIN_WORDS,
    max_repeated: int = MAX_REPEATED,
) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``probability`` (null without model), ``kept``."""
    # 2^16 weights and three numbers
    parts = model and (model.weights, model.bias, model.slope, model.shift)
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    schema = (
        "struct<n_words: bigint, word_chars: bigint, n_symbols: bigint, n_dup_lines: bigint, "
        "n_repeat_words: bigint, probability: double>"
    )

    @F.pandas_udf(schema)
    def counts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fitted = shared.value and Model(*shared.value)
        for batch in texts:
            rows = []
            for t in batch:
                text = t or ""
                raw = text.encode("utf-8")
                words = raw.split()
                chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
                p = None
                if fitted is not None:
                    p = float(fitted.probability(_scored(raw, words, fitted.weights)))
                rows.append(
                    (
                        len(words),
                        chars,
                        len(_SYMBOLS.findall(text)),
                        duplicate_lines(text),
                        repeated_words(words),
                        p,
                    )
                )
            yield pd.DataFrame(rows, columns=[*_ADDED[:5], "probability"])

    out = free_name(docs.columns, "quality_counts")
    found = docs.withColumn(out, counts(quoted(text_col)))
    n, repeated = F.col(out)["n_words"], F.col(out)["n_repeat_words"]
    failed = (n < min_words) | (100 * repeated > max_repeated * n)
    p = F.col(out)["probability"]
    return found.select(
        *[quoted(c) for c in docs.columns if c.lower() not in _ADDED],
        *[F.col(out)[c].alias(c) for c in _ADDED[:5]],
        failed.alias("base_failed"),
        p.alias("probability"),
        (~failed & F.coalesce(p >= threshold, F.lit(True))).alias("kept"),
    )
