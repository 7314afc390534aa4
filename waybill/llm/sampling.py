"""Bounded samples that come out the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_sample(df: DataFrame, key: Column, n: int, total: int) -> DataFrame:
    """The ``n`` rows of ``df`` with the smallest hashes of ``key``, out of ``total``.

    A threshold on the hash first leaves about twice as many rows in the whole
    table, so that no task sends more than its share of them to be ranked.
    """
    share = min(1.0, (2.0 * n + 100.0) / max(total, 1))
    low = -(1 << 63)
    hashed = F.xxhash64(key)
    part = df if share == 1.0 else df.where(hashed < F.lit(low + int(share * (1 << 64))))
    return part.orderBy(hashed, key).limit(n)
