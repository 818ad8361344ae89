"""Sampling and splitting.

``sample_fraction`` / ``random_split`` are Spark's Bernoulli samplers: their
rows depend on the partitioning.  The keyed forms hash ``seed:key`` with md5,
so the same key is always on the same side whatever the partitioning, a
``video_id`` never lands in both train and test, and any SQL engine with md5
reproduces the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_fraction(df: DataFrame, fraction: float = 0.10, seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 101) -> list[DataFrame]:
    """Spark's random split."""
    return df.randomSplit(list(weights), seed=seed)


def key_fraction(key, seed: int) -> Column:
    """Uniform [0, 1) number from md5(seed:key): first 8 hex digits / 2^32."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(k.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def sample_by_key(df: DataFrame, key: str, fraction: float = 0.10, seed: int = 42) -> DataFrame:
    """Reproducible sample; a pure filter, so it runs inside the scan stage."""
    return df.where(key_fraction(key, seed) < F.lit(fraction))


def split_by_key(df: DataFrame, key: str, train_fraction: float = 0.7,
                 seed: int = 101) -> tuple[DataFrame, DataFrame]:
    """Group-aware train/test split; the two halves partition the input."""
    u = key_fraction(key, seed)
    return df.where(u < F.lit(train_fraction)), df.where(u >= F.lit(train_fraction))


def split_label(df: DataFrame, key: str, train_fraction: float = 0.7, seed: int = 101,
                out: str = "split") -> DataFrame:
    """X4 as a column: 'train' or 'test' per row."""
    u = key_fraction(key, seed)
    return df.withColumn(out, F.when(u < F.lit(train_fraction), "train").otherwise("test"))
