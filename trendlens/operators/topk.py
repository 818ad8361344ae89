"""Ordering and top-k (O1-O3).  Always a total order: count desc, then key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_by_count_desc(df: DataFrame, keys: list[str], count_col: str = "count") -> DataFrame:
    """O1: ranking order with a key tie-break."""
    return df.orderBy(F.col(count_col).desc(), *[F.col(k).asc_nulls_last() for k in keys])


def order_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """O2: ascending report order."""
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in keys])


def top_k(df: DataFrame, keys: list[str], k: int, count_col: str = "count") -> DataFrame:
    """O3: first k by count desc; planned as TakeOrderedAndProject (per-task
    heaps of k rows, then one merge of k * tasks rows)."""
    return order_by_count_desc(df, keys, count_col).limit(k)
