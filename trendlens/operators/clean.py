"""Filters and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import as_string


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_records(df: DataFrame, count_col="view_count",
                  disabled="comments_disabled") -> DataFrame:
    """Drop rows with a zero count or with the feature disabled.

    ``disabled`` is a boolean column (or expression).  Rows where it is FALSE
    are kept; TRUE and NULL are dropped (a typed read, not a string compare).
    Both predicates are simple comparisons, so they reach the Parquet scan.
    """
    return df.where((_c(count_col) != 0) & (_c(disabled) == F.lit(False)))


def cleaning_report(df: DataFrame, count_col="view_count",
                    disabled="comments_disabled") -> DataFrame:
    """Zero-count rows, total rows and rows kept, in one pass."""
    keep = (_c(count_col) != 0) & (_c(disabled) == F.lit(False))
    return df.agg(
        F.count_if(_c(count_col) == 0).alias("zero_rows"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(keep).alias("kept_rows"),
    )


def having_count_gt(grouped: DataFrame, n: int, count_col: str = "count") -> DataFrame:
    """Keep groups whose count exceeds n."""
    return grouped.where(F.col(count_col) > n)


def at_most_percentile(df: DataFrame, col: str, threshold: Column) -> DataFrame:
    """Rows whose value is at most a (scalar-subquery) threshold."""
    return df.where(F.col(col) <= threshold)


def select_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """P5: the numeric columns used for statistics (pruned at the scan)."""
    return df.select(*cols)


def rename_target(df: DataFrame, target: str, label: str = "label") -> DataFrame:
    """The target becomes ``label``; the source column is kept."""
    return df.withColumn(label, F.col(target).cast("double"))


def as_categorical(df: DataFrame, cols: list[str], suffix: str = "_str") -> DataFrame:
    """Numeric -> string copies used as categorical features."""
    return df.withColumns({c + suffix: as_string(c) for c in cols})
