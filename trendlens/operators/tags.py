"""Tag generators and tag aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import normalize_tag, split_on
from .topk import top_k


def explode_tags(df: DataFrame, col: str = "tags", sep_regex: str = r"\|",
                 out: str = "tag", keep: list[str] | None = None) -> DataFrame:
    """G1: one row per tag.  NULL tags give no row, '' gives one '' row."""
    return df.select(*(keep or []), F.explode(split_on(col, sep_regex)).alias(out))


def tag_counts(df: DataFrame, col: str = "tags", sep_regex: str = r"\|",
               trim: bool = True, lower: bool = True, drop_blank: bool = False,
               keys: list[str] | None = None) -> DataFrame:
    """Count per normalized tag (optionally per extra keys such as region).

    The explode and normalize are map-side; the aggregate is partial on each
    task before the shuffle, so a hot tag costs one row per task.
    """
    keys = keys or []
    t = explode_tags(df, col, sep_regex, keep=keys)
    t = t.select(*keys, normalize_tag("tag", trim=trim, lower=lower).alias("tag"))
    if drop_blank:
        t = t.where(F.col("tag") != "")
    return t.groupBy(*keys, "tag").agg(F.count(F.lit(1)).alias("count"))


def distinct_tags(df: DataFrame, col: str = "tags", sep_regex: str = r"\|",
                  trim: bool = False, lower: bool = True) -> DataFrame:
    """A3: number of distinct normalized tags (exact)."""
    t = explode_tags(df, col, sep_regex)
    return (t.select(normalize_tag("tag", trim=trim, lower=lower).alias("tag"))
            .agg(F.count_distinct("tag").alias("distinct_tags")))


def top_tags(df: DataFrame, k: int = 40, col: str = "tags", sep_regex: str = r"\|",
             trim: bool = True, lower: bool = True) -> DataFrame:
    """The k most common tags after trim(lower(tag)), ties by tag."""
    return top_k(tag_counts(df, col, sep_regex, trim, lower), ["tag"], k)
