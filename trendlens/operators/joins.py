"""Dimension joins.

No side is forced to be broadcast: the planner broadcasts a side under
``spark.sql.autoBroadcastJoinThreshold`` and adaptive execution one whose real
shuffle size is under it; beyond that the join is shuffled, with skewed
partitions split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_category(df: DataFrame, dim: DataFrame, key: str | list[str] = "categoryId") -> DataFrame:
    """Left equi-join; facts without a dimension row keep NULL attributes."""
    return df.join(dim, on=key, how="left")


def lookup_category_id(requests: DataFrame, dim: DataFrame,
                       name_col: str = "category_name",
                       keys: tuple[str, ...] = ("region",),
                       order_col: str | None = None) -> DataFrame:
    """Request category name -> id, one row out per request.

    Of several ids with one title the last in ``order_col`` wins (S4), the
    greatest id when the dimension carries no order.  Unknown names get NULL and
    a reason.
    """
    last = F.max_by("categoryId", order_col) if order_col else F.max("categoryId")
    d = dim.groupBy(*keys, F.col("categoryTitle").alias(name_col)).agg(last.alias("categoryId"))
    out = requests.join(d, on=[*keys, name_col], how="left")
    return out.withColumn(
        "error", F.when(F.col("categoryId").isNull(),
                        F.concat(F.lit("unknown category "), F.coalesce(F.col(name_col), F.lit("NULL")))))


# A key is hot if it holds one row in HOT_SHARE or more, so at most HOT_SHARE keys are hot.
HOT_SHARE = 1000


def join_counted(facts: DataFrame, keyed: DataFrame, keys: list[str], n_col: str, rows: int) -> DataFrame:
    """Inner join of ``facts`` with ``keyed`` (one row a key, ``n_col`` = about how many of the
    ``rows`` facts have it).

    Hot keys, ``HOT_SHARE`` at most, are broadcast: their facts are not shuffled.
    The other keys are joined as the planner and adaptive execution choose.
    """
    least = max(2, -(-rows // HOT_SHARE))
    hot = F.broadcast(keyed.where(F.col(n_col) >= least))
    rest = facts.join(hot.select(*keys), keys, "left_anti").join(keyed.where(F.col(n_col) < least), keys)
    return facts.join(hot, keys).unionByName(rest)
