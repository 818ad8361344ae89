"""Mergeable sketches of regions: distinct values, quantiles, frequent items.

A sketch is a small binary value of one group's rows.  Stored once per region,
sketches answer for single regions, for all together and for what two regions
share, without reading rows again; new rows only need a sketch of their own.
Each kind states its error bound; ``exact_percentiles`` uses quantile sketches
only to find where to look, and is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .rank import cumulative_before


# ------------------------------------------------- distinct values (A2, A3)

LG_ENTRIES = 12


def distinct_bound(lg_entries: int = LG_ENTRIES) -> float:
    """Three standard errors: of an estimate relative to the count, or of a shared count
    relative to the count of both regions together."""
    return 3.0 / math.sqrt(2 ** lg_entries)


def distinct_sketches(df: DataFrame, keys: list[str], col: str, lg_entries: int = LG_ENTRIES) -> DataFrame:
    """``(keys, rows, hll, theta)``: a HyperLogLog and a theta sketch of each group's values.

    NULL values don't count; a group without values has sketches of nothing.
    Types that sketches don't take (doubles, dates, ...) count as their strings.
    """
    value = F.col(col) if dict(df.dtypes)[col] in ("int", "bigint", "string", "binary") else F.col(col).cast("string")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(value, F.lit(lg_entries)).alias("hll"),
                                 F.theta_sketch_agg(value, F.lit(lg_entries)).alias("theta"))


def merge_distinct(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups (``[]``: of everything) from those of finer ones."""
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.hll_union_agg("hll").alias("hll"), F.theta_union_agg("theta").alias("theta"))


def distinct_estimate(sketches: DataFrame) -> DataFrame:
    """``sketches`` with ``estimate`` in place of the sketches."""
    return sketches.select(*[c for c in sketches.columns if c not in ("hll", "theta")], F.hll_sketch_estimate("hll").alias("estimate"))


def shared_estimate(sketches: DataFrame, key: str, a, b) -> DataFrame:
    """One row ``(estimate, both)``: values that occur in groups ``a`` and ``b``, and in either."""
    pair = sketches.where(F.col(key).isin(a, b)).agg(
        F.max_by("theta", F.when(F.col(key) == a, 1)).alias("a"), F.max_by("theta", F.when(F.col(key) == b, 1)).alias("b"))
    return pair.select(F.theta_sketch_estimate(F.theta_intersection("a", "b")).alias("estimate"),
                       F.theta_sketch_estimate(F.theta_union("a", "b")).alias("both"))


# ------------------------------------------------------ quantiles

ENTRIES = 4096


def rank_bound(entries: int = ENTRIES) -> float:
    """Error of a quantile's rank as a share of the rows, at 99 % confidence."""
    return 2.296 / entries ** 0.9021


def _number(col: str) -> Column:
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def quantile_sketches(df: DataFrame, cols: list[str], keys: list[str] = (), entries: int = ENTRIES) -> DataFrame:
    """``(keys, column, n, least, most, kll)``: one pass over the rows for all columns.

    NULL and NaN don't count.
    """
    each = [e.alias(f"{name}{i}") for i, c in enumerate(cols) for name, e in (
        ("n", F.count(_number(c))), ("least", F.min(_number(c))), ("most", F.max(_number(c))),
        ("kll", F.kll_sketch_agg_double(_number(c), entries)))]
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{name}{i}").alias(name) for name in ("n", "least", "most", "kll")]) for i, c in enumerate(cols)]
    return df.groupBy(*keys).agg(*each).select(*keys, F.inline(F.array(*rows)))


def merge_quantiles(sketches: DataFrame, keys: list[str] = ()) -> DataFrame:
    """The sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*keys, "column").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
                                                 F.kll_merge_agg_double("kll").alias("kll"))


def quantile_estimate(sketches: DataFrame, p: float) -> DataFrame:
    """``sketches`` with ``estimate`` of the p-th quantile in place of the sketch."""
    return sketches.select(*[c for c in sketches.columns if c != "kll"],
                           F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("kll", F.lit(float(p)))).alias("estimate"))


def exact_percentiles(df: DataFrame, cols: list[str], p: float, keys: list[str] = (), entries: int = ENTRIES,
                      sketches: DataFrame | None = None, slack: float | None = None) -> DataFrame:
    """``(keys, column, n, percentile)``: linear interpolation between the order statistics at
    floor and ceil of p*(n-1), for all columns and groups together.

    One pass makes the sketches (none if they are given), the second counts what lies below
    each bracket of ``slack`` ranks on either side and groups what lies inside by
    value.  The inside's values are ranked by ``cumulative_before``, so no group
    is sorted in one task.  A bracket that missed (the counts tell) is made anew
    as the group's whole range, in a third pass.
    """
    keys = list(keys)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if sketches is None:
        sketches = quantile_sketches(df, cols, keys, entries)
    slack = 3 * rank_bound(entries) if slack is None else slack
    at = lambda q: F.kll_sketch_get_quantile_double("kll", F.lit(min(1.0, max(0.0, q))))
    few = F.col("n") * slack < 2   # the ranks of so few rows are farther apart than the bracket
    brackets = sketches.where("n > 0").select(
        *keys, "column", "n", "least", "most", F.when(few, F.col("least")).otherwise(at(p - slack)).alias("low"),
        F.when(few, F.col("most")).otherwise(at(p + slack)).alias("high")).checkpoint()
    found = _ranked(df, cols, p, keys, brackets).checkpoint()
    if found.where("v_first is null or v_last is null").isEmpty():
        return _between(found, p, keys)
    missed = found.where("v_first is null or v_last is null").select(*keys, "column")
    again = _matched(brackets, missed, [*keys, "column"], "left_semi") \
        .withColumn("low", F.col("least")).withColumn("high", F.col("most"))
    return _between(found.where("v_first is not null and v_last is not null").unionByName(_ranked(df, cols, p, keys, again)), p, keys)


def _matched(a: DataFrame, b: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on equal names, NULL equal to NULL; ``b``'s further columns are added."""
    own = [f"_g{i}" for i in range(len(names))]
    b = b.select(*[F.col(c).alias(o) for c, o in zip(names, own)], *[c for c in b.columns if c not in names])
    on = [F.col(c).eqNullSafe(F.col(o)) for c, o in zip(names, own)]
    return a.join(b, on, how).drop(*own)


def _ranked(df: DataFrame, cols: list[str], p: float, keys: list[str], brackets: DataFrame) -> DataFrame:
    """The brackets with the values at the wanted ranks (NULL where a bracket doesn't hold them)."""
    group = [*keys, "column"]
    cells = df.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), _number(c).alias("value")) for c in cols])))
    cells = cells.where(F.col("value").isNotNull())
    limits = brackets.select(*group, "low", "high")
    cells = _matched(cells, limits, group).where("value <= high").select(
        *group, F.when(F.col("value") >= F.col("low"), F.col("value")).alias("value"))
    counts = cells.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("cnt")).checkpoint()
    order = [F.asc_nulls_first(c) for c in group]
    # What lies below a bracket comes first in its group, as one row.
    ahead = cumulative_before(counts, [*order, F.asc_nulls_first("value")], "cnt", "ahead")
    starts = ahead.groupBy(*group).agg(F.min("ahead").alias("start"))
    wanted = _matched(brackets, starts, group).select(
        *group, "n", "least", "most", "start",
        (F.floor((F.col("n") - 1) * F.lit(p)) + F.col("start")).alias("first"), (F.ceil((F.col("n") - 1) * F.lit(p)) + F.col("start")).alias("last"))
    holds = lambda r: F.when((F.col("ahead") <= F.col(r)) & (F.col(r) < F.col("ahead") + F.col("cnt")), F.col("value"))
    return _matched(ahead, wanted, group).groupBy(*group, "n", "least", "most").agg(
        F.max(holds("first")).alias("v_first"), F.max(holds("last")).alias("v_last"))


def _between(found: DataFrame, p: float, keys: list[str]) -> DataFrame:
    pos = (F.col("n") - 1) * F.lit(p)
    return found.select(*keys, "column", "n", (F.col("v_first") + (pos - F.floor(pos)) * (F.col("v_last") - F.col("v_first"))).alias("percentile"))


# ------------------------------------------------- frequent items

CAPACITY = 10_000


def item_sketches(df: DataFrame, keys: list[str], col: str, capacity: int = CAPACITY) -> DataFrame:
    """``(keys, rows, items)``: counters of at most ``capacity`` values a group, whatever their number.

    Counts are exact while a group has at most 3/4 of ``capacity`` values, and
    else too low or too high by ``item_bound`` of the rows at most.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k_accumulate(`{col}`, {int(capacity)})").alias("items"))


def item_bound(capacity: int = CAPACITY) -> float:
    """Error of a count as a share of the rows of the sketch."""
    return 3.5 / 2 ** math.ceil(math.log2(capacity / 0.75))


def merge_items(sketches: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """The sketches of coarser groups (``[]``: of everything) from those of finer ones."""
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.expr(f"approx_top_k_combine(items, {int(capacity)})").alias("items"))


def frequent_items(sketches: DataFrame, keys: list[str], name: str, k: int) -> DataFrame:
    """``(keys, name, count)``: the ``k`` values of the largest counts of each group's sketch."""
    return sketches.select(*keys, F.inline(F.expr(f"approx_top_k_estimate(items, {int(k)})"))).select(
        *keys, F.col("item").alias(name), "count")


__all__ = ["distinct_bound", "distinct_sketches", "merge_distinct", "distinct_estimate", "shared_estimate", "rank_bound",
           "quantile_sketches", "merge_quantiles", "quantile_estimate", "exact_percentiles", "item_sketches", "item_bound",
           "merge_items", "frequent_items"]
