"""Profiles and group counts.

Whole-column statistics are computed on all rows in Spark (never on a
driver-side sample).  Scalars that later steps need (min, max, n, bandwidth)
are lazy scalar subqueries: Spark runs them once and inlines the value.  Two
operators run jobs of their own while the result is built, each with one row to
the driver: ``percentile`` (its bracket) and ``correlation_matrix`` (the means).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import time_part
from .clean import having_count_gt
from .rank import cumulative_before
from .topk import order_by_count_desc, order_by_key


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- counts

def row_count(df: DataFrame) -> DataFrame:
    """A1."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def distinct_count(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """A2: rows and distinct values in one pass (exact by default)."""
    d = (F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col))
    return df.agg(F.count(F.lit(1)).alias("rows"), d.alias("distinct_keys"))


def counts_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """A4: group count, key order."""
    return order_by_key(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")), keys)


def repeated_entities(df: DataFrame, key: str, min_count: int = 1) -> DataFrame:
    """A5: keys seen more than ``min_count`` times, most frequent first."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    return order_by_count_desc(having_count_gt(g, min_count), [key])


def counts_by_time(df: DataFrame, ts: str, part: str, out: str | None = None) -> DataFrame:
    """Counts per year / month / dayofweek (1 = Sunday) / hour, key order."""
    name = out or f"publish_{part}"
    g = df.groupBy(time_part(ts, part).alias(name)).agg(F.count(F.lit(1)).alias("count"))
    return order_by_key(g, [name])


# ------------------------------------------------------------- describe (A10)

def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """A10: typed long format ``(column, n, mean, stddev, min, max)``, one pass."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"),
                 F.stddev_samp(x).alias(f"sd{i}"), F.min(x).alias(f"min{i}"),
                 F.max(x).alias(f"max{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n"),
                     F.col(f"mean{i}").alias("mean"), F.col(f"sd{i}").alias("stddev"),
                     F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"))
            for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


# ----------------------------------------------------------- percentile

# Distinct values that the final sort of an exact percentile may hold.
BRACKET_ROWS = 100_000


def percentile(df: DataFrame, col: str, p: float = 0.75, approx: bool = False,
               accuracy: int = 10000, out: str = "percentile") -> DataFrame:
    """One-row DataFrame with the p-th percentile of non-NULL values.

    Exact (default): linear interpolation between the order statistics at
    floor/ceil of p*(n-1), as pandas ``quantile`` and SQL ``quantile_cont``.
    A quantile sketch, whose rank error is bounded, brackets both order
    statistics; rows below are counted, and only the distinct values inside the
    bracket are sorted.  A bracket with more than ``BRACKET_ROWS`` rows is
    narrowed by a sketch of its own (each pass keeps about 1/1000 of the rows; a
    value that holds much of the bracket ends up alone in it).  Where heavy end
    values keep a bracket from narrowing, its distinct values are ranked by
    ``cumulative_before``.  No data are shuffled but sketches and the bracket.
    ``approx=True`` uses ``percentile_approx`` (bounded memory sketch).
    """
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    if approx:
        return x.agg(F.percentile_approx("x", p, accuracy).alias(out))
    n, low, high = x.agg(F.count(F.lit(1)), F.min("x"), F.max("x")).first()
    if not n:
        return x.agg(F.max("x").alias(out))
    pos = (n - 1) * float(p)
    first, last = math.floor(pos), math.ceil(pos)
    below, inside = 0, n
    while inside > BRACKET_ROWS and low < high:
        slack = 3.0 / accuracy
        ends = [min(1.0, max(0.0, (r - below + 0.5) / inside + d)) for r, d in ((first, -slack), (last, slack))]
        part = x.where(F.col("x").between(low, high))
        a, b = part.agg(F.percentile_approx("x", ends, accuracy)).first()[0]
        if (a, b) == (low, high):
            break  # heavy end values: what lies between may be many distinct ones
        under, inside = part.agg(F.count_if(F.col("x") < a), F.count_if(F.col("x").between(a, b))).first()
        below, low, high = below + under, a, b
    vc = x.where(F.col("x").between(low, high)).groupBy("x").agg(F.count(F.lit(1)).alias("cnt"))
    if inside > BRACKET_ROWS and low < high:
        ranked = cumulative_before(vc, [F.col("x")], "cnt", "ahead").withColumn("ahead", F.col("ahead") + F.lit(below))
    else:  # at most BRACKET_ROWS distinct values, or one, meet in this window
        ahead = F.coalesce(F.sum("cnt").over(Window.orderBy("x").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ranked = vc.withColumn("ahead", ahead + F.lit(below))
    covers = lambda r: (F.col("ahead") <= r) & (r < F.col("ahead") + F.col("cnt"))
    picked = ranked.agg(F.min(F.when(covers(F.lit(first)), F.col("x"))).alias("v_lo"),
                        F.max(F.when(covers(F.lit(last)), F.col("x"))).alias("v_hi"))
    return picked.select((F.col("v_lo") + F.lit(pos - first) * (F.col("v_hi") - F.col("v_lo"))).alias(out))


# ------------------------------------------------------------ histogram

def _bounds(x: DataFrame) -> tuple[Column, Column]:
    s = x.agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    return s.select("mn").scalar(), s.select("mx").scalar()


def bin_index(x: Column, mn: Column, mx: Column, bins: int) -> Column:
    """Equal-width bin of x in [mn, mx]; the last bin is closed; mn == mx -> 0; NULL stays NULL."""
    raw = F.floor(F.try_divide((x - mn) * F.lit(bins), (mx - mn)))
    return F.when(x.isNotNull(), F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1))).cast("long")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """``(bin, lo, hi, count)`` for every bin, empty bins included."""
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    mn, mx = _bounds(x)
    counts = (x.select(bin_index(F.col("x"), mn, mx, bins).alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    spark = df.sparkSession
    grid = spark.range(bins).withColumnRenamed("id", "bin")
    width = (mx - mn)
    return (grid.join(F.broadcast(counts), "bin", "left")   # <= bins rows: bounded
            .select("bin",
                    (mn + F.col("bin") * width / F.lit(bins)).alias("lo"),
                    (mn + (F.col("bin") + 1) * width / F.lit(bins)).alias("hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


# -------------------------------------------------------------- density

def density(df: DataFrame, col: str, grid: int = 100, bandwidth: float | None = None,
            bins: int | None = 512) -> DataFrame:
    """Gaussian kernel density at ``grid`` points from min to max.

    Bandwidth defaults to Scott's rule ``stddev * n^(-1/5)``.  Rows are counted
    in ``bins`` equal-width bins, and each bin's centre contributes
    ``count * phi((g - centre) / h)`` to every grid point: at most bins * grid
    kernels whatever the data.  ``bins=None`` is exact: every distinct value
    contributes (for columns of few distinct values).  NULL and NaN don't count.
    Where there is no bandwidth (one row, or all values alike) the density is
    NULL at every point; no value, no point.
    """
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    s = x.agg(F.min("x").alias("mn"), F.max("x").alias("mx"),
              F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"))
    mn, mx = s.select("mn").scalar(), s.select("mx").scalar()
    n = s.select("n").scalar()
    h = (F.lit(float(bandwidth)) if bandwidth is not None
         else s.select(F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).scalar())
    if bins is None:
        vc = x.groupBy("x").agg(F.count(F.lit(1)).alias("cnt"))
    else:
        vc = (x.groupBy(bin_index(F.col("x"), mn, mx, bins).alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
              .select((mn + (F.col("bin") + F.lit(0.5)) * (mx - mn) / F.lit(bins)).alias("x"), "cnt"))
    step = F.try_divide(mx - mn, F.lit(float(grid - 1)))
    g = vc.select("x", "cnt", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    g = g.withColumn("g", mn + F.col("i") * F.coalesce(step, F.lit(0.0)))
    z = F.try_divide(F.col("g") - F.col("x"), h)
    contrib = F.col("cnt") * F.exp(F.lit(-0.5) * z * z)
    norm = F.try_divide(F.lit(1.0 / math.sqrt(2.0 * math.pi)), n * h)
    return (g.groupBy("i", "g").agg(F.sum(contrib).alias("k"))
            .select(F.col("i").cast("long").alias("point"), F.col("g").alias("x"),
                    (F.col("k") * norm).alias("density")))


# ---------------------------------------------------------- correlation

def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, long format.

    Two passes: means and NULL counts (one row to the driver), then one
    aggregate of centred cross products.  NULLs are dropped pairwise as ``corr``
    does: a pair with a NULL-holding column sums over its own rows, all other
    pairs share the columns' sums.  The matrix is symmetric by construction.
    """
    base = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    k = range(len(cols))
    rows, *stats = base.agg(F.count(F.lit(1)), *[F.count(f"v{i}") for i in k], *[F.avg(f"v{i}") for i in k]).first()
    full = [stats[i] == rows for i in k]
    d = [F.col(f"v{i}") - F.lit(stats[len(cols) + i]) for i in k]
    pairs = [(i, j) for i in k for j in k if i <= j]
    sums = {f"x{i}_{j}": F.sum(d[i] * d[j]) for i, j in pairs}
    sums |= {f"s{i}": F.sum(d[i]) for i in k}
    for i, j in pairs:
        if i != j and not (full[i] and full[j]):
            both = F.col(f"v{i}").isNotNull() & F.col(f"v{j}").isNotNull()
            sums |= {f"n{i}_{j}": F.count_if(both)}
            sums |= {f"{w}{i}_{j}": F.sum(F.when(both, e)) for w, e in
                     (("a", d[i]), ("b", d[j]), ("aa", d[i] * d[i]), ("bb", d[j] * d[j]))}
    one = base.agg(*[e.alias(c) for c, e in sums.items()])
    out = []
    for i, j in pairs:
        sxy = F.col(f"x{i}_{j}")
        if f"n{i}_{j}" in sums:
            n, sx, sy, sxx, syy = (F.col(f"{w}{i}_{j}") for w in ("n", "a", "b", "aa", "bb"))
        else:
            n, sx, sy = F.lit(stats[i]), F.col(f"s{i}"), F.col(f"s{j}")
            sxx, syy = F.col(f"x{i}_{i}"), F.col(f"x{j}_{j}")
        n = n.cast("double")
        cov = sxy - F.try_divide(sx * sy, n)
        var = (sxx - F.try_divide(sx * sx, n)) * (syy - F.try_divide(sy * sy, n))
        value = F.try_divide(cov, F.sqrt(var))
        out += [F.struct(F.lit(cols[a]).alias("col_a"), F.lit(cols[b]).alias("col_b"), value.alias("corr"))
                for a, b in ({(i, j), (j, i)})]
    return one.select(F.inline(F.array(*out)))


def vector_correlation(df: DataFrame, col: str) -> DataFrame:
    """A14 for hundreds of columns: ``(i, j, corr)`` of the slots of a vector column.

    One pass sums the products of a row's non-zero slots, which suits one-hot
    blocks; ``correlation_matrix`` would build an expression a pair.  The slots' k^2
    numbers meet on the driver (3,000 slots: 72 MB).  Rows without a vector don't
    count; a slot that never varies has NULL correlations.
    """
    rows = df.where(F.col(col).isNotNull())
    spark = df.sparkSession
    schema = "i int, j int, corr double"
    if rows.isEmpty():
        return spark.createDataFrame([], schema)
    matrix = Correlation.corr(rows, col).first()[0].toArray()
    k = len(matrix)
    flat = matrix.ravel()
    return spark.createDataFrame(pd.DataFrame({"i": np.repeat(np.arange(k), k), "j": np.tile(np.arange(k), k), "corr": flat}), schema) \
        .select("i", "j", F.when(~F.isnan("corr"), F.col("corr")).alias("corr"))


# ----------------------------------------------------- pairwise density

def pairwise_density(df: DataFrame, cols: list[str], bins: int = 10) -> DataFrame:
    """2-D bin counts for every column pair (the data of a pair plot).

    ``(col_a, col_b, bin_a, bin_b, count)`` for a <= b in the given order; the
    diagonal holds each column's histogram.  A NULL has no bin: its row counts
    in the pairs of its other columns only.  Each row emits C*(C+1)/2 small
    tuples map-side; counts are partially aggregated.
    """
    base = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    s = base.agg(*[F.min(c).alias(f"mn_{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"mx_{i}") for i, c in enumerate(cols)])
    binned = base.select(*[
        bin_index(F.col(c), s.select(f"mn_{i}").scalar(), s.select(f"mx_{i}").scalar(), bins)
        .alias(f"b{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(a).alias("col_a"), F.lit(cols[j]).alias("col_b"),
                      F.col(f"b{i}").alias("bin_a"), F.col(f"b{j}").alias("bin_b"))
             for i, a in enumerate(cols) for j in range(i, len(cols))]
    return (binned.select(F.inline(F.array(*pairs)))
            .where(F.col("bin_a").isNotNull() & F.col("bin_b").isNotNull())
            .groupBy("col_a", "col_b", "bin_a", "bin_b")
            .agg(F.count(F.lit(1)).alias("count")))


__all__ = ["row_count", "distinct_count", "counts_by", "repeated_entities", "counts_by_time",
           "describe_numeric", "percentile", "bin_index", "histogram",
           "density", "correlation_matrix", "vector_correlation", "pairwise_density"]
