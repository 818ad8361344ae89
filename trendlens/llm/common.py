"""Shared helpers: table access, written intermediates, skew-safe join, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.session import new_scratch_path

# A key can only be "hot" if it holds at least one row in HOT_SHARE, so at most
# HOT_SHARE keys are hot whatever the data: the broadcast in ``join_hot`` is bounded.
HOT_SHARE = 1000

# Bytes of rows that go to Python at once: Spark's 64 MB are held several times over in each task.
BATCH_BYTES = 4 << 20
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """From here on the session's Arrow batches hold ``BATCH_BYTES`` at most, unless it has a bound of its own."""
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scopes: list[list[str]] = []


@contextmanager
def intermediates() -> Iterator[list[str]]:
    """The paths that ``written`` makes inside the block, for who knows when they aren't read any more."""
    made: list[str] = []
    _scopes.append(made)
    try:
        yield made
    finally:
        _scopes[:] = [x for x in _scopes if x is not made]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage is cut there, and a
    lost executor costs only its running tasks."""
    spark = df.sparkSession
    path = new_scratch_path(spark, name)
    for made in _scopes:
        made.append(path)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def join_hot(left: DataFrame, right: DataFrame, key: str | list[str], n_col: str, total: int, how: str = "inner") -> DataFrame:
    """Inner or left join of ``left`` with ``right`` (one row per key, ``n_col`` = how many left
    rows have the key) where a few keys may hold most of ``left``.

    Keys with at least ``total / HOT_SHARE`` rows (at most ``HOT_SHARE`` of them) are joined
    by broadcast and never shuffled; the others are shuffled and none of them is large.
    """
    keys = [key] if isinstance(key, str) else key
    least = max(2, -(-total // HOT_SHARE))
    hot = F.broadcast(right.filter(F.col(n_col) >= least))
    rest = left.join(hot.select(*keys), keys, "left_anti").join(
        right.filter(F.col(n_col) < least), keys, how)
    cols = [*keys, *[c for x in (left, right) for c in x.columns if c not in keys]]
    return left.join(hot, keys).select(*cols).unionByName(rest.select(*cols))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(u long, v long)``: rows (u, v = least node of u's
    component) for every node that isn't itself the least.

    Alternating large-star / small-star rounds; each round is written to the shared folder,
    and only a count and a checksum come to the driver.  A star centre's neighbours are
    joined, never gathered; adaptive skew handling splits a large one.
    """
    e = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = written(e.distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            return e
        seen = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
