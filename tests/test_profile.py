"""Profiles against brute force (numpy) on fixtures, including a hot key."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlens.operators import profile, sampling
from trendlens.operators.rank import cumulative_before


def _values(n=3000, seed=7):
    rng = np.random.default_rng(seed)
    v = rng.normal(50, 20, n).round(2)
    v[: n // 3] = 42.0            # one value holds a third of all rows
    return v


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.75, 0.9, 1.0])
def test_percentile_exact_matches_numpy(spark, p):
    v = _values()
    df = spark.createDataFrame([(float(x),) for x in v], "x double").repartition(7)
    got = profile.percentile(df, "x", p).first()[0]
    assert got == pytest.approx(float(np.quantile(v, p)), abs=1e-9)


def test_percentile_ignores_nulls_and_single_value(spark):
    df = spark.createDataFrame([(None,), (3.0,), (None,)], "x double")
    assert profile.percentile(df, "x", 0.75).first()[0] == 3.0


def test_cumulative_before_brute_force(spark):
    rows = [(k, int(w)) for k, w in zip(range(500), np.random.default_rng(1).integers(1, 9, 500))]
    df = spark.createDataFrame(rows, "k int, w long")
    got = {r.k: r.cum_before for r in
           cumulative_before(df, [F.col("k").desc()], weight="w", partitions=6).collect()}
    acc, want = 0, {}
    for k, w in sorted(rows, reverse=True):
        want[k] = acc
        acc += w
    assert got == want


def test_histogram_counts_sum_and_empty_bins(spark):
    v = [0.0, 0.0, 1.0, 10.0, None]
    df = spark.createDataFrame([(x,) for x in v], "x double")
    h = profile.histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [3, 0, 0, 0, 1]
    assert h[0].lo == 0.0 and h[-1].hi == 10.0


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    h = profile.histogram(df, "x", 3).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 0, 0]


def test_histogram_matches_numpy(spark):
    v = _values()
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    got = [r["count"] for r in profile.histogram(df, "x", 16).orderBy("bin").collect()]
    want, _ = np.histogram(v, bins=16)
    # numpy nudges values on inner edges; totals and almost every bin agree
    assert sum(got) == len(v)
    assert np.abs(np.array(got) - want).sum() <= 2


def test_density_matches_brute_force(spark):
    v = np.array([1, 1, 2, 3, 3, 3, 7, 10], dtype=float)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    got = profile.density(df, "x", grid=11, bins=None).orderBy("point").collect()
    h = v.std(ddof=1) * len(v) ** -0.2
    g = np.linspace(v.min(), v.max(), 11)
    want = np.exp(-0.5 * ((g[:, None] - v[None, :]) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert np.allclose([r.density for r in got], want, rtol=1e-12)


def test_correlation_symmetric_unit_diagonal(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=200)
    rows = [(float(x), float(2 * x + rng.normal()), float(rng.normal())) for x in a]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    m = {(r.col_a, r.col_b): r.corr for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert all(m[(c, c)] == pytest.approx(1.0) for c in "abc")
    assert m[("a", "b")] == m[("b", "a")]
    assert m[("a", "b")] == pytest.approx(np.corrcoef(a, [r[1] for r in rows])[0, 1], abs=1e-12)


def test_describe_numeric(spark):
    df = spark.createDataFrame([(1.0, 2), (3.0, None)], "x double, y int")
    r = {row.column: row for row in profile.describe_numeric(df, ["x", "y"]).collect()}
    assert (r["x"].n, r["x"].mean, r["x"].min, r["x"].max) == (2, 2.0, 1.0, 3.0)
    assert r["x"].stddev == pytest.approx(np.sqrt(2.0))
    assert r["y"].n == 1


def test_pairwise_density_totals(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), float(-i)) for i in range(30)],
                               "a double, b double, c double")
    out = profile.pairwise_density(df, ["a", "b", "c"], bins=4)
    tot = {(r.col_a, r.col_b): r["sum(count)"] for r in out.groupBy("col_a", "col_b").sum("count").collect()}
    assert tot == {("a", "b"): 30, ("a", "c"): 30, ("b", "c"): 30, ("a", "a"): 30, ("b", "b"): 30, ("c", "c"): 30}


def test_pairwise_density_skips_nulls(spark):
    df = spark.createDataFrame([(None, 10.0), (10.0, None), (1.0, 1.0), (5.0, 5.0), (None, None)], "a double, b double")
    tot = {(r.col_a, r.col_b): r["sum(count)"] for r in
           profile.pairwise_density(df, ["a", "b"], bins=4).groupBy("col_a", "col_b").sum("count").collect()}
    assert tot == {("a", "b"): 2, ("a", "a"): 3, ("b", "b"): 3}


def test_binned_density_is_close_to_the_exact_one(spark):
    v = _values(3000)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    exact, binned = ([r.density for r in profile.density(df, "x", bins=b).orderBy("point").collect()] for b in (None, 512))
    assert np.allclose(exact, binned, rtol=0.02, atol=max(exact) * 0.01)


def test_correlation_with_nulls_is_pairwise(spark):
    rng = np.random.default_rng(4)
    rows = [(float(rng.normal() + 1e6), None if i % 7 == 0 else float(rng.normal()), None if i % 5 == 0 else float(i), 3.0) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    m = {(r.col_a, r.col_b): r.corr for r in profile.correlation_matrix(df, ["a", "b", "c", "k"]).collect()}
    for x, y in (("a", "b"), ("a", "c"), ("b", "c"), ("c", "b"), ("b", "b")):
        want = df.selectExpr(f"corr({x}, {y})").first()[0]
        assert m[(x, y)] == pytest.approx(want, abs=1e-9)
    assert m[("a", "k")] is None


def test_percentile_of_skewed_values_and_narrow_brackets(spark, monkeypatch):
    monkeypatch.setattr(profile, "BRACKET_ROWS", 20)
    rng = np.random.default_rng(8)
    v = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.pareto(1.0, 1000)])
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "x double")
    for p in (0.0, 0.1, 0.5, 0.55, 0.75, 0.999, 1.0):
        assert profile.percentile(df, "x", p).first()[0] == pytest.approx(np.quantile(v, p), abs=1e-12)
    assert profile.percentile(df.limit(0), "x", 0.5).first()[0] is None


def test_results_unchanged_under_repartition(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("x"))
    a = profile.histogram(df, "x", 10).orderBy("bin").collect()
    b = profile.histogram(df.repartition(13), "x", 10).orderBy("bin").collect()
    assert a == b


def test_sample_and_split_by_key_partition_the_input(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    tr, te = sampling.split_by_key(df, "k", 0.7, seed=101)
    assert tr.count() + te.count() == 5000
    assert tr.join(te, "k").count() == 0
    s1 = {r.k for r in sampling.sample_by_key(df, "k", 0.1, 42).collect()}
    s2 = {r.k for r in sampling.sample_by_key(df.repartition(5), "k", 0.1, 42).collect()}
    assert s1 == s2 and 350 < len(s1) < 650


def test_repeated_entities_and_counts_by(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("c",), ("c",), ("c",)], "v string")
    got = [(r.v, r["count"]) for r in profile.repeated_entities(df, "v").collect()]
    assert got == [("c", 3), ("a", 2)]
    assert [r.v for r in profile.counts_by(df, ["v"]).collect()] == ["a", "b", "c"]


def test_approximate_options(spark):
    v = _values(2000)
    df = spark.createDataFrame([(float(x), int(i % 97)) for i, x in enumerate(v)], "x double, k int")
    exact = profile.percentile(df, "x", 0.75).first()[0]
    approx = profile.percentile(df, "x", 0.75, approx=True, accuracy=10000).first()[0]
    assert abs(approx - exact) <= np.ptp(v) * 0.01
    r = profile.distinct_count(df, "k", approx=True).first()
    assert r.rows == 2000 and abs(r.distinct_keys - 97) <= 3
