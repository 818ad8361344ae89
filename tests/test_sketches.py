import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlens.operators import profile
from trendlens.operators import sketches as K


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["US", "CA", None]), rnd.choice([None, rnd.gauss(0, 1), 5.0]), float(rnd.randint(0, 9)), float("nan") if i % 50 == 0 else float(i)) for i in range(4000)]
    rows += [("GB", None, 1.0, 2.0), ("XX", None, None, float("nan"))]
    return spark.createDataFrame(rows, "region string, a double, b double, c double").repartition(5)


def numpy_percentiles(table, p, keyed=True):
    out = {}
    rows = table.collect()
    for region in {r.region for r in rows} if keyed else {0}:
        for c in "abc":
            x = [r[c] for r in rows if (not keyed or r.region == region) and r[c] is not None and r[c] == r[c]]
            if x:
                out[(region, c) if keyed else c] = (len(x), float(np.quantile(x, p)))
    return out


@pytest.mark.parametrize("p", [0.0, 0.25, 0.75, 1.0])
@pytest.mark.parametrize("slack", [None, 1e-12, 0.2])
def test_exact_percentiles(table, p, slack):
    """Brackets that always miss (no slack), that hold, and that are wide."""
    got = {(r.region, r.column): (r.n, r.percentile) for r in K.exact_percentiles(table, ["a", "b", "c"], p, ["region"], entries=64, slack=slack).collect()}
    want = numpy_percentiles(table, p)
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-9) for k in want)


def test_stored_sketches_are_used_and_merged(table):
    stored = K.quantile_sketches(table, ["a", "b", "c"], ["region"], 256).checkpoint()
    merged = K.merge_quantiles(stored)
    got = {r.column: (r.n, r.percentile) for r in K.exact_percentiles(table, ["a", "b", "c"], 0.5, entries=256, sketches=merged).collect()}
    assert got == {c: (n, pytest.approx(x)) for c, (n, x) in numpy_percentiles(table, 0.5, keyed=False).items()}
    for r in K.quantile_estimate(merged, 0.5).collect():
        x = np.sort([v[r.column] for v in table.collect() if v[r.column] is not None and v[r.column] == v[r.column]])
        low, high = np.searchsorted(x, r.estimate, "left") / len(x), np.searchsorted(x, r.estimate, "right") / len(x)
        assert low - 3 * K.rank_bound(256) <= 0.5 <= high + 3 * K.rank_bound(256)


def test_empty_table(table):
    none = table.limit(0)
    assert K.exact_percentiles(none, ["a", "b"], 0.5, ["region"]).count() == 0
    assert K.exact_percentiles(none, ["a", "b"], 0.5).count() == 0
    assert K.distinct_estimate(K.merge_distinct(K.distinct_sketches(none, ["region"], "b"), [])).first().estimate in (0, None)


def test_distinct_and_shared(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 2 == 0, "US").otherwise("CA").alias("region"), (F.col("id") % 20_000).cast("string").alias("tag"))
    more = rows.union(spark.range(5000).select(F.lit("CA").alias("region"), (F.col("id") * 2).cast("string").alias("tag")))
    stored = K.distinct_sketches(more, ["region"], "tag").checkpoint()
    true = {r.region: r.n for r in more.groupBy("region").agg(F.count_distinct("tag").alias("n")).collect()}
    for r in K.distinct_estimate(stored).collect():
        assert abs(r.estimate - true[r.region]) <= K.distinct_bound() * true[r.region] + 1
    assert abs(K.distinct_estimate(K.merge_distinct(stored, [])).first().estimate - 20_000) <= K.distinct_bound() * 20_000
    both = K.shared_estimate(stored, "region", "US", "CA").first()
    assert abs(both.estimate - 5000) <= K.distinct_bound() * 20_000 and abs(both.both - 20_000) <= K.distinct_bound() * 20_000


def test_items_exact_within_capacity(spark):
    rows = spark.range(9000).select((F.col("id") % 3).alias("region"), F.concat(F.lit("t"), F.floor(F.sqrt(F.col("id") % 997)).cast("string")).alias("tag"))
    stored = K.item_sketches(rows, ["region"], "tag", 200).checkpoint()
    got = {r.tag: r["count"] for r in K.frequent_items(K.merge_items(stored, [], 200), [], "tag", 200).collect()}
    assert got == {r.tag: r["count"] for r in rows.groupBy("tag").count().collect()}
    per = {(r.region, r.tag): r["count"] for r in K.frequent_items(stored, ["region"], "tag", 200).collect()}
    assert per == {(r.region, r.tag): r["count"] for r in rows.groupBy("region", "tag").count().collect()}


def test_density_of_constant_single_empty_and_nan(spark):
    make = lambda *x: spark.createDataFrame([(v,) for v in x], "x double")
    for df in (make(3.0, 3.0, 3.0), make(1.0), make(2.0, None, float("nan"))):
        for bins in (512, None):
            got = profile.density(df, "x", grid=5, bins=bins).collect()
            assert len(got) == 5 and all(r.density is None for r in got)
    assert profile.density(make(), "x").count() == 0
    clean, dirty = (profile.density(make(*x), "x", grid=4).orderBy("point").collect() for x in ((1.0, 2.0, 4.0), (1.0, 2.0, 4.0, float("nan"), None)))
    assert [r.density for r in clean] == [r.density for r in dirty] and all(r.density > 0 for r in clean)


def test_percentile_between_heavy_ends(spark, monkeypatch):
    """Two heavy values with a thin stretch of distinct ones between them, where the sketch's ends repeat."""
    monkeypatch.setattr(profile, "BRACKET_ROWS", 50)
    x = [0.0] * 3000 + [float(i) / 1000 for i in range(1, 400)] + [1.0] * 3000
    df = spark.createDataFrame([(v,) for v in x], "x double").repartition(4)
    for p in (0.0, 0.3, 0.5, 0.5313, 0.9, 1.0):
        assert profile.percentile(df, "x", p, accuracy=20).first()[0] == pytest.approx(float(np.quantile(x, p)))


def test_vector_correlation(spark):
    from pyspark.ml.linalg import Vectors
    data = [[1.0, 2.0, 0.0], [2.0, 4.5, 0.0], [3.0, 5.0, 0.0], [4.0, 9.0, 0.0]]
    df = spark.createDataFrame([(Vectors.dense(v),) for v in data], ["v"]).union(spark.createDataFrame([(None,)], spark.createDataFrame([(Vectors.dense([1.0]),)], ["v"]).schema))
    got = {(r.i, r.j): r["corr"] for r in profile.vector_correlation(df, "v").collect()}
    want = np.corrcoef(np.array(data)[:, :2].T)
    assert got[0, 1] == pytest.approx(want[0, 1]) and got[0, 2] is None and len(got) == 9
    assert profile.vector_correlation(df.limit(0), "v").count() == 0
