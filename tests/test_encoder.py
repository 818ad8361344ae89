import pytest
from pyspark.sql import functions as F

from trendlens.ml import models as M
from trendlens.ml.encoder import JoinEncoder
from trendlens.ml.features import FeatureSpec, fit_features
from trendlens.ml.sweep import fold_of, sweep
from trendlens.ml.vectors import vector_entries
from trendlens.operators.joins import join_counted

TOL = 1e-10


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"c{i % 4}" if i % 9 else None, "hot" if i % 3 else f"d{i % 7}", ["a", "b", "a"] if i % 2 else (None if i % 10 == 0 else ["b", f"t{i % 5}"]),
             float((i * 7919) % 101) + (5.0 if i % 3 else 0.0)) for i in range(240)]
    return spark.createDataFrame(data, "video_id long, x string, y string, tags array<string>, likes double")


def spec(**kw):
    return FeatureSpec(categorical=("x", "y"), tags_col="tags", **kw)


@pytest.mark.parametrize("text", [None, "count", "tfidf"])
def test_equal_predictions_to_the_pipeline(rows, text):
    """The same width, and the same predictions of a model trained on either encoding."""
    clean = rows.where("tags is not null")   # the pipeline's vectorizer takes no NULL
    out = []
    for by_join in (False, True):
        pm, _, train = fit_features(spec(text=text, by_join=by_join), clean, keep=["likes"])
        m = M.train_linear(train.withColumnRenamed("likes", "label"), reg_param=0.1, tol=TOL)
        scored = m.transform(pm.transform(clean.select("video_id", "x", "y", "tags")))
        out.append((train.first().features.size, {r.video_id: r.prediction for r in scored.select("video_id", "prediction").collect()}))
        train.unpersist()
    assert out[0][0] == out[1][0] and out[0][1].keys() == out[1][1].keys()
    assert all(out[0][1][k] == pytest.approx(v, abs=1e-6) for k, v in out[1][1].items())


def test_unseen_null_and_repeated_rows(spark, rows):
    coder = JoinEncoder.fit(spec(text="count"), rows)
    odd = spark.createDataFrame([(1, "zz", None, ["zz", None, "a", "a"], 0.0), (1, "zz", None, ["zz", None, "a", "a"], 0.0), (2, None, "hot", None, 1.0)], rows.schema)
    got = coder.transform(odd)
    assert got.columns == [*odd.columns, "features"] and got.count() == 3
    entries = sorted((r.video_id, [tuple(e) for e in r.e]) for r in got.select("video_id", vector_entries("features").alias("e")).collect())
    a = coder.terms.where("term = 'a'").first()["index"]
    hot = coder.labels.where("column = 'y' and value = 'hot'").first()["index"]
    assert entries == [(1, [(a, 2.0)]), (1, [(a, 2.0)]), (2, [(hot, 1.0)])]
    assert {r.features.size for r in got.collect()} == {coder.width}
    assert coder.transform(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        JoinEncoder.fit(spec(), rows)


def test_save_and_load(spark, rows, tmp_dir):
    coder = JoinEncoder.fit(spec(text="tfidf", min_df=2.0), rows)
    coder.save(f"{tmp_dir}/encoder")
    again = JoinEncoder(spark, f"{tmp_dir}/encoder")
    assert again.sizes == coder.sizes and again.spec == coder.spec
    pick = lambda c: sorted((r.video_id, str(r.features)) for r in c.transform(rows).select("video_id", "features").collect())
    assert pick(again) == pick(coder)


def test_hot_labels_are_not_shuffled(spark):
    facts = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("key"))
    keyed = facts.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
    got = join_counted(facts, keyed, ["key"], "n", 5000)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in facts.join(keyed, "key").collect()}
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_encoded_models_do_not_score_streams(spark, rows):
    fitted = M.Fitted(JoinEncoder.fit(spec(text=None), rows), {})
    with pytest.raises(ValueError):
        M.score_stream(rows, {"US": fitted}, rows)


def test_folds_share_no_key_and_miss_none(rows):
    folds = rows.select("video_id", fold_of("video_id", 3, 7).alias("f"))
    assert {r.f for r in folds.collect()} == {0, 1, 2}
    report, best = sweep(rows, "likes", {"x": FeatureSpec(text=None, categorical=("x",)), "y": FeatureSpec(text=None, categorical=("y",))}, [0.0, 0.5], folds=3)
    got = report.collect()
    assert len(got) == 12 and sum(r.n for r in got if r.feature_set == "x" and r.reg_param == 0.0) == 240
    mean = {}
    for r in got:
        mean.setdefault((r.feature_set, r.reg_param), []).append(r.rmse)
    least = min(mean, key=lambda k: sum(mean[k]))
    assert (best["feature_set"], best["reg_param"]) == least and best["rmse"] == pytest.approx(sum(mean[least]) / 3)


def test_constant_label_and_no_rows(spark):
    pred = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "label double, prediction double")
    row = M.rmse_r2(pred).first()
    assert row.rmse == 1.0 and row.r2 is None and row.n == 2
    row = M.rmse_r2(pred.limit(0)).first()
    assert row.rmse is None and row.r2 is None and row.n == 0
