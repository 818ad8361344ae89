"""Feature and model operators: golden values and exactness of compaction."""

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF, IDF, CountVectorizer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from trendlens.ml import models as M
from trendlens.ml.features import (FeatureSpec, build_features, document_frequency,
                                   feature_pipeline, label_index)
from trendlens.ml.vectors import vector_entries
from trendlens.plans import features as PF

from .conftest import SF_SMALL


def test_string_indexer_golden_and_label_index(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    m = StringIndexer(inputCol="v", outputCol="i", handleInvalid="keep").fit(train)
    test = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,), ("zz",)], "v string")
    assert [r.i for r in m.transform(test).collect()] == [2, 1, 0, 0, 3, 3]
    ours = [r.value for r in label_index(train, "v").orderBy("idx").collect()]
    assert ours == list(m.labels) == ["c", "a", "b"]


def test_label_index_matches_string_indexer_on_table(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    m = StringIndexer(inputCol="p_brand", outputCol="i").fit(part)
    ours = [r.value for r in label_index(part, "p_brand").orderBy("idx").collect()]
    assert ours == list(m.labels)


def test_one_hot_unseen_all_zero(spark):
    from pyspark.ml import Pipeline
    from trendlens.ml.features import index_stages, one_hot_stages
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    pm = Pipeline(stages=index_stages(["v"]) + one_hot_stages(["v"])).fit(train)
    test = spark.createDataFrame([("c",), ("zz",), (None,)], "v string")
    vecs = [r.v_ohe for r in pm.transform(test).collect()]
    assert all(v.size == 3 for v in vecs)
    assert vecs[0][0] == 1.0 and vecs[1].numNonzeros() == 0 and vecs[2].numNonzeros() == 0


def test_hashing_golden_indices(spark):
    df = spark.createDataFrame([(["none", "music", "funny", "hip hop", "abcd", "none"],)],
                               "t array<string>")
    h = HashingTF(inputCol="t", outputCol="v", numFeatures=262144).transform(df)
    got = {r.e["index"]: r.e["value"] for r in h.select(F.explode(vector_entries("v")).alias("e")).collect()}
    assert sorted(got) == [58828, 110743, 131250, 194194, 203540]
    assert got[110743] == 2.0


def test_idf_golden_and_spark_idf(spark):
    docs = [(0, ["a", "b", "c"]), (1, ["a", "b"]), (2, ["a"]), (3, ["d"])]
    df = spark.createDataFrame(docs, "id int, terms array<string>")
    ours = {r.term: r.idf for r in document_frequency(df, "id", "terms").collect()}
    assert ours["a"] == pytest.approx(0.22314, abs=1e-5)
    assert ours["b"] == pytest.approx(0.51083, abs=1e-5)
    assert ours["c"] == pytest.approx(0.91629, abs=1e-5)
    cv = CountVectorizer(inputCol="terms", outputCol="tf").fit(df)
    idf = IDF(inputCol="tf", outputCol="w").fit(cv.transform(df))
    spark_idf = dict(zip(cv.vocabulary, idf.idf.toArray()))
    assert all(spark_idf[t] == pytest.approx(ours[t], rel=1e-12) for t in ours)


@pytest.fixture(scope="module")
def featurized(spark):
    return build_features(PF.records(spark, SF_SMALL), PF.ROLES).persist()


def test_compaction_keeps_linear_predictions(spark, featurized):
    """Dropping all-zero columns leaves L-BFGS predictions unchanged."""
    spec = FeatureSpec(num_features=8192)
    tr, te = M.split(featurized, "video_id")
    full = feature_pipeline(spec).fit(tr)
    ftr = full.transform(tr).withColumn("label", F.col("comments_ratio"))
    fte = full.transform(te)
    m_full = M.train_linear(ftr, features="features", solver="l-bfgs")
    p_full = [r.prediction for r in m_full.transform(fte).orderBy("video_id", "l_linenumber").collect()]

    compact, width, rows = M.fit_features(spec, tr, keep=["comments_ratio"])
    assert width > 8192
    ctr = rows.withColumn("label", F.col("comments_ratio"))
    assert ctr.first()["features"].size < width
    assert compact.transform(tr).first()["features"].size == ctr.first()["features"].size
    m_c = M.train_linear(ctr, solver="l-bfgs")
    p_c = [r.prediction for r in m_c.transform(compact.transform(te))
           .orderBy("video_id", "l_linenumber").collect()]
    assert np.allclose(p_full, p_c, rtol=1e-6, atol=1e-9)


def test_rmse_r2_matches_evaluator(spark, featurized):
    from pyspark.ml.evaluation import RegressionEvaluator
    f = M.train_targets(featurized, ["likes_ratio"], FeatureSpec(num_features=1024), "video_id")
    m = f.models["likes_ratio"]
    _, te = M.split(featurized, "video_id")
    pred = m.transform(f.pipeline.transform(te).withColumn("label", F.col("likes_ratio")))
    ours = M.rmse_r2(pred).first()
    rmse = RegressionEvaluator(metricName="rmse").evaluate(pred)
    r2 = RegressionEvaluator(metricName="r2").evaluate(pred)
    assert ours.rmse == pytest.approx(rmse, rel=1e-9) and ours.r2 == pytest.approx(r2, rel=1e-9)
    rep = f.report.first()
    assert rep.target == "likes_ratio" and rep.rmse == pytest.approx(rmse, rel=1e-9)


def test_save_load_score(spark, featurized, tmp_dir):
    recs = PF.records(spark, SF_SMALL)
    fitted = M.train_job(recs, PF.ROLES, FeatureSpec(num_features=1024), split_key="video_id",
                         out_path=tmp_dir)
    assert len(fitted) >= 2
    region = sorted(fitted)[0]
    loaded = M.load_models(f"{tmp_dir}/{region}")
    dim = PF.category_dim(spark, SF_SMALL)
    name = dim.where(F.col("region") == region).first().categoryTitle
    req = spark.createDataFrame([
        (1, region, "Supplier#x", "red widget", "Brand#1|SMALL|red widget", name, "1995-03-04 05:06:07"),
        (2, region, "Supplier#x", "red widget", "", "NO SUCH", "1995-03-04 05:06:07"),
        (3, region, "Supplier#x", "red widget", "a||b", name, "bad date"),
    ], "request_id long, region string, channel_title string, title string, tags string, "
       "category_name string, publish_dt string")
    out = {r.request_id: r for r in M.score(req, {region: loaded}, dim).collect()}
    assert out[1].error is None and out[1].pred_comments_ratio is not None
    assert out[2].error.startswith("unknown category") and out[2].pred_likes_ratio is None
    assert out[3].error == "bad publish_dt" and out[3].pred_likes_ratio is None
    # the saved models give the same predictions as the in-memory ones
    same = M.score(req.where("request_id = 1"), {region: fitted[region]}, dim).first()
    assert same.pred_comments_ratio == pytest.approx(out[1].pred_comments_ratio, rel=1e-12)


def _requests(spark, rows):
    return spark.createDataFrame(rows, "request_id long, region string, channel_title string, title string, tags string, "
                                       "category_name string, publish_dt string")


def test_every_request_comes_back_once(spark):
    """No model, NULL region and duplicate titles neither lose nor double a request."""
    recs = PF.records(spark, SF_SMALL)
    fitted = M.train_job(recs, PF.ROLES, FeatureSpec(text=None, categorical=("publish_month_str",)), split_key="video_id", regions=["ASIA"])
    assert list(fitted) == ["ASIA"] and fitted["ASIA"].report.first().n > 0
    dim = spark.createDataFrame([("ASIA", "Music", 1, 0), ("ASIA", "Music", 2, 1), ("MOON", "Music", 3, 2)],
                                "region string, categoryTitle string, categoryId int, pos int")
    when = "1995-03-04 05:06:07"
    req = _requests(spark, [(1, "ASIA", "c", "t", "a|b", "Music", when), (2, "MOON", "c", "t", "a|b", "Music", when),
                            (3, None, "c", "t", "a|b", "Music", when), (4, "ASIA", "c", "t", None, None, when)])
    out = {r.request_id: r for r in M.score(req, fitted, dim, order_col="pos").collect()}
    assert M.score(req, fitted, dim).count() == 4 and sorted(out) == [1, 2, 3, 4]
    assert out[1].error is None and out[1].pred_likes_ratio is not None
    assert out[2].error == "no model for region MOON" and out[2].pred_likes_ratio is None
    assert out[3].error == "unknown category Music" and out[4].error == "unknown category NULL"
    null_dim = dim.withColumn("region", F.lit(None).cast("string"))
    assert M.score(req.where("request_id = 2"), {}, dim).first().error == "no model for region MOON"
    from trendlens.operators.joins import lookup_category_id
    got = lookup_category_id(req.where("request_id = 1"), dim, order_col="pos").collect()
    assert [(r.categoryId, r.error) for r in got] == [(2, None)]
    assert null_dim.count() == 3


def test_null_region_trains_no_model_and_one_model_for_all(spark):
    recs = PF.records(spark, SF_SMALL)
    spec = FeatureSpec(text=None, categorical=("publish_month_str",))
    some = recs.withColumn("region", F.when(F.col("region") == "ASIA", F.col("region")))
    assert list(M.train_job(some, PF.ROLES, spec, split_key="video_id")) == ["ASIA"]
    every = M.train_job(recs, PF.ROLES, spec, split_key="video_id", region_col=None)
    assert list(every) == ["ALL"]
    dim = spark.createDataFrame([("X", "Music", 1)], "region string, categoryTitle string, categoryId int")
    req = _requests(spark, [(1, "X", "c", "t", "a", "Music", "1995-03-04 05:06:07")])
    assert M.score(req, every, dim, regional=False).first().error is None


def test_empty_test_half_raises(spark, featurized):
    one = featurized.where(F.col("video_id") == featurized.first().video_id)
    tr, te = M.split(one, "video_id")
    with pytest.raises(ValueError, match="empty"):
        M.train_targets(tr if te.isEmpty() else one.limit(0), ["likes"], FeatureSpec(text=None, categorical=("publish_month_str",)), "video_id")


def test_whole_vocabulary_is_kept(spark):
    """More terms than the old cap of 262,144."""
    from trendlens.ml.features import vocabulary_size
    n = 270_000
    docs = spark.range(n // 100).select(F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(F.lit("t"), (F.col("id") * 100 + i).cast("string"))).alias("tag_array_lower"))
    spec = FeatureSpec(text="count", categorical=())
    assert vocabulary_size(spec, docs) == n
    assert vocabulary_size(spec.with_(min_df=2.0), docs) == 1    # one at least
    model, width, rows = M.fit_features(spec, docs.limit(50))
    rows.unpersist()
    assert width == 50 * 100


def test_vector_entries_of_sparse_dense_and_null(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql import types as T
    rows = [(1, Vectors.sparse(9, [2, 5], [1.0, 3.0])), (2, Vectors.dense([0.0, 4.0])), (3, None)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("id", T.IntegerType()), T.StructField("v", VectorUDT())]))
    got = {r.id: r.e and [(e["index"], e["value"]) for e in r.e] for r in df.select("id", vector_entries("v").alias("e")).collect()}
    assert got == {1: [(2, 1.0), (5, 3.0)], 2: [(1, 4.0)], 3: None}


def _rows_of_two_halves(spark, n=400):
    rows = [(i, "ab"[i % 2] if i % 9 else None, f"c{i % 5}", ["t", f"t{i % 7}"], float(i % 10) + i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "video_id long, x string, y string, tags array<string>, likes double")


def test_tree_fit_deals_wide_partitions(spark, monkeypatch):
    """All rows in one partition: beyond the bound the learner gets them in several, with the same predictions."""
    rows = _rows_of_two_halves(spark).coalesce(1)
    data = VectorAssembler(inputCols=["video_id", "likes"], outputCol="features").transform(rows.withColumnRenamed("likes", "label").withColumn(
        "likes", F.col("label") * 2))
    assert M.dealt(rows, 100, 400 * 100) is rows
    more = M.dealt(rows, 100, 40 * 100)
    assert max(r["count"] for r in more.groupBy(F.spark_partition_id()).count().collect()) <= 60
    assert more.exceptAll(rows).isEmpty() and more.count() == 400
    fitted, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, d: fitted.append(d.select(F.spark_partition_id()).distinct().count()) or fit(self, d))
    whole = M.train_gbt(data, max_iter=2, max_depth=3)
    monkeypatch.setattr(M, "TASK_BYTES", 10 * 1000)
    parts = M.train_gbt(data, max_iter=2, max_depth=3)
    assert fitted[0] == 1 and fitted[1] > 4
    got, want = ([r.prediction for r in m.transform(data).orderBy("video_id").collect()] for m in (parts, whole))
    assert got == pytest.approx(want, rel=1e-9)


def test_gbt_targets_deal_rows_before_they_are_held(spark, monkeypatch):
    spec = FeatureSpec(num_features=64, categorical=("x",), tags_col="tags")
    rows = _rows_of_two_halves(spark).coalesce(1)
    plain = M.train_targets(rows, ["likes"], spec, kind="gbt").report.collect()
    seen, dealt = [], M.dealt
    monkeypatch.setattr(M, "TASK_BYTES", 50 * 1000)
    monkeypatch.setattr(M, "dealt", lambda d, *a: seen.append(d.columns) or dealt(d, *a))
    again = M.train_targets(rows, ["likes"], spec, kind="gbt").report.collect()
    assert seen[0] == ["video_id", "x", "tags", "likes"] and len(seen) == 2
    assert [r.n for r in again] == [r.n for r in plain] and again[0].rmse == pytest.approx(plain[0].rmse, rel=1e-9)


def test_feature_sets_share_their_categoricals(spark, monkeypatch):
    """The categoricals of all encodings are indexed once, and each report is that of the encoding alone."""
    from trendlens.ml import features
    rows = _rows_of_two_halves(spark)
    base = FeatureSpec(num_features=64, categorical=("x", "y"), tags_col="tags")
    specs = {"hashing": base, "count": base.with_(text="count"), "tfidf": base.with_(text="tfidf", min_df=2.0), "none": base.with_(text=None)}
    alone = {n: M.train_targets(rows, ["likes"], s, reg_param=0.1).report.first() for n, s in specs.items()}
    made, stages = [], features.index_stages
    monkeypatch.setattr(features, "index_stages", lambda cats: made.append(tuple(cats)) or stages(cats))
    got = {r.feature_set: r for r in M.compare_feature_sets(rows, "likes", specs, reg_params=dict.fromkeys(specs, 0.1)).collect()}
    assert made == [("x", "y")] and got.keys() == alone.keys()
    for n, r in alone.items():
        assert got[n].n == r.n and got[n].rmse == pytest.approx(r.rmse, rel=1e-9) and got[n].r2 == pytest.approx(r.r2, rel=1e-9)


def test_test_half_is_read_once_for_all_targets(spark, monkeypatch):
    """Metrics as one by one, with nulls in labels; nothing of the test half is held, and both halves come from their own folders."""
    rows = [(i, f"t{i % 3}", None if i % 7 == 0 else float(i % 3), float(i % 5), "a" if i % 2 else "b") for i in range(400)]
    recs = spark.createDataFrame(rows, "video_id long, word_count_str string, likes double, view_count double, region string")
    spec, key = FeatureSpec(text=None, categorical=("word_count_str",)), "video_id"
    held, persist = [], type(recs).persist
    monkeypatch.setattr(type(recs), "persist", lambda self, *a: held.append(self.columns) or persist(self, *a))
    fitted = M.train_targets(recs, ["likes", "view_count"], spec, key, persist_input=False)
    assert len(held) == 1
    test = M.split(recs, key)[1]
    got = [tuple(r) for r in fitted.report.collect()]
    assert [r[0] for r in got] == ["likes", "view_count"] and got[0][3] < got[1][3] == test.count()
    for t, rmse, r2, n in got:
        one = M.rmse_r2(fitted.models[t].transform(fitted.pipeline.transform(test)), t).first()
        assert (rmse, r2, n) == (pytest.approx(one.rmse, abs=1e-9), pytest.approx(one.r2, abs=1e-9), one.n)
    monkeypatch.setattr(M, "build_features", lambda df, *a, **k: df)
    monkeypatch.setattr(M, "split", lambda *a, **k: pytest.fail("split again"))
    jobs = M.train_job(recs, M.Roles(), spec, ["likes", "view_count"])
    assert sum(r.n for r in M.job_report(jobs).where("target = 'view_count'").collect()) == test.count()
