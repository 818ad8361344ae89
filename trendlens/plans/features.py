"""Feature and model queries (M1-M15, A17, A18) on lineitem-based records.

Binding of the record roles: video_id -> l_orderkey, title -> p_name,
tags -> 'p_brand|p_type|p_name', categoryId -> supplier nation key (category
dimension = nation, its region = the record's region), publishedAt ->
l_shipdate, channelTitle -> s_name, view_count -> l_quantity, likes ->
l_extendedprice, dislikes -> l_discount, comment_count -> l_tax, and
comments_disabled -> l_returnflag = 'R'.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.sql import functions as F

from ..functions.columns import log1p
from ..ml import models as M
from ..ml.encoder import JoinEncoder
from ..ml.features import FeatureSpec, Roles, build_features, document_frequency, label_index
from ..ml.sweep import sweep
from ..ml.vectors import vector_entries
from ..operators import clean, profile
from ..operators.sampling import split_label
from ..session import new_scratch_path
from ..sources.requests import REQUEST_SCHEMA, requests_to_df
from ..sources.tables import read_table
from ..streaming import running as S
from .registry import register

ROLES = Roles(title="title", tags="tags", category="categoryId", published="publishedAt",
              channel="channelTitle", views="view_count", likes="likes",
              dislikes="dislikes", comments="comment_count")
R4 = 4


def category_dim(spark, sf_dir):
    """Category dimension with names and regions: nation joined to region."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("categoryId"), F.col("n_name").alias("categoryTitle"),
        F.col("r_name").alias("region"))


def records(spark, sf_dir):
    """Cleaned trending-style records built from lineitem, part, supplier, nation."""
    li = read_table(spark, sf_dir, "lineitem")
    li = clean.clean_records(li, "l_quantity", F.col("l_returnflag") == "R")
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("title"),
        F.concat_ws("|", "p_brand", "p_type", "p_name").alias("tags"))
    sup = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_name").alias("channelTitle"),
        F.col("s_nationkey").alias("categoryId"))
    sup = sup.join(category_dim(spark, sf_dir).select("categoryId", "region"),
                   "categoryId", "left")
    facts = li.select(
        F.col("l_orderkey").alias("video_id"), "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_shipdate").alias("publishedAt"), F.col("l_quantity").alias("view_count"),
        F.col("l_extendedprice").alias("likes"), F.col("l_discount").alias("dislikes"),
        F.col("l_tax").alias("comment_count"))
    facts = facts.join(part, facts.l_partkey == part.p_partkey)
    facts = facts.join(sup, facts.l_suppkey == sup.s_suppkey)
    return facts.drop("p_partkey", "s_suppkey")


def _featurized(spark, sf_dir):
    return build_features(records(spark, sf_dir), ROLES)


# ------------------------------------------------------------- label tables
LABEL_SQL = """
SELECT '{col}' AS "column", value, CAST(row_number() OVER (ORDER BY count DESC, value) - 1 AS BIGINT) AS idx,
       count
FROM (SELECT CAST({col} AS VARCHAR) AS value, count(*) AS count FROM part
      WHERE {col} IS NOT NULL GROUP BY 1)
"""


@register("index_categories", "M2", "\nUNION ALL\n".join(
    LABEL_SQL.format(col=c) for c in ("p_type", "p_brand")))
def q_index_categories(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    out = None
    for c in ("p_type", "p_brand"):
        t = label_index(part, c).select(F.lit(c).alias("column"), "value", "idx", "count")
        out = t if out is None else out.unionByName(t)
    return out


@register("one_hot_long", "M3 M2", """
WITH lab AS (SELECT value, row_number() OVER (ORDER BY count DESC, value) - 1 AS idx,
                    count(*) OVER () AS size
             FROM (SELECT p_type AS value, count(*) AS count FROM part
                   WHERE p_type IS NOT NULL GROUP BY 1))
SELECT p_partkey, CAST(lab.idx AS BIGINT) AS slot, CAST(lab.size AS BIGINT) AS size
FROM part LEFT JOIN lab ON part.p_type = lab.value
""")
def q_one_hot_long(spark, sf_dir):
    """Active slot of the one-hot vector per row (NULL slot = all-zero vector)."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    lab = label_index(part, "p_type")
    size = lab.agg(F.count(F.lit(1))).scalar()
    j = part.join(lab, part.p_type == lab.value, "left")
    return j.select("p_partkey", F.col("idx").cast("long").alias("slot"),
                    size.cast("long").alias("size"))


@register("tfidf_weights", "M5 M6", """
WITH d AS (SELECT p_partkey, list_distinct(string_split(lower(p_name), ' ')) AS terms FROM part),
m AS (SELECT count(*) AS m FROM part),
f AS (SELECT term, count(*) AS df FROM (SELECT unnest(terms) AS term FROM d) GROUP BY term)
SELECT term, df, round(ln((m + 1) / (df + 1)), 6) AS idf FROM f, m
""")
def q_tfidf_weights(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.split(F.lower("p_name"), " ").alias("terms"))
    out = document_frequency(part, "p_partkey", "terms")
    return out.select("term", "df", F.round("idf", 6).alias("idf"))


@register("hashed_features", "M4")
def q_hashed_features(spark, sf_dir):
    """HashingTF term counts in long form ``(p_partkey, bucket, tf)`` (262144 wide)."""
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", F.split(F.lower("p_name"), " ").alias("terms"))
    h = HashingTF(inputCol="terms", outputCol="tf_vec", numFeatures=262144).transform(part)
    return (h.select("p_partkey", F.explode(vector_entries("tf_vec")).alias("e"))
            .select("p_partkey", F.col("e.index").cast("long").alias("bucket"),
                    F.col("e.value").alias("tf")))


@register("hashed_term_totals", "M4", """
SELECT p_partkey, CAST(len(string_split(lower(p_name), ' ')) AS DOUBLE) AS terms FROM part
""")
def q_hashed_term_totals(spark, sf_dir):
    """Sum of term counts per part: its number of terms, whatever the hash."""
    return q_hashed_features(spark, sf_dir).groupBy("p_partkey").agg(F.sum("tf").alias("terms"))


_ENCODED = FeatureSpec(text="tfidf", min_df=2.0, categorical=("p_brand", "p_container_type"), tags_col="terms", by_join=True)


@register("encoded_rows", "M2 M3 M5 M6 M7 M8", """
WITH d AS (SELECT p_partkey, p_brand, CASE WHEN p_size % 7 <> 0 THEN split_part(p_type, ' ', 1) END AS p_container_type,
             string_split(lower(p_name), ' ') AS terms FROM part),
t AS (SELECT p_partkey, unnest(terms) AS term FROM d),
f AS (SELECT term, count(DISTINCT p_partkey) AS df FROM t GROUP BY term HAVING count(DISTINCT p_partkey) >= 2),
terms AS (SELECT term, row_number() OVER (ORDER BY df DESC, term) - 1 AS "index", ln(((SELECT count(*) FROM d) + 1) / (df + 1)) AS idf FROM f),
brand AS (SELECT p_brand, (SELECT count(*) FROM terms) + row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS "index" FROM d GROUP BY p_brand),
kind AS (SELECT p_container_type, (SELECT count(*) FROM terms) + (SELECT count(*) FROM brand) + row_number() OVER (ORDER BY count(*) DESC, p_container_type) - 1 AS "index"
         FROM d WHERE p_container_type IS NOT NULL GROUP BY p_container_type)
SELECT p_partkey, CAST("index" AS INTEGER) AS "index", round(value, 6) AS value FROM (
  SELECT p_partkey, "index", count(*) * any_value(idf) AS value FROM t JOIN terms USING (term) GROUP BY ALL
  UNION ALL SELECT p_partkey, "index", 1.0 FROM d JOIN brand USING (p_brand)
  UNION ALL SELECT p_partkey, "index", 1.0 FROM d JOIN kind USING (p_container_type))
""")
def q_encoded_rows(spark, sf_dir):
    """Every non-zero slot of the parts' vectors: names as TF-IDF terms, brand and kind as
    one-hot blocks, encoded by join (a NULL kind has no slot)."""
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", F.when(F.col("p_size") % 7 != 0, F.split_part("p_type", F.lit(" "), F.lit(1))).alias("p_container_type"),
        F.split(F.lower("p_name"), " ").alias("terms"))
    coded = JoinEncoder.fit(_ENCODED, part).transform(part)
    return coded.select("p_partkey", F.explode(vector_entries("features")).alias("e")).select(
        "p_partkey", F.col("e.index").alias("index"), F.round("e.value", 6).alias("value"))


# -------------------------------------------------------- linear regression
@register("linear_fit", "M9 M7", f"""
SELECT round(regr_slope(l_extendedprice / 1000, l_quantity), {R4}) AS slope,
       round(regr_intercept(l_extendedprice / 1000, l_quantity), {R4}) AS intercept
FROM lineitem
""")
def q_linear_fit(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    d = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(
        li.select("l_quantity", (F.col("l_extendedprice") / 1000).alias("label")))
    m = M.train_linear(d)
    spark_ = li.sparkSession
    return spark_.createDataFrame(
        [(round(float(m.coefficients[0]), R4), round(float(m.intercept), R4))],
        "slope double, intercept double")


@register("regression_metrics", "M9 A17 X4", f"""
WITH s AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y,
                  CASE WHEN CAST(('0x' || substr(md5('101:' || CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT)
                            / 4294967296.0 < 0.7 THEN 'train' ELSE 'test' END AS split FROM lineitem),
c AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM s WHERE split = 'train'),
e AS (SELECT y, y - (a + b * x) AS err FROM s, c WHERE split = 'test')
SELECT round(sqrt(avg(err * err)), {R4}) AS rmse,
       round(1 - sum(err * err) / (var_pop(y) * count(*)), {R4}) AS r2, count(*) AS n FROM e
""")
def q_regression_metrics(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    d = split_label(li.select("l_orderkey", "l_quantity",
                              (F.col("l_extendedprice") / 1000).alias("label")),
                    "l_orderkey", 0.7, seed=101)
    d = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(d)
    m = M.train_linear(d.where(F.col("split") == "train"))
    met = M.rmse_r2(m.transform(d.where(F.col("split") == "test")))
    return met.select(F.round("rmse", R4).alias("rmse"), F.round("r2", R4).alias("r2"), "n")


# ---------------------------------------------------- pipelines and reports
def _report(df):
    return df.select(*[c for c in df.columns if c not in ("rmse", "r2")],
                     F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


@register("multi_target_report", "M11 M8 A18")
def q_multi_target_report(spark, sf_dir):
    targets = ["likes_ratio", "view_count", "likes", "dislikes", "comment_count"]
    f = M.train_targets(_featurized(spark, sf_dir), targets, FeatureSpec(), "video_id")
    return _report(f.report)


@register("log_target_metrics", "M12 F10")
def q_log_target_metrics(spark, sf_dir):
    f = M.train_targets(_featurized(spark, sf_dir), ["view_count"], FeatureSpec(), "video_id",
                        label_fn=log1p)
    return _report(f.report.withColumn("target", F.lit("log1p_view_count")))


@register("feature_set_report", "M13 M4 M5 M6")
def q_feature_set_report(spark, sf_dir):
    base = FeatureSpec(categorical=tuple(FeatureSpec().categorical[:6]))
    specs = {
        "hashing_262144": base,
        "hashing_32768": base.with_(num_features=32768),
        "hashing_131072": base.with_(num_features=131072),
        "tfidf_min_df_5": base.with_(text="tfidf", min_df=5.0),
        "count_all_terms": base.with_(text="count", min_df=1.0),
    }
    out = M.compare_feature_sets(_featurized(spark, sf_dir), "comments_ratio", specs,
                                 "video_id", reg_params={"tfidf_min_df_5": 0.1})
    return _report(out)


@register("gbt_metrics", "M10 A17")
def q_gbt_metrics(spark, sf_dir):
    spec = FeatureSpec(num_features=32768, categorical=tuple(FeatureSpec().categorical[:6]))
    f = M.train_targets(_featurized(spark, sf_dir), ["comments_ratio"], spec, "video_id",
                        kind="gbt")
    return _report(f.report.withColumn("target", F.lit("gbt_comments_ratio")))


def _requests(recs):
    """Rows of records as scoring requests, numbered by order and line."""
    return recs.select(
        (F.col("video_id") * 10 + F.col("l_linenumber")).alias("request_id"), "region",
        F.col("channelTitle").alias("channel_title"), "title", "tags", F.col("categoryId").alias("cat_id"),
        F.date_format("publishedAt", "yyyy-MM-dd HH:mm:ss").alias("publish_dt"))


def _named(requests, dim):
    names = dim.select(F.col("categoryId").alias("cat_id"), F.col("categoryTitle").alias("category_name"))
    return requests.join(names, "cat_id", "left").drop("cat_id")


def _train_and_load(spark, recs, spec, **more):
    """Train per region, save, and load the models again."""
    path = new_scratch_path(spark, "models")
    fitted = M.train_job(recs, ROLES, spec, M.PAIR_TARGETS, split_key="video_id", out_path=path, **more)
    return {r: M.load_models(f"{path}/{r}") for r in fitted}


@register("batch_score", "M14 M15 J2 S10 S11 S13")
def q_batch_score(spark, sf_dir):
    """Train per region, save, load, and score the test half as requests."""
    recs = records(spark, sf_dir)
    dim = category_dim(spark, sf_dir)
    loaded = _train_and_load(spark, recs, FeatureSpec())
    _, test = M.split(recs, "video_id")
    return M.score(requests_to_df(spark, _named(_requests(test), dim)), loaded, dim)


# ------------------------------------- closed forms: groups predict their mean
#
# Least squares on one one-hot column, and trees that can part all values of a
# column, predict the training mean of a row's group.  So these oracles hold the
# indexer, one-hot, text encodings, assembly, split, solvers, job, saved models and
# scoring to exact values.

TOL = 1e-12  # the oracles hold four places
MONTHS = FeatureSpec(text=None, categorical=("publish_month_str",))
FRACTION_SQL = ("CAST(('0x' || substr(md5('101:' || CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0")
# Cleaned records with their half of the split.
RECORDS_SQL = f"""
rec AS (SELECT l.*, month(l_shipdate) AS grp, r_name AS region, n_name, s_name, p_brand,
               l_tax / l_quantity AS comments_ratio, round(l_extendedprice / l_quantity, 2) AS likes_ratio,
               CASE WHEN {FRACTION_SQL} < 0.7 THEN 'train' ELSE 'test' END AS split
        FROM lineitem l JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
             LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        WHERE l_quantity <> 0 AND (l_returnflag = 'R') = false)
"""


def means_sql(name: str, y: str, grp: str, by: str = "") -> str:
    """Metrics of the training mean of ``grp`` (within ``by``) on the test half."""
    keys = f"{by}, grp" if by else "grp"
    pick = f"{by}, " if by else ""
    tail = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {pick}'{name}' AS target, round(sqrt(avg(err * err)), {R4}) AS rmse,
       round(1 - sum(err * err) / (var_pop(y) * count(*)), {R4}) + 0.0 AS r2, count(*) AS n
FROM (SELECT {pick}t.y AS y, t.y - m.p AS err
      FROM (SELECT {pick}{grp} AS grp, {y} AS y FROM rec WHERE split = 'test') t
      JOIN (SELECT {pick}{grp} AS grp, avg({y}) AS p FROM rec WHERE split = 'train' GROUP BY ALL) m USING ({keys}))
{tail}"""


def _rounded(df):
    # + 0.0: no negative zero
    return df.select(*[c for c in df.columns if c not in ("rmse", "r2")], F.round("rmse", R4).alias("rmse"),
                     (F.round("r2", R4) + F.lit(0.0)).alias("r2"))


_MEAN_TARGETS = {"view_count": "l_quantity", "likes": "l_extendedprice", "comments_ratio": "comments_ratio"}


@register("one_hot_report", "M2 M3 M7 M8 M9 M11 A18", f"WITH {RECORDS_SQL}" + "\nUNION ALL\n".join(
    means_sql(t, y, "grp") for t, y in _MEAN_TARGETS.items()))
def q_one_hot_report(spark, sf_dir):
    f = M.train_targets(_featurized(spark, sf_dir), list(_MEAN_TARGETS), MONTHS, "video_id", tol=TOL)
    return _rounded(f.report)


@register("log_target_means", "M12 F10", f"WITH {RECORDS_SQL}" + means_sql("log1p_view_count", "ln(1 + l_quantity)", "grp"))
def q_log_target_means(spark, sf_dir):
    f = M.train_targets(_featurized(spark, sf_dir), ["view_count"], MONTHS, "video_id", label_fn=log1p, tol=TOL)
    return _rounded(f.report.withColumn("target", F.lit("log1p_view_count")))


_SETS = {
    "hashing_262144": FeatureSpec(categorical=(), tags_col="brand_tag"),
    "hashing_32768": FeatureSpec(num_features=32768, categorical=(), tags_col="brand_tag"),
    "tfidf_min_df_1": FeatureSpec(text="tfidf", categorical=(), tags_col="brand_tag"),
    "count_all_terms": FeatureSpec(text="count", categorical=(), tags_col="brand_tag"),
}


@register("feature_set_means", "M13 M4 M5 M6", f"WITH {RECORDS_SQL}" + "\nUNION ALL\n".join(
    means_sql(name, "comments_ratio", "p_brand") for name in _SETS).replace("AS target", "AS feature_set"))
def q_feature_set_means(spark, sf_dir):
    """One tag a row: under every encoding the model predicts the tag's mean."""
    feats = _featurized(spark, sf_dir).withColumn("brand_tag", F.slice("tag_array_lower", 1, 1))
    return _rounded(M.compare_feature_sets(feats, "comments_ratio", _SETS, "video_id", tol=TOL))


_FOLD_SETS = {"months": MONTHS, "weekdays": FeatureSpec(text=None, categorical=("publish_dayofweek_str",))}
_FOLD_SQL = FRACTION_SQL.replace("101:", "7:")


def _ridge_sql(name: str, grp: str, reg: float, y: str = "comments_ratio") -> str:
    """Per fold the RMSE of ridge regression on one one-hot column in closed form: every group's
    mean, shrunk towards an intercept.  Spark divides by the standard deviations of the
    label and of each slot, so the penalty of a group's offset is regParam / sd(y) * p * (1 - p)."""
    return f"""
SELECT '{name}' AS feature_set, CAST({reg} AS DOUBLE) AS reg_param, fold, round(sqrt(avg(err * err)), {R4 + 2}) AS rmse, count(*) AS n
FROM (SELECT t.fold, t.y - (b + (m - b) * p / (p + s)) AS err
  FROM (SELECT fold, {grp} AS grp, {y} AS y FROM folded) t
  JOIN (SELECT fold, grp, p, m, s, coalesce(sum(p * s / (p + s) * m) OVER w / nullif(sum(p * s / (p + s)) OVER w, 0), 0) AS b
    FROM (SELECT fold, grp, c / t AS p, m, {reg} / sd * (c / t) * (1 - c / t) AS s
      FROM (SELECT f.fold, {grp} AS grp, count(*)::DOUBLE AS c, avg({y}) AS m FROM folded r JOIN range(3) f(fold) ON r.fold <> f.fold GROUP BY ALL)
      JOIN (SELECT f.fold, count(*)::DOUBLE AS t, stddev_pop({y}) AS sd FROM folded r JOIN range(3) f(fold) ON r.fold <> f.fold GROUP BY ALL) USING (fold))
    WINDOW w AS (PARTITION BY fold)) USING (fold, grp)) GROUP BY fold"""


@register("fold_sweep", "M13 M9 X4 A17", f"WITH {RECORDS_SQL}, folded AS (SELECT *, CAST(floor({_FOLD_SQL} * 3) AS INTEGER) AS fold FROM rec)" + "\nUNION ALL\n".join(
    _ridge_sql(name, grp, reg) for name, grp in (("months", "grp"), ("weekdays", "dayofweek(l_shipdate)")) for reg in (0.0, 0.1)))
def q_fold_sweep(spark, sf_dir):
    """Two encodings, without and with regParam 0.1, on three folds."""
    report, _ = sweep(_featurized(spark, sf_dir), "comments_ratio", _FOLD_SETS, [0.0, 0.1], "video_id", folds=3, seed=7, tol=TOL)
    return report.select("feature_set", "reg_param", F.col("fold").cast("int").alias("fold"), F.round("rmse", R4 + 2).alias("rmse"), "n")


@register("gbt_means", "M10 A17", f"WITH {RECORDS_SQL}" + means_sql("likes", "l_extendedprice", "l_linenumber"))
def q_gbt_means(spark, sf_dir):
    """Depth 5 parts all seven line numbers, so the first tree predicts their means."""
    d = M.dealt(records(spark, sf_dir).select("video_id", "l_linenumber", F.col("likes").alias("label")), M.ROW_BYTES)
    d = split_label(d, "video_id", 0.7, seed=101)
    d = VectorAssembler(inputCols=["l_linenumber"], outputCol="features").transform(d).persist()
    m = M.train_gbt(d.where(F.col("split") == "train"))
    out = M._materialize(M.model_report([("likes", M.rmse_r2(m.transform(d.where(F.col("split") == "test"))))]))
    d.unpersist()
    return _rounded(out)


@register("train_job_report", "M14 S12 A18", f"WITH {RECORDS_SQL}" + "\nUNION ALL\n".join(
    means_sql(t, t, "grp", "region") for t in M.PAIR_TARGETS))
def q_train_job_report(spark, sf_dir):
    return _rounded(M.job_report(M.train_job(records(spark, sf_dir), ROLES, MONTHS, M.PAIR_TARGETS, split_key="video_id", tol=TOL)))


@register("join_encoded_report", "M2 M3 M8 M9 M14 S10 S11 S12 A18", f"WITH {RECORDS_SQL}" + "\nUNION ALL\n".join(
    means_sql(t, t, "s_name", "region").replace(f"sqrt(avg(err * err)), {R4}", "sqrt(avg(err * err)), 1") for t in M.PAIR_TARGETS))
def q_join_encoded_report(spark, sf_dir):
    """Channels as the feature: their labels stay in tables, and each model predicts its channel's mean."""
    spec = FeatureSpec(text=None, categorical=("channel_lower",), by_join=True)
    report = M.job_report(M.train_job(records(spark, sf_dir), ROLES, spec, M.PAIR_TARGETS, split_key="video_id", tol=TOL))
    return _rounded(report.withColumn("rmse", F.round("rmse", 1)))


_SCORES_SQL = f"""
WITH {RECORDS_SQL}, m AS (SELECT region, grp, avg(comments_ratio) AS c, avg(likes_ratio) AS l FROM rec WHERE split = 'train' GROUP BY ALL)
SELECT l_orderkey * 10 + l_linenumber AS request_id, region, round(c, 5) AS pred_comments_ratio, round(l / 100, 2) AS pred_likes_ratio_100
FROM rec JOIN m USING (region, grp) WHERE split = 'test'
"""


def _rounded_scores(scored):
    return scored.select("request_id", "region", F.round("pred_comments_ratio", 5).alias("pred_comments_ratio"),
                         F.round(F.col("pred_likes_ratio") / 100, 2).alias("pred_likes_ratio_100"))


@register("score_means", "M15 S10 S11 S12 S13 J2", _SCORES_SQL)
def q_score_means(spark, sf_dir):
    recs, dim = records(spark, sf_dir), category_dim(spark, sf_dir)
    loaded = _train_and_load(spark, recs, MONTHS, tol=TOL)
    _, test = M.split(recs, "video_id")
    return _rounded_scores(M.score(requests_to_df(spark, _named(_requests(test), dim)), loaded, dim))


@register("stream_scores", "M15 S5 S6 S7 S10 S11 S13 J2", _SCORES_SQL)
def q_stream_scores(spark, sf_dir):
    """The requests arrive as JSON lines in several micro-batches; their scores are appended to Parquet files."""
    recs, dim = records(spark, sf_dir), category_dim(spark, sf_dir)
    loaded = _train_and_load(spark, recs, MONTHS, tol=TOL)
    _, test = M.split(recs, "video_id")
    arriving, scores = (new_scratch_path(spark, name) for name in ("requests", "scores"))
    _named(_requests(test), dim).select(F.to_json(F.struct("*")).alias("value")).write.text(arriving)
    raw = S.read_file_stream(spark, arriving, "part-*", None, fmt="text", max_files_per_trigger=2)
    requests = requests_to_df(spark, S.decode_events(raw, REQUEST_SCHEMA, keep=[]))
    name = S.unique_name("scores")
    S.drain(S.start_append(M.score_stream(requests, loaded, dim), name, scores, available_now=True))
    return _rounded_scores(spark.read.parquet(scores))


@register("score_audit", "M15 J2 F8", f"""
WITH {RECORDS_SQL}, q AS (SELECT l_orderkey * 10 + l_linenumber AS id FROM rec WHERE split = 'test')
SELECT reason, count(*) AS requests, count(DISTINCT id) AS ids FROM (
  SELECT id, CASE WHEN id % 5 = 0 OR id % 11 = 0 OR id % 13 = 0 THEN 'unknown category'
                  WHEN id % 7 = 0 THEN 'bad publish_dt'
                  WHEN id % 17 = 0 THEN 'no model for region' ELSE 'scored' END AS reason FROM q)
GROUP BY reason
""")
def q_score_audit(spark, sf_dir):
    """Every request comes back once, with its prediction or the reason for none.

    A region that is NULL or unknown has no categories, so its categories are
    unknown; one region keeps its categories but has no model."""
    recs, dim = records(spark, sf_dir), category_dim(spark, sf_dir)
    fitted = M.train_job(recs, ROLES, MONTHS, M.PAIR_TARGETS, split_key="video_id")
    _, test = M.split(recs, "video_id")
    i = F.col("request_id")
    away = dim.withColumn("region", F.concat("region", F.lit(" (no model)")))
    # a title twice: the dimension's duplicates must not double requests
    dims = dim.unionByName(away).unionByName(dim.where("categoryId % 2 = 0"))
    req = _named(_requests(test), dim) \
        .withColumn("category_name", F.when(i % 5 == 0, F.lit("NO SUCH")).otherwise(F.col("category_name"))) \
        .withColumn("publish_dt", F.when(i % 7 == 0, F.lit("yesterday")).otherwise(F.col("publish_dt"))) \
        .withColumn("region", F.when(i % 11 == 0, F.lit(None)).when(i % 13 == 0, F.lit("MOON"))
                    .when(i % 17 == 0, F.concat("region", F.lit(" (no model)"))).otherwise(F.col("region")))
    scored = M.score(req, fitted, dims)
    pred = [F.col(f"pred_{t}").isNotNull() for t in M.PAIR_TARGETS]
    reason = F.when(F.col("error").isNull() & pred[0] & pred[1], "scored") \
        .when(F.col("error").startswith("unknown category") & ~pred[0], "unknown category") \
        .when(F.col("error").startswith("no model for region") & ~pred[0], "no model for region").otherwise(F.col("error"))
    return scored.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("requests"), F.count_distinct("request_id").alias("ids"))


_DUMMIES = FeatureSpec(text=None, categorical=("l_returnflag", "l_linestatus", "l_linenumber"), by_join=True)


@register("correlation_one_hot", "A14 M3", """
WITH d AS (SELECT CAST(l_returnflag AS VARCHAR) AS l_returnflag, CAST(l_linestatus AS VARCHAR) AS l_linestatus, CAST(l_linenumber AS VARCHAR) AS l_linenumber FROM lineitem),
s AS (SELECT 'l_returnflag=' || v AS slot, v, 0 AS c FROM (SELECT DISTINCT l_returnflag AS v FROM d)
  UNION ALL SELECT 'l_linestatus=' || v, v, 1 FROM (SELECT DISTINCT l_linestatus AS v FROM d)
  UNION ALL SELECT 'l_linenumber=' || v, v, 2 FROM (SELECT DISTINCT l_linenumber AS v FROM d)),
k AS (SELECT *, count(*) AS n FROM d GROUP BY ALL),
pairs AS (SELECT a.slot AS slot_a, b.slot AS slot_b, n, CASE WHEN a.v = CASE a.c WHEN 0 THEN l_returnflag WHEN 1 THEN l_linestatus ELSE l_linenumber END THEN 1 ELSE 0 END AS x,
    CASE WHEN b.v = CASE b.c WHEN 0 THEN l_returnflag WHEN 1 THEN l_linestatus ELSE l_linenumber END THEN 1 ELSE 0 END AS y FROM k, s a, s b)
SELECT slot_a, slot_b, round((sum(n * x * y) / sum(n) - sum(n * x) / sum(n) * sum(n * y) / sum(n))
  / sqrt((sum(n * x) / sum(n) * (1 - sum(n * x) / sum(n))) * (sum(n * y) / sum(n) * (1 - sum(n * y) / sum(n)))), 6) + 0.0 AS corr
FROM pairs GROUP BY slot_a, slot_b
""")
def q_correlation_one_hot(spark, sf_dir):
    """Correlations of all slots of three one-hot blocks."""
    li = read_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    coder = JoinEncoder.fit(_DUMMIES, li)
    slots = coder.labels.select(F.col("index").cast("int").alias("i"), F.concat_ws("=", "column", "value").alias("slot"))
    corr = profile.vector_correlation(coder.transform(li), "features")
    return corr.join(slots.withColumnRenamed("slot", "slot_a"), "i").join(slots.select(F.col("i").alias("j"), F.col("slot").alias("slot_b")), "j") \
        .select("slot_a", "slot_b", (F.round("corr", 6) + F.lit(0.0)).alias("corr"))
