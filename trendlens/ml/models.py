"""Regression models, metrics and jobs.

Feature pipelines are fitted once per job and on the training rows only;
every target reuses the same features.  Metrics are DataFrames computed by a
distributed aggregate, not Python dicts.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.regression import (GBTRegressor, LinearRegression, LinearRegressionModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import parse_publish_time
from ..operators.clean import rename_target
from ..operators.joins import lookup_category_id
from ..operators.sampling import random_split, split_by_key, split_label
from ..session import ensure_checkpoint_dir, new_scratch_path, remove_path
from .encoder import JoinEncoder
from .features import CATEGORICAL, ENCODED, FeatureSpec, Roles, build_features, categorical_vectors, fit_features

PAIR_TARGETS = ("comments_ratio", "likes_ratio")

# What a task holds of the rows of a tree fit, and a row's bytes there beside four for each slot.
TASK_BYTES = 256 << 20
ROW_BYTES = 200


def dealt(rows: DataFrame, row_bytes: int, task_bytes: int | None = None) -> DataFrame:
    """``rows`` dealt anew in partitions of about ``task_bytes`` (default: ``TASK_BYTES``), if a row takes
    ``row_bytes`` and one partition has more than that; else as they are.  Counts the rows, once."""
    task_bytes = task_bytes or TASK_BYTES
    counts = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    largest, total = counts.agg(F.max("n"), F.sum("n")).first()
    if not total or largest * row_bytes <= task_bytes:
        return rows
    return rows.repartition(max(-(-total * row_bytes // task_bytes), rows.sparkSession.sparkContext.defaultParallelism))


# ----------------------------------------------------------------- training

def train_linear(train: DataFrame, label: str = "label", features: str = "features",
                 reg_param: float = 0.0, max_iter: int = 100,
                 solver: str = "auto", tol: float = 1e-6) -> LinearRegressionModel:
    """M9: least squares with Spark's defaults (standardized, solver auto)."""
    lr = LinearRegression(featuresCol=features, labelCol=label, regParam=reg_param,
                          maxIter=max_iter, solver=solver, tol=tol)
    return lr.fit(train.where(F.col(label).isNotNull()))


def train_gbt(train: DataFrame, label: str = "label", features: str = "features",
              max_iter: int = 10, max_depth: int = 5, seed: int = 101):
    """Gradient-boosted trees.

    The learner holds every slot of a row as a number in its partition, so the rows are
    dealt by the vectors' width: what one task reads does not grow with the rows.
    """
    gbt = GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter,
                       maxDepth=max_depth, seed=seed)
    rows = train.where(F.col(label).isNotNull()).select(features, label)
    first = rows.first()
    return gbt.fit(dealt(rows, ROW_BYTES + 4 * first[0].size) if first else rows)


def rmse_r2(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE and R^2 (1 - SSE / SST) over the scored rows, one aggregate.

    R^2 is NULL where all labels are alike, both are where there is no row.
    """
    y = F.col(label).cast("double")
    e = y - F.col(prediction)
    return (pred.where(y.isNotNull() & F.col(prediction).isNotNull())
            .agg(F.sqrt(F.avg(e * e)).alias("rmse"),
                 (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
                 F.count(F.lit(1)).alias("n")))


def metrics_by_target(test: DataFrame, models: dict, labels: dict) -> DataFrame:
    """A17 and A18 of several models at once: the rows of ``rmse_r2`` of each (``labels``: its label), in one pass over ``test``."""
    found = []
    for i, (t, m) in enumerate(models.items()):
        m = m.copy()
        m.setPredictionCol(f"_pred{i}")
        test = m.transform(test)
        y, p = labels[t].cast("double"), F.col(f"_pred{i}")
        both = y.isNotNull() & p.isNotNull()
        y, e = F.when(both, y), F.when(both, y - p)
        found.append(F.struct(
            F.lit(t).alias("target"), F.sqrt(F.avg(e * e)).alias("rmse"),
            (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"), F.count(y).alias("n")))
    return test.agg(F.array(*found).alias("found")).select(F.inline("found"))


def model_report(results: list[tuple[str, DataFrame]], name_col: str = "target") -> DataFrame:
    """One row per (name, rmse, r2, n)."""
    frames = [m.select(F.lit(n).alias(name_col), "rmse", "r2", "n") for n, m in results]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def split(df: DataFrame, key: str | None, train_fraction: float = 0.7, seed: int = 101):
    """Group-aware keyed split (default) or Spark's random split (key=None)."""
    if key is None:
        return tuple(random_split(df, (train_fraction, 1 - train_fraction), seed))
    return split_by_key(df, key, train_fraction, seed)


@dataclass
class Fitted:
    """A fitted feature pipeline and one model per target."""
    pipeline: PipelineModel
    models: dict = field(default_factory=dict)
    report: DataFrame | None = None


def train_targets(featurized: DataFrame, targets, spec: FeatureSpec = FeatureSpec(),
                  split_key: str | None = "video_id", kind: str = "linear",
                  reg_param: float = 0.0, label_fn=None, seed: int = 101,
                  persist_input: bool = True, parallel: int = 4, solver: str = "auto",
                  tol: float = 1e-6, halves: tuple[DataFrame, DataFrame] | None = None) -> Fitted:
    """Fit the feature pipeline once on train rows, then one model per target.

    ``label_fn`` maps a target column to the label expression (e.g. log1p, M12).
    ``solver`` is Spark's: ``auto`` solves the normal equations in one pass while
    the (compact) vector has at most 4096 columns, and iterates beyond.  Only the
    columns that the fit reads are persisted, and released at the end.  Raises
    when the test half has no row, since nothing would be evaluated.  The test half is
    read once, for all targets.  ``halves``: ``featurized`` as it was split before.
    """
    text = [spec.tags_col] if spec.text else []
    need = dict.fromkeys([*([split_key] if split_key else []), *spec.categorical, *text, *([spec.encoded] if spec.encoded else []), *targets])
    base = featurized.select(*need)
    if kind == "gbt":  # before they are held: about as many rows a task as the learner will take
        base = dealt(base, 5 * ROW_BYTES)
    if persist_input:  # the join and projections behind the features run once
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
    train_raw, test_raw = [h.select(*need) for h in halves] if halves else split(base, split_key, 0.7, seed)
    pm, _, train = fit_features(spec, train_raw, keep=list(targets))
    test = pm.transform(test_raw).select("features", *targets)
    if kind == "linear" and len(targets) == 1:  # read once: not worth holding
        train.unpersist()
    fitted = Fitted(pm)

    def fit_target(t):
        tr = train.withColumn("label", label_fn(F.col(t))) if label_fn else rename_target(train, t)
        if kind == "linear":
            m = train_linear(tr, reg_param=reg_param, solver=solver, tol=tol)
        elif kind == "gbt":
            m = train_gbt(tr, seed=seed)
        else:
            raise ValueError(kind)
        return t, m

    try:
        if test_raw.isEmpty():
            raise ValueError("the test half of the split is empty: nothing to evaluate on")
        # targets share the cached rows read-only; their fits are independent
        with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(targets)))) as pool:
            fitted.models = dict(pool.map(fit_target, targets))
        # metrics are computed now so the cached rows can be released
        labels = {t: label_fn(F.col(t)) if label_fn else F.col(t) for t in targets}
        fitted.report = _materialize(metrics_by_target(test, fitted.models, labels))
    finally:
        train.unpersist()
        if persist_input:
            base.unpersist()
    return fitted


def _materialize(df: DataFrame) -> DataFrame:
    """Evaluate a small report (a few rows) and keep it as a reliable checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def compare_feature_sets(featurized: DataFrame, target: str, specs: dict[str, FeatureSpec],
                         split_key: str | None = "video_id", reg_params: dict | None = None,
                         kind: str = "linear", parallel: int = 3, tol: float = 1e-6) -> DataFrame:
    """Same target and split under several feature encodings -> report.

    Encodings of the same categoricals share them: indexed and one-hot encoded once, on the
    same training rows as each would be, in one vector that every encoding takes behind its text.
    """
    def one(item):
        name, spec = item
        f = train_targets(featurized, [target], spec, split_key, kind=kind,
                          reg_param=(reg_params or {}).get(name, 0.0), persist_input=False, tol=tol)
        return f.report.withColumn("target", F.lit(name))

    # the encodings are independent fits on one shared, persisted input of the columns they read
    need = dict.fromkeys([*([split_key] if split_key else []), target,
                          *(c for s in specs.values() for c in (*s.categorical, *([s.tags_col] if s.text else [])))])
    featurized = featurized.select(*need)
    cats = {s.categorical for s in specs.values()}
    # a split by key halves the rows alike each time, a random one may not
    if len(cats) == 1 and len(specs) > 1 and all(cats) and split_key and not any(s.by_join for s in specs.values()):
        (cats,) = cats
        encoded = categorical_vectors(cats, split(featurized, split_key)[0], ENCODED)
        featurized = encoded.transform(featurized).select(*(c for c in need if c not in cats or c in (split_key, target)), ENCODED)
        specs = {name: s.with_(categorical=(), encoded=ENCODED) for name, s in specs.items()}
    shared = featurized = featurized.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(specs)))) as pool:
            rows = list(pool.map(one, specs.items()))
    finally:
        shared.unpersist()
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumnRenamed("target", "feature_set")


# ------------------------------------------------------------- job and I/O

def train_job(records: DataFrame, roles: Roles = Roles(), spec: FeatureSpec = FeatureSpec(),
              targets=PAIR_TARGETS, split_key: str | None = "video_id",
              region_col: str | None = "region", out_path: str | None = None,
              parallel_regions: int = 4, regions: list[str] | None = None, seed: int = 101,
              builder: dict | None = None, tol: float = 1e-6) -> dict:
    """Cleaned records -> features -> one split -> fit per region -> optional save.

    ``records`` are *all* cleaned rows (``clean_records``); each region's rows are
    split once, and its report holds the metrics of its test half (``split`` with
    the same key, fraction 0.7 and seed gives that half).  The featurized records
    are written once as Parquet partitioned by region under the shared checkpoint
    folder: each region's fit reads only its own partition, lineage to the joins
    is cut, and the copy is deleted after the fits.  Returns ``{region: Fitted}``
    for the configured ``regions`` (default: those that occur; rows without a
    region train no model), or ``{"ALL": Fitted}`` when ``region_col`` is None.
    """
    spark = records.sparkSession
    feats = build_features(records, roles, **(builder or {}))
    path = new_scratch_path(spark, "train-features")
    text = [spec.tags_col] if spec.text else []
    need = dict.fromkeys([*([split_key] if split_key else []), *spec.categorical, *text, *targets])
    region = F.lit("ALL") if region_col is None else F.col(region_col).cast("string")
    feats = feats.select(*need, region.alias("_region")).where(F.col("_region").isNotNull())
    if split_key:  # by key, the halves are the same wherever a row is
        feats = split_label(feats, split_key, 0.7, seed, out="_half")
    feats.write.partitionBy("_region", *(["_half"] if split_key else [])).parquet(path)
    landed = spark.read.schema(feats.schema).parquet(path)
    if region_col is None:
        regions = ["ALL"]
    elif regions is None:
        regions = [r[0] for r in landed.select("_region").distinct().orderBy("_region").collect()]
    parts = {r: landed.where(F.col("_region") == r) for r in regions}

    def fit_region(item):
        r, part = item
        halves = tuple(part.where(F.col("_half") == h) for h in ("train", "test")) if split_key else None
        fitted = train_targets(part, list(targets), spec, split_key, persist_input=False, seed=seed, tol=tol, halves=halves)
        if out_path:
            save_models(fitted, f"{out_path}/{r}")
        return r, fitted

    # Regional fits are independent; their (small, iterative) jobs are
    # submitted concurrently so the cluster is not idle between iterations.
    try:
        with ThreadPoolExecutor(max_workers=max(1, min(parallel_regions, len(parts)))) as pool:
            return dict(pool.map(fit_region, parts.items()))
    finally:
        remove_path(spark, path)


def job_report(fitted: dict) -> DataFrame:
    """A18 over a job: one row per (region, target, rmse, r2, n)."""
    frames = [f.report.select(F.lit(r).alias("region"), "*") for r, f in fitted.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def save_models(fitted: Fitted, path: str) -> None:
    """Overwrite-save the pipeline (or the encoder's tables) and one regression per target."""
    if isinstance(fitted.pipeline, JoinEncoder):
        fitted.pipeline.save(f"{path}/encoder")
    else:
        fitted.pipeline.write().overwrite().save(f"{path}/pipeline")
    for t, m in fitted.models.items():
        m.write().overwrite().save(f"{path}/model_{t}")


def load_models(path: str, targets=PAIR_TARGETS, by_join: bool = False) -> Fitted:
    """S11; ``by_join`` as in the ``FeatureSpec`` that the models were trained with."""
    pm = JoinEncoder(SparkSession.getActiveSession(), f"{path}/encoder") if by_join else PipelineModel.load(f"{path}/pipeline")
    return Fitted(pm, {t: LinearRegressionModel.load(f"{path}/model_{t}") for t in targets})


# ------------------------------------------------------------------ scoring

REQUEST_ROLES = Roles(title="title", tags="tags", category="categoryId",
                      published="publish_ts", channel="channel_title")


def prepare_requests(requests: DataFrame, regions: list[str], categories: DataFrame, regional: bool = True,
                     order_col: str | None = None, builder: dict | None = None) -> DataFrame:
    """Featurized requests with ``error`` (why there is no prediction) and ``_part`` (the
    region whose models apply, NULL with an error).

    Row by row but for the join with the category names, so it holds for a
    stream of requests too: the join then is one of a stream with a table,
    which keeps no state.
    """
    req = lookup_category_id(requests, categories, order_col=order_col)
    req = req.withColumn("publish_ts", parse_publish_time("publish_dt"))
    region = F.col("region").cast("string") if regional else F.lit(regions[0] if regions else None).cast("string")
    known = region.isin(regions) if regions else F.lit(False)
    req = req.withColumn("error", F.coalesce(
        F.col("error"),
        F.when(F.col("publish_ts").isNull(), F.lit("bad publish_dt")),
        F.when(~F.coalesce(known, F.lit(False)), F.concat(F.lit("no model for region "), F.coalesce(region, F.lit("NULL"))))))
    return build_features(req, REQUEST_ROLES, **(builder or {})).withColumn(
        "_part", F.when(F.col("error").isNull(), region))


def apply_models(prepared: DataFrame, models: dict, targets, id_col: str) -> DataFrame:
    """Predictions of each region's models for its own requests, and the rows without any.

    One branch a region: meant for tens of regions, not for thousands.
    """
    nothing = [F.lit(None).cast("double").alias(f"pred_{t}") for t in targets]
    out = prepared.where(F.col("_part").isNull()).select(id_col, "region", *nothing, "error")
    for r, fitted in models.items():
        scored = fitted.pipeline.transform(prepared.where(F.col("_part") == r))
        for t in targets:
            m = fitted.models[t].copy()
            m.setPredictionCol(f"pred_{t}")
            scored = m.transform(scored)
        out = out.unionByName(scored.select(id_col, "region", *[f"pred_{t}" for t in targets], "error"))
    return out


def score(requests: DataFrame, models: dict, categories: DataFrame,
          targets=PAIR_TARGETS, id_col: str = "request_id", regional: bool = True,
          order_col: str | None = None, builder: dict | None = None) -> DataFrame:
    """One row per request: the predictions of its region's models, or a reason.

    Category names are resolved by join (J2; of equal titles the last in
    ``order_col``).  An unknown category, a malformed time, or a region that is
    NULL or has no model gives NULL predictions and ``error``; no request is lost
    or doubled.  The featurized requests are written once, partitioned by region,
    so each region's models read their own partition only.  ``regional=False``
    applies the one model of a job without regions to every request.
    """
    spark = requests.sparkSession
    path = new_scratch_path(spark, "score-features")
    inputs = dict.fromkeys([id_col, "region", *CATEGORICAL, "tag_array_lower", "error"])
    feats = prepare_requests(requests, list(models), categories, regional, order_col, builder).select(*inputs, "_part")
    feats.write.partitionBy("_part").parquet(path)
    landed = spark.read.schema(feats.schema).parquet(path)
    return apply_models(landed, models, targets, id_col)


def score_stream(requests: DataFrame, models: dict, categories: DataFrame,
                 targets=PAIR_TARGETS, id_col: str = "request_id", regional: bool = True,
                 order_col: str | None = None, builder: dict | None = None) -> DataFrame:
    """M15 on a stream: the rows of ``score`` for requests as they arrive.

    ``categories`` is a table: a micro-batch joins its requests with what the
    table holds then.  No state is kept, so the result can be appended to files
    (``start_append``); each request of a micro-batch goes through its
    region's branch.  Models whose encoder joins vocabularies (``by_join``)
    gather rows and so can't run on a stream.
    """
    if any(getattr(f.pipeline, "gathers", False) for f in models.values()):
        raise ValueError("models encoded by joins score tables, not streams")
    return apply_models(prepare_requests(requests, list(models), categories, regional, order_col, builder), models, targets, id_col)
