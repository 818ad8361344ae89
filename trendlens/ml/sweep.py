"""Encodings and regularisation compared by cross-validation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sampling import key_fraction
from .features import FeatureSpec, feature_pipeline
from .models import _materialize, rmse_r2


def fold_of(key: str, folds: int, seed: int):
    """The fold of a key, 0 to ``folds - 1``: the same whatever the partitioning, and one for all
    rows of a key, so no video is on both sides."""
    return F.least(F.floor(key_fraction(key, seed) * folds), F.lit(folds - 1)).cast("int")


def sweep(featurized: DataFrame, target: str, specs: dict[str, FeatureSpec], reg_params: list[float],
          split_key: str = "video_id", folds: int = 3, seed: int = 101, parallel: int = 4,
          max_iter: int = 100, tol: float = 1e-6) -> tuple[DataFrame, dict]:
    """``(feature_set, reg_param, fold, rmse, r2, n)`` of every setting on every fold, and the best setting.

    ``CrossValidator`` fits all settings of the grid (the encoding is a parameter of
    the pipeline: its stages) on the other folds, several at a time.  Features are
    fitted on the training folds only.  The best setting has the least mean RMSE;
    rows without the target are left out.
    """
    text = [s.tags_col for s in specs.values() if s.text]
    need = dict.fromkeys([target, *text, *(c for s in specs.values() for c in s.categorical)])
    rows = featurized.where(F.col(target).isNotNull()).select(
        *need, F.col(target).cast("double").alias("label"), fold_of(split_key, folds, seed).alias("fold")).persist()
    lr = LinearRegression(maxIter=max_iter, tol=tol)
    stages = {name: [*feature_pipeline(spec).getStages(), lr] for name, spec in specs.items()}
    pipe = Pipeline(stages=next(iter(stages.values())))
    grid = ParamGridBuilder().addGrid(pipe.stages, list(stages.values())).addGrid(lr.regParam, list(reg_params)).build()
    names = [(next(n for n, s in stages.items() if s is m[pipe.stages]), m[lr.regParam]) for m in grid]
    try:
        done = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=RegressionEvaluator(), numFolds=folds, foldCol="fold",
                              parallelism=parallel, collectSubModels=True).fit(rows)
        reports = [rmse_r2(done.subModels[f][i].transform(rows.where(F.col("fold") == f))).select(
            F.lit(reg).alias("reg_param"), F.lit(f).alias("fold"), "*").withColumn("feature_set", F.lit(name))
            for i, (name, reg) in enumerate(names) for f in range(folds)]
        out = reports[0]
        for r in reports[1:]:
            out = out.unionByName(r)
        report = _materialize(out.select("feature_set", "reg_param", "fold", "rmse", "r2", "n"))
    finally:
        rows.unpersist()
    best = min(range(len(names)), key=lambda i: done.avgMetrics[i])
    return report, {"feature_set": names[best][0], "reg_param": names[best][1], "rmse": done.avgMetrics[best]}


__all__ = ["fold_of", "sweep"]
