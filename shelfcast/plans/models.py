"""Model pipelines, training record and feature importance.

Tree learners are Spark ML's: trees are grown level by level over the
partitioned data, so only split statistics move, never the rows. Features
are plain doubles (no nominal metadata), so label codes are treated as
ordered numbers, as the reference's encoder does.
"""

from __future__ import annotations

import inspect
import math
import time
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.evaluation import regression_metrics
from shelfcast.plans import ensembles as EN
from shelfcast.plans.features import FEATURES, FeatureEngineer, MedianImputer
from shelfcast.session import ensure_checkpoint_dir, written

LABEL = "sales"
MAX_DEPTH = 30
CACHED_DEPTH = 10  # from here on it pays to keep every row's node in every tree; below, rows walk down again and no node ids go to disk
ROWS_PER_TASK = 500_000  # training rows of Spark ML's learners in one task: they are read again for every level of every tree


def feature_stages(features: list[str] = FEATURES) -> list:
    """fe -> median imputer -> assembler -> standard scaler (fitted on the training rows only)."""
    imputed = [f"{c}__imp" for c in features]
    return [
        FeatureEngineer(keepColumns=["date"]),
        MedianImputer(inputCols=features, outputCols=imputed),
        VectorAssembler(inputCols=imputed, outputCol="raw_features", handleInvalid="keep"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]


def rf_pipeline(num_trees: int = 400, max_depth: int = 25, seed: int = 42, max_bins: int = 64,
                label: str = LABEL) -> Pipeline:
    """M1: random forest, half of the features per split, one row per leaf minimum.

    Spark trees are at most 30 levels deep: a larger ``max_depth`` is an error."""
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth {max_depth} is more than Spark's limit of {MAX_DEPTH}")
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                               maxDepth=max_depth, featureSubsetStrategy="0.5",
                               minInstancesPerNode=1, seed=seed, maxBins=max_bins,
                               maxMemoryInMB=1024, cacheNodeIds=max_depth >= CACHED_DEPTH, checkpointInterval=10)
    return Pipeline(stages=feature_stages() + [rf])


def gbt_pipeline(max_iter: int = 500, step_size: float = 0.03, max_depth: int = 8, seed: int = 42,
                 max_bins: int = 64, label: str = LABEL) -> Pipeline:
    """M2: gradient-boosted trees, 80 % row subsample, 70 % of the features per split."""
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth {max_depth} is more than Spark's limit of {MAX_DEPTH}")
    gbt = GBTRegressor(featuresCol="features", labelCol=label, maxIter=max_iter, stepSize=step_size,
                       maxDepth=max_depth, subsamplingRate=0.8, featureSubsetStrategy="0.7",
                       minInstancesPerNode=2, seed=seed, maxBins=max_bins, maxMemoryInMB=512,
                       cacheNodeIds=max_depth >= CACHED_DEPTH, checkpointInterval=10)
    return Pipeline(stages=feature_stages() + [gbt])


def predictions(model: PipelineModel, df: DataFrame, label: str = LABEL) -> DataFrame:
    keep = [c for c in ("id", "store", "date", label) if c in df.columns]
    return model.transform(df).select(*keep, F.col("prediction").alias("p"))


def prepare_features(train: DataFrame, label: str = LABEL) -> tuple[PipelineModel, DataFrame]:
    """The fitted feature stages and the training rows' (features, label), written once for all models."""
    fitted = Pipeline(stages=feature_stages()).fit(train)
    return fitted, written(fitted.transform(train).select("features", label), "train-features")


def dealt(rows: DataFrame) -> DataFrame:
    """Training rows in as many parts as their number asks for; files alone would bring as many as there are cores."""
    tasks = math.ceil(rows.count() / ROWS_PER_TASK)
    return rows.repartition(tasks) if tasks > rows.sparkSession.sparkContext.defaultParallelism else rows


def fit_and_record(pipeline: Pipeline, name: str, train: DataFrame, val: DataFrame,
                   params: dict | None = None, run_store=None, parent_id: str | None = None,
                   label: str = LABEL, prepared: tuple[PipelineModel, DataFrame] | None = None):
    """M5: fit on train, score validation, compute M4 and append one run row.

    ``prepared`` (from :func:`prepare_features`) shares the feature stages between models.
    Returns (model, validation predictions (y, p), metrics dict).
    """
    ensure_checkpoint_dir(train.sparkSession)
    started = time.time()
    features, rows = prepared or prepare_features(train, label)
    model = PipelineModel(features.stages + [pipeline.getStages()[-1].fit(dealt(rows))])
    pred = written(predictions(model, val, label).withColumnRenamed(label, "y"), "predictions")
    m = regression_metrics(pred, "y", "p").first().asDict()
    metrics = {"RMSE": m["rmse"], "MAE": m["mae"], "MAPE": m["mape"], "RMSPE": m["rmspe"], "R2": m["r2"]}
    if run_store is not None:
        stage = model.stages[-1]
        real = {k.name: str(v) for k, v in stage.extractParamMap().items()
                if k.name in ("numTrees", "maxDepth", "maxIter", "stepSize", "subsamplingRate",
                              "featureSubsetStrategy", "minInstancesPerNode", "seed")}
        real.update({k: str(v) for k, v in (params or {}).items()})
        real.update({"model_type": name, "training_rows": str(rows.count()),
                     "validation_rows": str(m["rows"])})
        run_store.log_run(name=name, params=real, metrics=metrics, parent_id=parent_id,
                          run_id=uuid.uuid4().hex, start_ts=started)
    return model, pred, metrics


def fit_ensemble_and_record(kind: str, name: str, features: PipelineModel, rows: DataFrame, train_rows: int, val: DataFrame,
                            params: dict, run_store=None, parent_id: str | None = None, label: str = LABEL):
    """M5 for the models of :mod:`shelfcast.plans.ensembles` (``kind`` rf or gbt, ``rows`` as of ``training_rows``).

    Returns as :func:`fit_and_record`."""
    started = time.time()
    fit = EN.fit_forest if kind == "rf" else EN.fit_boosting
    model = EN.EnsembleModel(features, fit(rows, **params), name)
    pred = written(predictions(model, val, label).withColumnRenamed(label, "y"), "predictions")
    m = regression_metrics(pred, "y", "p").first().asDict()
    metrics = {"RMSE": m["rmse"], "MAE": m["mae"], "MAPE": m["mape"], "RMSPE": m["rmspe"], "R2": m["r2"]}
    if run_store is not None:
        real = {k: str(v.default) for k, v in inspect.signature(fit).parameters.items() if v.default not in (inspect.Parameter.empty, None)}
        real.update({k: str(v) for k, v in params.items()})
        real.update({"model_type": name, "training_rows": str(train_rows), "validation_rows": str(m["rows"])})
        run_store.log_run(name=name, params=real, metrics=metrics, parent_id=parent_id, run_id=uuid.uuid4().hex, start_ts=started)
    return model, pred, metrics


def feature_importance(model: PipelineModel, spark: SparkSession | None = None, top_n: int | None = 20,
                       features: list[str] = FEATURES) -> DataFrame:
    """M7: importances of the final tree stage by feature name, highest first, top ``top_n``."""
    if isinstance(model, EN.EnsembleModel):
        return EN.importances(model.trees, features, top_n)
    stage = model.stages[-1]
    imps = stage.featureImportances.toArray().tolist()
    spark = spark or SparkSession.getActiveSession()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imps)], "feature string, importance double")
    df = df.orderBy(F.desc("importance"), F.asc("feature"))
    return df.limit(top_n) if top_n else df
