"""The batch training run (E1): prepare -> sample -> split -> fit two models -> choose ->
analyse -> persist -> score the horizon -> per-store lag forecast.

The open panel is written once to shared storage; the feature stages are fitted once and their
output written for both models; everything else is aggregates over the written
validation predictions or the written panel.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.operators import eda as EDA
from shelfcast.operators import evaluation as EV
from shelfcast.operators import sampling as SP
from shelfcast.operators.clean import clean, open_days, prepare, row_weighted_median
from shelfcast.operators.joins import with_store
from shelfcast.operators.scoring import submission, submission_summary
from shelfcast.operators.timeseries import lag_forecast
from shelfcast.plans.ensembles import training_rows
from shelfcast.plans.models import (LABEL, feature_importance, fit_and_record, fit_ensemble_and_record, gbt_pipeline,
                                    prepare_features, rf_pipeline)
from shelfcast.session import written


@dataclass
class TrainingConfig:
    """``engine``: "ensemble" (plans/ensembles.py, any size) or "mllib" (Spark ML, all nodes on the driver)."""

    engine: str = "ensemble"
    sample_fraction: float = 1.0
    validation_weeks: int = 6
    rf: dict = field(default_factory=lambda: {"num_trees": 400, "max_depth": 25, "seed": 42})
    gbt: dict = field(default_factory=lambda: {"max_iter": 500, "step_size": 0.03, "max_depth": 8, "seed": 42})
    top_features: int = 20
    band_rows: int = 150
    run_lag_forecast: bool = True


@dataclass
class TrainingResult:
    best_name: str
    best_model: PipelineModel
    metrics: dict
    importances: DataFrame
    coverage: DataFrame
    validation: DataFrame
    submission: DataFrame
    submission_summary: DataFrame
    lag_metrics: DataFrame | None
    residual_hist: DataFrame
    normal_curve: DataFrame
    qq_points: DataFrame
    eda: dict[str, DataFrame]


def train_and_compare(fact: DataFrame, store: DataFrame, horizon: DataFrame,
                      config: TrainingConfig | None = None, run_store=None,
                      model_store=None) -> TrainingResult:
    cfg = config or TrainingConfig()
    panel = written(prepare(fact, store)[0], "panel")
    open_panel = open_days(panel)
    data = open_panel.drop("customers")
    if cfg.sample_fraction < 1.0:
        data = SP.sample_fraction(data, cfg.sample_fraction)
    train, val = SP.time_split(data, cfg.validation_weeks)
    prepared = prepare_features(train)
    parent = uuid.uuid4().hex if run_store is not None else None

    if cfg.engine == "mllib":
        rf_model, rf_pred, rf_m = fit_and_record(rf_pipeline(**cfg.rf), "RandomForest", train, val,
                                                 cfg.rf, run_store, parent, prepared=prepared)
        gbt_model, gbt_pred, gbt_m = fit_and_record(gbt_pipeline(**cfg.gbt), "GradientBoosting", train, val,
                                                    cfg.gbt, run_store, parent, prepared=prepared)
    else:
        features, rows = prepared[0], training_rows(prepared[1], LABEL)
        n = rows.count()
        rf_model, rf_pred, rf_m = fit_ensemble_and_record("rf", "RandomForest", features, rows, n, val, cfg.rf, run_store, parent)
        gbt_model, gbt_pred, gbt_m = fit_ensemble_and_record("gbt", "GradientBoosting", features, rows, n, val, cfg.gbt, run_store, parent)
    # M6: strict "<" on RMSPE, so a tie goes to gradient boosting.
    if rf_m["RMSPE"] < gbt_m["RMSPE"]:
        best_name, best, pred, best_m = "RandomForest", rf_model, rf_pred, rf_m
    else:
        best_name, best, pred, best_m = "GradientBoosting", gbt_model, gbt_pred, gbt_m

    imps = feature_importance(best, data.sparkSession, cfg.top_features)
    cov = EV.coverage(pred, order=["store", "date"], n=cfg.band_rows)
    test_panel = clean(with_store(horizon, store), row_weighted_median(horizon, store))
    sub = submission(best, test_panel)
    if model_store is not None:
        model_store.save(best, best_name)
    lag_metrics = written(lag_forecast(panel)[1], "lag-metrics") if cfg.run_lag_forecast else None
    if run_store is not None:
        if lag_metrics is not None:
            w = lag_metrics.agg(F.sum("test_windows").alias("n"), F.count(F.lit(1)).alias("stores"),
                                F.sum(F.col("rmse") * F.col("rmse") * F.col("test_windows")).alias("sse"),
                                F.sum(F.col("mae") * F.col("test_windows")).alias("sae")).first()
            if w["n"]:
                run_store.log_run("LagForecast", {"model_type": "LagForecast", "stores": w["stores"], "test_windows": w["n"]},
                                  {"RMSE": (w["sse"] / w["n"]) ** 0.5, "MAE": w["sae"] / w["n"]}, parent)
        run_store.log_run("session", {"sample_fraction": cfg.sample_fraction,
                                      "split_strategy": f"time_based_last_{cfg.validation_weeks}_weeks",
                                      "winning_model": best_name},
                          {"best_RMSPE": best_m["RMSPE"], "best_R2": best_m["R2"]}, run_id=parent)
    return TrainingResult(best_name, best, {"RandomForest": rf_m, "GradientBoosting": gbt_m, "best": best_m},
                          imps, cov, pred, sub, submission_summary(sub), lag_metrics,
                          EV.residual_hist(pred), EV.normal_curve(pred), EV.qq_points(pred), eda_tables(open_panel))


def eda_tables(open_panel: DataFrame) -> dict[str, DataFrame]:
    """The run's exploratory tables (one aggregate each over the written panel)."""
    return {"daily_mean": EDA.daily_mean_sales(open_panel), "promo_lift": EDA.promo_lift(open_panel),
            "monthly_mean": EDA.monthly_mean(open_panel), "weekday_mean": EDA.weekday_mean(open_panel),
            "store_type_mean": EDA.store_type_mean(open_panel), "assortment_mean": EDA.assortment_mean(open_panel),
            "distance_band_mean": EDA.distance_band_mean(open_panel), "corr_matrix": EDA.corr_matrix(open_panel),
            "spend_medians": EDA.spend_medians(open_panel), "spend_histogram": EDA.spend_histogram(open_panel)}


def run_from_csv(spark, data_dir: str, out_dir: str, config: TrainingConfig | None = None):
    """E1 end to end from the three CSV inputs: read (S1/S2) -> train and compare ->
    write the submission (S5), the metrics record (S8), the best model (S9) and the run log
    (S11) under ``out_dir``. Returns the TrainingResult."""
    from shelfcast.sources.csv_io import read_raw, write_metrics_json, write_submission
    from shelfcast.sources.runs import ModelStore, RunStore
    fact, store, horizon = read_raw(spark, data_dir)
    out = out_dir.rstrip("/")
    runs, models = RunStore(spark, f"{out}/runs"), ModelStore(spark, out)
    res = train_and_compare(fact, store, horizon, config, runs, models)
    write_submission(res.submission, f"{out}/submission")
    write_metrics_json(spark, res.best_name,
                       {k: v for k, v in res.metrics.items() if k != "best"}, f"{out}/metrics")
    return res


def score_upload_file(spark, model_dir: str, store_csv: str, upload_csv: str, out_dir: str):
    """The batch page (M17) from files: latest saved model, store CSV, uploaded CSV
    -> predictions (S7) plus the summary (G19) and a 60-bin histogram (G16)."""
    from shelfcast.operators.scoring import batch_histogram, batch_score, batch_summary
    from shelfcast.sources.csv_io import STORE_SCHEMA, read_csv, read_upload, write_batch
    from shelfcast.sources.runs import ModelStore
    model, _ = ModelStore(spark, model_dir).load_latest()
    if model is None:
        raise FileNotFoundError(f"no trained model under {model_dir}")
    store = read_csv(spark, store_csv, STORE_SCHEMA)
    scored = batch_score(model, read_upload(spark, upload_csv), store)
    write_batch(scored, out_dir)
    return batch_summary(scored), batch_histogram(scored, 60)
