"""CSV sources and sinks, run and model stores, and the streaming upload scorer."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


def _write_reference_csvs(spark, d):
    from shelfcast.sources.fixture import load_panel
    p = load_panel(spark, SF_SMALL)
    fact = p.fact.select(F.col("store").alias("Store"), F.col("day_of_week").alias("DayOfWeek"),
                         F.col("date").alias("Date"), F.col("sales").alias("Sales"),
                         F.col("customers").alias("Customers"), F.col("open").alias("Open"),
                         F.col("promo").alias("Promo"), F.col("state_holiday").alias("StateHoliday"),
                         F.col("school_holiday").alias("SchoolHoliday"))
    store = p.store.toDF("Store", "StoreType", "Assortment", "CompetitionDistance", "CompetitionOpenSinceMonth",
                         "CompetitionOpenSinceYear", "Promo2", "Promo2SinceWeek", "Promo2SinceYear",
                         "PromoInterval")
    test = p.horizon.toDF("Id", "Store", "Date", "DayOfWeek", "Open", "Promo", "StateHoliday", "SchoolHoliday") \
        .select("Id", "Store", "DayOfWeek", "Date", "Open", "Promo", "StateHoliday", "SchoolHoliday")
    for name, df in (("train", fact), ("store", store), ("test", test)):
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{d}/{name}.csv")
    return p


def test_read_raw_roundtrip(spark, tmp_dir):
    from shelfcast.sources.csv_io import read_raw
    p = _write_reference_csvs(spark, tmp_dir)
    train, store, test = read_raw(spark, tmp_dir)
    assert train.count() == p.fact.count() and store.count() == p.store.count() and test.count() == p.horizon.count()
    assert "promo2_since_week" in store.columns and dict(train.dtypes)["date"] == "date"
    assert train.agg(F.sum("sales")).first()[0] == pytest.approx(p.fact.agg(F.sum("sales")).first()[0])


def test_missing_input_fails_early(spark, tmp_dir):
    from shelfcast.sources.csv_io import read_raw
    with pytest.raises(FileNotFoundError):
        read_raw(spark, f"{tmp_dir}/nothing-here")


def test_run_store_latest(spark, tmp_dir):
    from shelfcast.sources.runs import RunStore, latest_runs
    rs = RunStore(spark, f"{tmp_dir}/runs")
    for i in range(20):
        rs.log_run(f"r{i}", {"model_type": "RandomForest"}, {"RMSPE": 10.0 + i, "R2": 0.5}, start_ts=1_700_000_000 + i)
    out = latest_runs(rs.runs()).collect()
    assert len(out) == 15 and out[0]["name"] == "r19" and out[0]["rmspe"] == "29.00%" and out[0]["r2"] == "0.5000"


def test_training_scoring_and_stores(spark, tmp_dir):
    from shelfcast.operators.scoring import batch_score
    from shelfcast.plans.training import TrainingConfig, train_and_compare
    from shelfcast.sources.csv_io import write_submission
    from shelfcast.sources.fixture import load_panel
    from shelfcast.sources.runs import ModelStore, RunStore
    p = load_panel(spark, SF_SMALL)
    cfg = TrainingConfig(rf={"num_trees": 5, "max_depth": 4}, gbt={"max_iter": 3, "max_depth": 3},
                         run_lag_forecast=True)
    rs, ms = RunStore(spark, f"{tmp_dir}/runs"), ModelStore(spark, f"{tmp_dir}/models")
    res = train_and_compare(p.fact, p.store, p.horizon, cfg, rs, ms)
    assert res.best_name in ("RandomForest", "GradientBoosting")
    assert set(res.metrics["best"]) == {"RMSE", "MAE", "MAPE", "RMSPE", "R2"}
    sub = res.submission
    assert sub.count() == p.horizon.count() and sub.where("sales < 0").count() == 0
    write_submission(sub, f"{tmp_dir}/submission")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/submission").count() == p.horizon.count()
    assert sorted(r["name"] for r in rs.runs().collect()) == ["GradientBoosting", "LagForecast", "RandomForest", "session"]
    assert res.residual_hist.count() == 70 and res.normal_curve.count() == 200
    assert res.qq_points.count() == res.validation.count() and res.lag_metrics.count() > 0
    assert set(res.eda) >= {"daily_mean", "promo_lift", "corr_matrix", "spend_medians"}
    assert all(df.count() > 0 for df in res.eda.values())
    model, path = ms.load_latest()
    assert model is not None and res.best_name.replace(" ", "_") in path

    # streaming form of batch scoring gives the batch result
    up = f"{tmp_dir}/uploads"
    test = p.horizon.toDF("Id", "Store", "Date", "DayOfWeek", "Open", "Promo", "StateHoliday", "SchoolHoliday") \
        .select("Id", "Store", "DayOfWeek", "Date", "Open", "Promo", "StateHoliday", "SchoolHoliday")
    test.coalesce(2).write.mode("overwrite").option("header", True).csv(up)
    from shelfcast.streaming.upload_scoring import start_upload_scoring
    q = start_upload_scoring(spark, model, p.store, up, f"{tmp_dir}/scored", f"{tmp_dir}/ckpt", available_now=True)
    q.awaitTermination(300)
    streamed = spark.read.parquet(f"{tmp_dir}/scored")
    batch = batch_score(model, p.horizon, p.store)
    assert sorted(streamed.select("id", "predicted_sales").collect()) == \
        sorted(batch.select("id", "predicted_sales").collect())


def test_sinks(spark, tmp_dir):
    import json
    import glob
    from shelfcast.sources.csv_io import write_batch, write_forecast, write_metrics_json
    daily = spark.createDataFrame([(dt.date(2015, 9, 1), 7, 1, 12.5), (dt.date(2015, 9, 6), 7, 0, 0.0)],
                                  "date date, store long, open int, predicted_sales double")
    write_forecast(daily, f"{tmp_dir}/fc")
    back = spark.read.option("header", True).csv(f"{tmp_dir}/fc")
    assert back.columns == ["Date", "Store", "Open", "Predicted_Sales"] and back.count() == 2
    write_batch(daily.withColumn("id", F.lit(3)), f"{tmp_dir}/batch")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/batch").columns[0] == "Id"
    m = {"RandomForest": {"RMSE": 1.0, "MAE": 2.0, "MAPE": 3.0, "RMSPE": 4.0, "R2": 0.5},
         "GradientBoosting": {"RMSE": 2.0, "MAE": 3.0, "MAPE": 4.0, "RMSPE": 5.0, "R2": 0.4}}
    write_metrics_json(spark, "RandomForest", m, f"{tmp_dir}/metrics")
    rec = json.loads(open(glob.glob(f"{tmp_dir}/metrics/part-*.json")[0]).readline())
    assert rec["best_model"] == "RandomForest" and rec["best"]["RMSPE"] == 4.0
    assert rec["GradientBoosting"]["R2"] == 0.4


def test_upload_requires_columns(spark, tmp_dir):
    from shelfcast.sources.csv_io import read_upload
    spark.createDataFrame([(1, 2)], "Store int, Open int").write.mode("overwrite").option("header", True) \
        .csv(f"{tmp_dir}/up")
    with pytest.raises(ValueError, match="Date"):
        read_upload(spark, f"{tmp_dir}/up")
    spark.createDataFrame([(1, "2015-09-01", "1", "x")], "Store int, Date string, Open string, Note string") \
        .write.mode("overwrite").option("header", True).csv(f"{tmp_dir}/up2")
    up = read_upload(spark, f"{tmp_dir}/up2")
    assert dict(up.dtypes) == {"store": "int", "date": "date", "open": "int", "note": "string"}


def test_run_from_csv_and_score_upload(spark, tmp_dir):
    from shelfcast.plans.training import TrainingConfig, run_from_csv, score_upload_file
    p = _write_reference_csvs(spark, tmp_dir)
    cfg = TrainingConfig(rf={"num_trees": 3, "max_depth": 3}, gbt={"max_iter": 2, "max_depth": 2},
                         run_lag_forecast=False)
    res = run_from_csv(spark, tmp_dir, f"{tmp_dir}/out", cfg)
    sub = spark.read.option("header", True).csv(f"{tmp_dir}/out/submission")
    assert sub.columns == ["Id", "Sales"] and sub.count() == p.horizon.count()
    assert spark.read.json(f"{tmp_dir}/out/metrics").first()["best_model"] == res.best_name
    summary, hist = score_upload_file(spark, f"{tmp_dir}/out", f"{tmp_dir}/store.csv", f"{tmp_dir}/test.csv",
                                      f"{tmp_dir}/scored")
    assert summary.first()["rows"] == p.horizon.count()
    assert hist.agg(F.sum("count")).first()[0] == p.horizon.count()


def _csv(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_csv_columns_are_bound_by_name(spark, tmp_dir):
    from shelfcast.sources.csv_io import HORIZON_SCHEMA, read_csv, read_upload
    _csv(f"{tmp_dir}/a", "x.csv", "Id,DayOfWeek,Store,Extra,Date,Promo,Open,SchoolHoliday,StateHoliday\n7,6,3,q,2015-09-01,1,,0,0\n")
    r = read_csv(spark, f"{tmp_dir}/a/x.csv", HORIZON_SCHEMA).first()
    assert (r["id"], r["store"], r["day_of_week"], r["open"], r["promo"]) == (7, 3, 6, None, 1) and "extra" not in r
    assert read_upload(spark, f"{tmp_dir}/a/x.csv").first()["extra"] == "q"
    _csv(f"{tmp_dir}/b", "x.csv", "Id,Store,Date\n1,2,2015-09-01\n")
    with pytest.raises(ValueError, match="DayOfWeek"):
        read_csv(spark, f"{tmp_dir}/b/x.csv", HORIZON_SCHEMA)
    _csv(f"{tmp_dir}/c", "x.csv", "Store,Date\nthree,2015-09-01\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_upload(spark, f"{tmp_dir}/c/x.csv").collect()
    _csv(f"{tmp_dir}/a", "y.csv", "Store,Id,DayOfWeek,Extra,Date,Promo,Open,SchoolHoliday,StateHoliday\n7,6,3,q,2015-09-01,1,,0,0\n")
    with pytest.raises(Exception):  # files of one folder must agree: never swapped silently
        read_csv(spark, f"{tmp_dir}/a", HORIZON_SCHEMA).collect()


RESTART = """
import sys
sys.path.insert(0, sys.argv[1])
from shelfcast.session import get_spark
from shelfcast.operators.evaluation import StoreMeanModel
from shelfcast.streaming.upload_scoring import start_upload_scoring
spark = get_spark("restart", master="local[2]", shuffle_partitions=2)
store = spark.createDataFrame([(s, "a", "a", 1.0, 1, 2000, 0, 0, 0, "") for s in (1, 2)],
    "store int, store_type string, assortment string, competition_distance double, competition_open_since_month int, "
    "competition_open_since_year int, promo2 int, promo2_since_week int, promo2_since_year int, promo_interval string")
model = StoreMeanModel(spark.createDataFrame([(1, 10.0), (2, 20.0)], "store int, sales double"))
start_upload_scoring(spark, model, store, sys.argv[2] + "/in", sys.argv[2] + "/out", available_now=True).awaitTermination(200)
"""


def test_stream_restart_neither_drops_nor_repeats(spark, tmp_dir):
    """Two runs, each with a Spark application of its own; columns in another order in the second file."""
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

    def run():
        done = subprocess.run([sys.executable, "-c", RESTART, repo, tmp_dir], capture_output=True, text=True, timeout=240)
        return done.returncode, done.stderr[-2000:]
    _csv(f"{tmp_dir}/in", "one.csv", "Id,Store,Date,Open\n1,1,2015-09-01,1\n2,2,2015-09-01,0\n")
    assert run()[0] == 0
    _csv(f"{tmp_dir}/in", "two.csv", "Date,Open,Note,Store,Id\n2015-09-02,1,n,2,3\n")
    assert run()[0] == 0 and run()[0] == 0
    got = sorted((r["id"], r["store"], r["predicted_sales"]) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == [(1, 1, 10.0), (2, 2, 0.0), (3, 2, 20.0)]
    _csv(f"{tmp_dir}/in", "bad.csv", "Date,Store\n2015-09-02,two\n")
    assert run()[0] != 0  # a value that does not parse fails the batch; nothing of it is scored
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 3


def test_model_store_without_models_and_with_broken_entry(spark, tmp_dir):
    from shelfcast.sources.runs import ModelStore
    assert ModelStore(spark, f"{tmp_dir}/none").load_latest() == (None, None)
    _csv(f"{tmp_dir}/broken/models/m/entry", "part-0.parquet", "not parquet")
    with pytest.raises(Exception):
        ModelStore(spark, f"{tmp_dir}/broken").load_latest()
