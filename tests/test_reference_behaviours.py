"""The reference's own smoke tests, re-stated for the Spark library, plus the
hand-computed feature table for its three-row frame."""

import datetime as dt
import math

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F


def _metrics(spark, y, p):
    from shelfcast.operators.evaluation import regression_metrics
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    return regression_metrics(df).first().asDict()


def test_imports():
    from shelfcast.operators.evaluation import regression_metrics, rmspe  # noqa: F401
    from shelfcast.plans.features import FeatureEngineer
    from shelfcast.plans.models import gbt_pipeline, rf_pipeline  # noqa: F401
    assert FeatureEngineer is not None


def test_rmspe_perfect(spark):
    assert _metrics(spark, [100, 200, 300], [100, 200, 300])["rmspe"] == 0.0


def test_rmspe_handles_zeros(spark):
    r = _metrics(spark, [100, 0, 300], [110, 50, 310])["rmspe"]
    assert r > 0 and not math.isnan(r) and not math.isinf(r)
    # only the two non-zero actuals count: sqrt(mean(0.1^2, (10/300)^2)) * 100
    assert r == pytest.approx(math.sqrt((0.01 + (10 / 300) ** 2) / 2) * 100)


def test_evaluate_returns_all_5_metrics(spark):
    m = _metrics(spark, [100, 200, 300, 400, 500], [110, 190, 310, 390, 510])
    assert {"rmse", "mae", "mape", "rmspe", "r2"} <= set(m)
    for k in ("rmse", "mae", "mape", "rmspe", "r2"):
        assert isinstance(m[k], float)
    assert m["rmse"] == pytest.approx(10.0) and m["mae"] == pytest.approx(10.0)
    assert m["r2"] == pytest.approx(1 - 500 / 100000)


def test_pipelines_are_spark_pipelines():
    from shelfcast.plans.models import gbt_pipeline, rf_pipeline
    assert isinstance(rf_pipeline(), Pipeline)
    assert isinstance(gbt_pipeline(), Pipeline)
    rf = rf_pipeline().getStages()[-1]
    assert rf.getNumTrees() == 400 and rf.getMaxDepth() == 25 and rf.getFeatureSubsetStrategy() == "0.5"
    gbt = gbt_pipeline().getStages()[-1]
    assert gbt.getMaxIter() == 500 and gbt.getStepSize() == 0.03 and gbt.getSubsamplingRate() == 0.8


THREE_ROWS = [
    (1, dt.date(2015, 1, 1), 3, 1, 1, "None", 0, "a", "a", 1000.0, 3, 2010, 0, 0, 0, ""),
    (2, dt.date(2015, 6, 15), 0, 1, 0, "None", 0, "b", "b", 2000.0, 6, 2012, 1, 10, 2014, "Jan,Apr,Jul,Oct"),
    (3, dt.date(2015, 12, 25), 4, 1, 1, "c", 0, "c", "c", 500.0, 9, 2014, 1, 20, 2014, "Feb,May,Aug,Nov"),
]
THREE_SCHEMA = ("store long, date date, day_of_week int, open int, promo int, state_holiday string, "
                "school_holiday int, store_type string, assortment string, competition_distance double, "
                "competition_open_since_month int, competition_open_since_year int, promo2 int, "
                "promo2_since_week int, promo2_since_year int, promo_interval string")


def test_feature_engineer_produces_more_columns(spark):
    from shelfcast.plans.features import FEATURES, FeatureEngineer
    df = spark.createDataFrame(THREE_ROWS, THREE_SCHEMA)
    out = FeatureEngineer().fit(df).transform(df)
    assert len(out.columns) > len(df.columns)
    assert len(out.columns) == 26 and set(out.columns) == set(FEATURES)
    got = {r["store"]: r for r in out.collect()}
    expected = {  # hand-computed: dow, week, year start/end, xmas, new year, easter, promo2, competition
        1: (3, 1, 1, 0, 358, 0, 94, 0, 58),
        2: (0, 25, 0, 0, 193, 165, 71, 0, 36),
        3: (4, 52, 0, 1, 0, 358, 264, 0, 15),
    }
    for s, exp in expected.items():
        r = got[s]
        assert (r["day_of_week"], r["week_of_year"], r["is_year_start"], r["is_year_end"], r["days_to_christmas"],
                r["days_after_new_year"], r["days_to_easter"], r["promo2_active"],
                r["competition_open_months"]) == exp
    # label codes follow sorted labels: None < c for state holidays
    assert got[3]["state_holiday"] == 1 and got[1]["state_holiday"] == 0
    assert [got[s]["store_type"] for s in (1, 2, 3)] == [0, 1, 2]


def test_feature_engineer_unseen_label_fails(spark):
    from shelfcast.plans.features import FeatureEngineer
    df = spark.createDataFrame(THREE_ROWS, THREE_SCHEMA)
    model = FeatureEngineer().fit(df)
    other = df.withColumn("store_type", F.lit("z"))
    with pytest.raises(Exception, match="unseen label"):
        model.transform(other).collect()


def test_feature_engineer_save_load(spark, tmp_dir):
    from shelfcast.plans.features import FeatureEngineer, FeatureEngineerModel
    df = spark.createDataFrame(THREE_ROWS, THREE_SCHEMA)
    model = FeatureEngineer(keepColumns=["date"]).fit(df)
    model.write().overwrite().save(f"{tmp_dir}/fe")
    back = FeatureEngineerModel.load(f"{tmp_dir}/fe")
    assert back.vocab() == model.vocab()
    assert "date" in back.transform(df).columns


def test_depth_over_the_limit_is_an_error():
    from shelfcast.plans.models import gbt_pipeline, rf_pipeline
    for make in (rf_pipeline, gbt_pipeline):
        with pytest.raises(ValueError, match="30"):
            make(max_depth=31)
    assert rf_pipeline(max_depth=30).getStages()[-1].getMaxDepth() == 30


def test_no_distance_and_long_vocabularies_are_errors(spark, monkeypatch):
    from shelfcast.plans import features as FE
    df = spark.createDataFrame(THREE_ROWS, THREE_SCHEMA)
    with pytest.raises(ValueError, match="competition_distance"):
        FE.FeatureEngineer().fit(df.withColumn("competition_distance", F.lit(None).cast("double")))
    monkeypatch.setattr(FE, "MAX_LABELS", 2)
    with pytest.raises(ValueError, match="more than 2 labels"):
        FE.FeatureEngineer().fit(df)


def test_median_imputer_is_exact_and_saved(spark, tmp_dir):
    from shelfcast.plans.features import MedianImputer, MedianImputerModel
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (10.0, float("nan")), (None, 6.0)], "a double, b double")
    m = MedianImputer(inputCols=["a", "b"], outputCols=["x", "y"]).fit(df)
    m.write().overwrite().save(f"{tmp_dir}/imp")
    out = MedianImputerModel.load(f"{tmp_dir}/imp").transform(df).collect()
    assert [(r["x"], r["y"]) for r in out] == [(1.0, 5.5), (2.0, 5.0), (10.0, 5.5), (2.0, 6.0)]
    with pytest.raises(ValueError, match="no median"):
        MedianImputer(inputCols=["a"], outputCols=["x"]).fit(df.where("a > 100"))


def test_cents_round_half_even_like_the_reference(spark):
    import numpy as np
    from shelfcast.functions.display import clean_prediction
    vals = [2.675, 0.125, 0.135, -3.0, 1.005, 7.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "v double").select(clean_prediction("v")).collect()]
    assert got == [float(x) for x in np.round(np.maximum(vals, 0.0), 2)]


def test_histogram_has_every_bin(spark):
    import numpy as np
    from shelfcast.operators.eda import histogram
    vals = [0.0, 0.1, 9.9, 10.0, 10.0]
    got = histogram(spark.createDataFrame([(v,) for v in vals], "v double"), "v", 20).orderBy("bin").collect()
    assert [r["count"] for r in got] == np.histogram(vals, bins=20)[0].tolist()
    assert histogram(spark.createDataFrame([], "v double"), "v", 20).count() == 0
