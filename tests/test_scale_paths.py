"""Paths that the small tables never need: narrowed quantiles, digest brackets, long vocabularies, many uploads, dying writers;
and the per-store sums behind the ADF test and the epochs, against plain numpy."""

import datetime as dt
import json
import math
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F


def _series(spark, groups):
    rows = [(s, dt.date(2013, 1, 1) + dt.timedelta(days=i), None if v is None else float(v)) for s, vals in groups.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "store long, date date, y double").repartition(4)


def test_adf_from_sums_matches_the_regressions(spark):
    from shelfcast.operators.timeseries import adf, adf_test
    rng = np.random.default_rng(4)
    groups = {1: rng.normal(size=300), 2: np.cumsum(rng.normal(size=800)) + 1e5, 3: np.sin(np.arange(200) / 5) * 40 + rng.normal(size=200),
              4: rng.normal(size=4), 5: rng.normal(size=13), 6: [3.0, 1.0, 2.0], 7: 1e-6 * rng.normal(size=90), 8: np.arange(150) ** 1.5 + rng.normal(size=150),
              9: np.repeat(rng.normal(size=40), 7), 10: np.cumsum(rng.normal(size=1300)) * 1000}
    got = {r["store"]: r for r in adf(_series(spark, groups)).collect()}
    for s, vals in groups.items():
        stat, p, lag, nobs = adf_test(np.asarray(vals, float))
        r = got[s]
        assert (r["used_lag"], r["nobs"]) == (lag, nobs)
        if math.isnan(stat):
            assert r["adf_stat"] is None and r["p_value"] is None and not r["is_stationary"]
        else:
            assert r["adf_stat"] == pytest.approx(stat, rel=1e-6) and r["p_value"] == pytest.approx(p, abs=1e-8)


def test_adf_without_variation_and_with_nulls(spark):
    from shelfcast.operators.timeseries import adf, adf_test
    rng = np.random.default_rng(1)
    vals = rng.normal(size=120).tolist()
    holes = [v if i % 7 else None for i, v in enumerate(vals)]
    got = {r["store"]: r for r in adf(_series(spark, {1: [5.0] * 60, 2: holes})).collect()}
    assert got[1]["adf_stat"] is None and not got[1]["is_stationary"]
    assert got[2]["adf_stat"] == pytest.approx(adf_test(np.array([v for v in holes if v is not None]))[0], rel=1e-8)
    with pytest.raises(Exception, match="max_lag"):
        adf(_series(spark, {1: vals}), max_lag=3).collect()


def test_lag_epochs_match_plain_gradient_steps(spark):
    from shelfcast.operators.timeseries import ordered_cut, sliding_windows, train_lag_epochs
    rng = np.random.default_rng(2)
    series = {1: np.clip(np.sin(np.arange(230) / 4) * 0.7 + rng.normal(size=230) * 0.1, -1, 1), 2: np.clip(rng.normal(size=90) * 0.4, -1, 1), 3: [0.1] * 10,
              4: np.linspace(-1, 1, 15)}  # 3: no window, 4: one window, so no training
    rows = [(s, i + 1, float(v)) for s, vals in series.items() for i, v in enumerate(vals)]
    cut = ordered_cut(sliding_windows(spark.createDataFrame(rows, "store long, t int, y double")), 0.85)
    weights, history = train_lag_epochs(cut, epochs=40, batch_size=32, patience=3, step=0.1)
    weights = {r["store"]: r for r in weights.collect()}
    assert set(weights) == {1, 2}
    for s in (1, 2):
        y = np.asarray(series[s], float)
        x = np.array([[1.0, *y[i:i + 14]] for i in range(len(y) - 14)])
        t, k = y[14:], int(0.85 * (len(y) - 14))
        w, log, best, best_w, best_epoch = np.zeros(15), [], math.inf, None, 0
        for epoch in range(1, 41):
            for b in range(0, k, 32):
                xb, tb = x[b:min(b + 32, k)], t[b:min(b + 32, k)]
                w = w - 0.1 * 2 / len(tb) * xb.T @ (xb @ w - tb)
            log.append((epoch, np.mean((x[:k] @ w - t[:k]) ** 2), np.mean((x[k:] @ w - t[k:]) ** 2)))
            if log[-1][2] < best - 1e-7:
                best, best_w, best_epoch = log[-1][2], w, epoch
            elif epoch - best_epoch >= 3:
                break
        got = sorted((r["epoch"], r["loss"], r["val_loss"]) for r in history.where(F.col("store") == s).collect())
        assert len(got) == len(log) and np.allclose(got, log, rtol=1e-8)
        assert weights[s]["best_epoch"] == best_epoch and np.allclose(weights[s]["beta"], best_w, atol=1e-10)


@pytest.mark.parametrize("buckets,ordered", [(2, 3), (5, 40), (64, 10)])
def test_quantiles_narrow_to_the_rank(spark, buckets, ordered):
    from shelfcast.operators.quantiles import exact_quantiles
    rng = random.Random(buckets)
    rows = [(rng.choice([None, 1, 2]), rng.choice([rng.gauss(0, 1e6), float(rng.randint(0, 9)), 1e-9 * rng.random()]), rng.randint(0, 3)) for _ in range(900)]
    df = spark.createDataFrame(rows, "g int, v double, w int")
    for q in (0.0, 0.5, 0.77, 1.0):
        got = {r["g"]: r["quantile"] for r in exact_quantiles(df, ["v"], q, by=["g"], weight="w", buckets=buckets, ordered_pairs=ordered).collect()}
        for g in (None, 1, 2):
            vals = [v for k, v, w in rows if k == g for _ in range(w)]
            assert got[g] == pytest.approx(float(np.quantile(np.array(vals), q)), rel=1e-12)


def test_samples_by_threshold(spark):
    """Bracket hits and misses, equal digests at the threshold, the n-th key by its digits."""
    from shelfcast.operators import sampling as SP
    df = spark.range(20_000).withColumnRenamed("id", "store").withColumn("date", F.lit(1))
    keys = sorted((r["k"], r["store"]) for r in df.select("store", SP.sample_key(["store", "date"], 42).alias("k")).collect())
    for fraction, bracket in ((0.2, 0.02), (0.2, 1e-6), (0.999, 0.02), (0.0, 0.02), (1.0, 0.02)):
        got = sorted(r["store"] for r in SP.sample_fraction(df, fraction, bracket=bracket).collect())
        assert got == sorted(s for _, s in keys[:int(20_000 * fraction)])
    assert sorted(r["store"] for r in SP.sample_fixed(df, 777).collect()) == sorted(s for _, s in keys[:777])
    assert SP.sample_fixed(df, 30_000).count() == 20_000 and SP.sample_fixed(df, 0).count() == 0
    same = spark.range(500).select(F.lit(7).alias("store"), F.lit(1).alias("date"), "id")
    assert SP.sample_fraction(same, 0.3).count() == 150 and SP.sample_fixed(same, 40).count() == 40
    table = df.select(SP.sample_key(["store", "date"], 42).alias("_key"))
    for n in (1, 5000, 20_000):
        assert SP.nth_key(table, n, ordered_keys=3) == (keys[n - 1][0], n - 1, 1)


PASSES = """
import json, os, sys
sys.path.insert(0, {repo!r})
from shelfcast.session import get_spark
spark = get_spark("passes", "local[2]", 2, {{"spark.eventLog.enabled": "true", "spark.eventLog.dir": {log!r}, "spark.eventLog.compress": "false",
                  "spark.checkpoint.dir": {ckpt!r}, "spark.ui.showConsoleProgress": "false"}})
from shelfcast.operators.sampling import sample_fixed, sample_fraction
df = spark.read.parquet({table!r})
({what}).write.format("noop").mode("overwrite").save()
spark.stop()
"""


@pytest.mark.parametrize("what,most", [("sample_fraction(df, 0.2)", 2.25), ("sample_fixed(df, 500)", 2.1)])
def test_samples_read_their_source_twice(spark, tmp_dir, what, most):
    """Rows read by all tasks, from Spark's event log, over the rows of the source (beside it, only the digests of the bracket,
    4 % of the rows, are read a few times)."""
    table = f"{tmp_dir}/wide"
    spark.range(50_000).select(F.col("id").alias("store"), F.lit(1).alias("date"), F.rand(1).alias("x")).write.parquet(table)
    os.makedirs(f"{tmp_dir}/log")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = PASSES.format(repo=repo, log=f"file://{tmp_dir}/log", ckpt=f"{tmp_dir}/ckpt", table=table, what=what)
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300)
    read = 0
    for folder, _, files in os.walk(f"{tmp_dir}/log"):
        for f in files:
            for line in open(os.path.join(folder, f), encoding="utf-8"):
                event = json.loads(line) if line.startswith("{") else {}
                if event.get("Event") == "SparkListenerTaskEnd":
                    read += event.get("Task Metrics", {}).get("Input Metrics", {}).get("Records Read", 0)
    assert 50_000 <= read <= most * 50_000


def test_a_million_labels(spark):
    from shelfcast.plans import features as FE
    labels = [f"k{i:07d}" for i in range(1_000_000)]
    df = spark.range(1_000_000).select(F.format_string("k%07d", 999_999 - F.col("id")).alias("store_type"), F.lit("a").alias("assortment"), "id")
    out = FE.with_label_codes(df, {"store_type": labels, "assortment": ["a", "b"]})
    assert out.columns == df.columns
    assert out.where((F.col("store_type") != 999_999 - F.col("id")) | (F.col("assortment") != 0)).count() == 0
    with pytest.raises(Exception, match="unseen label"):
        FE.with_label_codes(df.limit(5), {"store_type": labels[:300]}).collect()


def test_long_vocabulary_in_the_fitted_features(spark, monkeypatch):
    """Codes joined as a table are those of the literal array."""
    from shelfcast.operators.clean import prepare
    from shelfcast.plans import features as FE
    from shelfcast.sources.fixture import load_panel
    p = load_panel(spark, SF_SMALL)
    panel = prepare(p.fact, p.store)[0]
    want = FE.label_encode(panel, panel).collect()
    monkeypatch.setattr(FE, "LITERAL_LABELS", 0)
    assert sorted(map(str, FE.label_encode(panel, panel).collect())) == sorted(map(str, want))


def _csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_a_thousand_uploads_are_two_reads(spark, tmp_dir, monkeypatch):
    from shelfcast.sources import csv_io as IO
    for i in range(1000):
        text = f"Id,Store,Date\n{i},{i % 7},2015-08-01\n" if i % 2 else f"Date,Store,Id,Open\n2015-08-02,{i % 7},{i},1\n"
        _csv(f"{tmp_dir}/up/{i:04d}.csv", text)
    _csv(f"{tmp_dir}/up/empty.csv", "")
    groups = IO.by_header(spark, [f"file:{tmp_dir}/up/{f}" for f in sorted(os.listdir(f"{tmp_dir}/up"))])
    assert sorted(map(len, groups)) == [500, 500]
    parts = [IO.read_upload(spark, g) for g in groups]
    assert sorted(len(p.columns) for p in parts) == [3, 4]
    ids = sorted(int(r["id"]) for p in parts for r in p.select("id").collect())
    assert ids == list(range(1000))


def test_model_store_survives_a_dying_save(spark, tmp_dir):
    from shelfcast.plans.ensembles import EnsembleModel, fit_forest
    from shelfcast.sources.runs import ModelStore
    from pyspark.ml import PipelineModel
    store = ModelStore(spark, f"{tmp_dir}/store")
    rows = spark.createDataFrame([(i, [float(i % 5)], float(i % 5)) for i in range(40)], "row long, x array<double>, y double")
    model = EnsembleModel(PipelineModel([]), fit_forest(rows, num_trees=3), "rf")
    first = store.save(model, "First One")

    class Dies:
        trees = None

        def save(self, path):
            model.save(path)
            raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        store.save(Dies(), "Second")
    got, path = store.load_latest()
    assert path.endswith(os.path.basename(first)) and sorted(map(str, got.trees.collect())) == sorted(map(str, model.trees.collect()))
    third = store.save(model, "Third")
    assert store.load_latest()[1].endswith(os.path.basename(third)) and store.load_latest("First One")[1].endswith(os.path.basename(first))
    assert store.load_latest("Second") == (None, None) and store.entries().count() == 2


def test_run_log_compaction(spark, tmp_dir, monkeypatch):
    from shelfcast.sources.runs import RunStore, latest_runs
    store = RunStore(spark, f"{tmp_dir}/runs")
    for i in range(6):
        store.log_run(f"r{i}", {"a": i}, {"RMSPE": 1.0 + i}, start_ts=1_700_000_000 + i)
    before = sorted(map(str, store.runs().collect()))
    assert store.compact() == 6 and sorted(map(str, store.runs().collect())) == before
    store.log_run("r6", {}, {"RMSPE": 2.0}, start_ts=1_700_000_010)
    assert store.runs().count() == 7 and latest_runs(store.runs(), 1).first()["name"] == "r6"
    # a compaction that died before it removed the old files: every run still counts once
    store.runs().coalesce(1).write.parquet(f"{tmp_dir}/runs/compact-by-hand")
    assert store.runs().count() == 7


def test_spend_rows_are_spread_once(spark, monkeypatch):
    """Spend per customer: one spreading of the rows without per-row lambdas, nulls and the cut as before."""
    from shelfcast.operators import eda, quantiles
    plans, keep = [], quantiles.written

    def seen(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, name)
    monkeypatch.setattr(quantiles, "written", seen)
    rows = [(1, 10.0, 2), (1, 90.0, 3), (0, 8.0, 2), (0, 8.0, 0), (None, 60.0, 1), (None, 20.0, 1), (1, None, 3), (0, 1.0, None)]
    df = spark.createDataFrame(rows, "promo int, sales double, customers long")
    got = {(r["subset"], r["promo"]): r["median"] for r in eda.spend_medians(df, 30.0).collect()}
    assert got == {("all_below_cut", None): 5.0, ("by_promo", 1): 17.5, ("by_promo", 0): 4.0, ("by_promo", None): 40.0}
    assert plans[0].count("Generate ") == 1 and "lambdafunction" not in plans[0]
