"""Per-store series operators against numpy brute force and known properties."""

import datetime as dt
import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import timeseries as TS

D0 = dt.date(2013, 1, 1)


def _panel(spark, series: dict[int, list]):
    rows = []
    for s, vals in series.items():
        for i, v in enumerate(vals):
            if v is None:
                continue
            rows.append((s, D0 + dt.timedelta(days=i), float(v), 1))
    return spark.createDataFrame(rows, "store long, date date, sales double, open int")


def _gen(n=400, seed=1):
    # sales are money: 4 decimals, as the panel's DECIMAL means keep them
    rng = np.random.default_rng(seed)
    return {1: np.round(100 + rng.normal(0, 1, n), 4).tolist(),            # white noise
            2: np.round(100 + np.cumsum(rng.normal(0, 1, n)), 4).tolist(),  # random walk
            3: np.round(100 + 10 * np.sin(2 * np.pi * np.arange(n) / 7), 4).tolist()}


def test_adf_noise_vs_walk_and_scale(spark):
    from shelfcast.operators.timeseries import adf, store_series
    g = _gen()
    res = {r["store"]: r for r in adf(store_series(_panel(spark, g))).collect()}
    assert res[1]["is_stationary"] and res[1]["p_value"] < 0.01
    assert not res[2]["is_stationary"] and res[2]["p_value"] > 0.05
    # values with 2 decimals scaled by 4 stay exact in the 4-decimal money type
    g = {k: [round(v, 2) for v in vals] for k, vals in g.items()}
    res = {r["store"]: r for r in adf(store_series(_panel(spark, g))).collect()}
    scaled = {k: [v * 4.0 for v in vals] for k, vals in g.items()}
    res2 = {r["store"]: r for r in adf(store_series(_panel(spark, scaled))).collect()}
    for s in (1, 2):
        assert res2[s]["adf_stat"] == pytest.approx(res[s]["adf_stat"], rel=1e-9)


def test_mackinnon_known_points():
    from shelfcast.operators.timeseries import mackinnon_p
    assert mackinnon_p(-2.86) == pytest.approx(0.05, abs=0.002)
    assert mackinnon_p(-3.43) == pytest.approx(0.01, abs=0.001)
    assert mackinnon_p(3.0) == 1.0 and mackinnon_p(-20) == 0.0


def test_interpolation_and_resample(spark):
    from shelfcast.operators.timeseries import store_series
    vals = [10.0, None, None, 40.0, None, 50.0]
    got = [r["y"] for r in store_series(_panel(spark, {1: vals})).orderBy("date").collect()]
    assert got == pytest.approx([10.0, 20.0, 30.0, 40.0, 45.0, 50.0])


def test_acf_pacf_against_numpy(spark):
    from shelfcast.operators.timeseries import acf, pacf, store_series
    g = _gen(200)
    s = store_series(_panel(spark, g))
    a = acf(s, nlags=10)
    p = {(r["store"], r["lag"]): r["pacf"] for r in pacf(a).collect()}
    a_rows = {(r["store"], r["lag"]): r for r in a.collect()}
    for st, vals in g.items():
        x = np.asarray(vals) - np.mean(vals)
        c0 = x @ x
        r = np.array([1.0] + [x[k:] @ x[:-k] / c0 for k in range(1, 11)])
        assert [a_rows[(st, k)]["acf"] for k in range(11)] == pytest.approx(r.tolist(), abs=1e-12)
        assert a_rows[(st, 0)]["acf"] == 1.0
        for k in range(1, 11):
            T = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
            phi = np.linalg.solve(T, r[1:k + 1])
            assert p[(st, k)] == pytest.approx(phi[-1], abs=1e-9)
        band2 = 1.96 * math.sqrt((1 + 2 * r[1] ** 2) / len(vals))
        assert a_rows[(st, 2)]["band"] == pytest.approx(band2)
    assert a_rows[(3, 7)]["acf"] > 0.9


def test_scale_roundtrip_constant_and_windows(spark):
    from shelfcast.operators.timeseries import minmax_scale, sliding_windows, store_series, unscale
    g = {1: [float(v) for v in range(30)], 2: [5.0] * 20}
    s = minmax_scale(store_series(_panel(spark, g)))
    back = s.select("store", "y", unscale(F.col("scaled"), F.col("v_min"), F.col("v_max")).alias("b")).collect()
    for r in back:
        if r["store"] == 1:
            assert r["b"] == pytest.approx(r["y"])
        else:
            assert r["b"] is None
    w = sliding_windows(store_series(_panel(spark, g)), "y", 14)
    counts = {r["store"]: r["count"] for r in w.groupBy("store").count().collect()}
    assert counts == {1: 16, 2: 6}
    first = w.where("store = 1").orderBy("t").first()
    assert first["x"] == [float(v) for v in range(14)] and first["target"] == 14.0


def test_ordered_cut_and_lag_forecast(spark):
    from shelfcast.operators.timeseries import lag_forecast
    g = _gen(300)
    out, metrics = lag_forecast(_panel(spark, g))
    m = {r["store"]: r for r in metrics.collect()}
    n_windows = {r["store"]: r["count"] for r in out.groupBy("store").count().collect()}
    for st in g:
        n = n_windows[st]
        assert m[st]["test_windows"] == n - int(n * 0.85)
    assert m[3]["rmse"] < 1e-3  # a weekly cycle (to 4 decimals) is a near-exact 14-lag autoregression


@pytest.mark.parametrize("ties", [False, True])
def test_qq_points_brute_force(spark, ties):
    from shelfcast.operators.evaluation import qq_points
    rng = np.random.default_rng(3)
    y = rng.normal(0, 5, 300)
    if ties:  # a hot value: a third of all residuals are equal, expanded in chunks of 7
        y[:100] = 1.25
    df = spark.createDataFrame([(float(v), 0.0) for v in y], "y double, p double")
    pts = qq_points(df, buckets=16, chunk=7).orderBy("i").collect()
    n = len(y)
    srt = np.sort(y)
    m = np.array([(i - 0.3175) / (n + 0.365) for i in range(1, n + 1)])
    m[-1] = 0.5 ** (1 / n)
    m[0] = 1 - m[-1]
    theo = [NormalDist().inv_cdf(v) for v in m]
    assert [r["ordered"] for r in pts] == pytest.approx(srt.tolist())
    assert [r["theoretical"] for r in pts] == pytest.approx(theo, abs=1e-12)
    slope, intercept = np.polyfit(theo, srt, 1)
    assert pts[0]["slope"] == pytest.approx(slope) and pts[0]["intercept"] == pytest.approx(intercept)


def test_lag_regression_matches_lstsq(spark):
    from shelfcast.operators.timeseries import fit_lag_regression
    rng = np.random.default_rng(11)
    rows, ref = [], {}
    for st in (1, 2):
        y = rng.normal(0, 1, 120).cumsum() / 10
        X = np.array([y[i:i + 14] for i in range(len(y) - 14)])
        tgt = y[14:]
        k = int(len(tgt) * 0.85)
        beta, *_ = np.linalg.lstsq(np.column_stack([np.ones(k), X[:k]]), tgt[:k], rcond=None)
        ref[st] = np.column_stack([np.ones(len(tgt)), X]) @ beta
        rows += [(st, i + 15, [float(v) for v in X[i]], float(tgt[i]), int(i < k)) for i in range(len(tgt))]
    df = spark.createDataFrame(rows, "store long, t int, x array<double>, target double, is_train int")
    got = {(r["store"], r["t"]): r["prediction"] for r in fit_lag_regression(df).collect()}
    for st in (1, 2):
        assert [got[(st, i + 15)] for i in range(len(ref[st]))] == pytest.approx(ref[st].tolist(), abs=1e-6)


def test_make_stationary_follows_adf(spark):
    from shelfcast.operators.timeseries import adf, make_stationary, store_series
    g = _gen(300)
    s = store_series(_panel(spark, {1: g[1], 2: g[2]}))
    out = make_stationary(s, adf(s))
    counts = {r["store"]: r["count"] for r in out.groupBy("store").count().collect()}
    assert counts == {1: 300, 2: 299}  # noise kept as levels, the walk differenced (first day dropped)
    first2 = out.where("store = 2").orderBy("t").first()
    assert first2["y"] == pytest.approx(g[2][1] - g[2][0])


def test_forecast_requests_open_rule(spark):
    from shelfcast.operators.scoring import forecast_requests
    horizon = spark.createDataFrame([(1, dt.date(2015, 9, 17))], "store long, date date")
    store = spark.createDataFrame([(1, "a"), (2, "b")], "store long, store_type string")
    req = spark.createDataFrame([(1, 1, 0, 2), (2, 0, 1, 1)], "store long, promo int, school_holiday int, weeks int")
    rows = {(r["store"], r["date"]): r for r in forecast_requests(horizon, store, req).collect()}
    assert len([k for k in rows if k[0] == 1]) == 14 and len([k for k in rows if k[0] == 2]) == 7
    sunday = dt.date(2015, 9, 13)
    assert rows[(1, sunday)]["open"] == 0 and rows[(2, sunday)]["open"] == 1
    assert rows[(1, sunday)]["day_of_week"] == 7 and rows[(1, dt.date(2015, 9, 14))]["day_of_week"] == 1
    assert max(k[1] for k in rows) == dt.date(2015, 9, 17) and rows[(1, sunday)]["state_holiday"] == "None"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_series_are_dealt_by_their_size(spark, monkeypatch):
    """A longer table brings more tasks, with the same rows."""
    rows = [(s, D0 + dt.timedelta(days=3 * i), 1, float(s + i * i)) for s in range(40) for i in range(6)]
    panel = spark.createDataFrame(rows, "store long, date date, open int, sales double")
    want = sorted(map(tuple, TS.store_series(panel).collect()))
    monkeypatch.setattr(TS, "DAYS_PER_TASK", 2)
    found = TS.store_series(panel)
    assert "REPARTITION_BY_NUM" in _plan(found) and "120" in _plan(found)
    assert sorted(map(tuple, found.collect())) == want


def test_no_step_reads_a_series_again_for_every_day_or_sorts_wide_rows(spark):
    """No frame to the end of the series, no column per lag."""
    rows = [(s, D0 + dt.timedelta(days=i), None if i % 3 else float(i * s % 7)) for s in (1, 2) for i in range(60)]
    series = spark.createDataFrame(rows, "store long, date date, y double")
    filled = TS.interpolate(series)
    assert "unboundedfollowing" not in _plan(filled).lower()
    assert [r["y"] for r in filled.where("store = 2").orderBy("date").limit(4).collect()] == pytest.approx([0.0, 2.0, 4.0, 6.0], abs=1e-12)
    for out in (TS.adf(filled), TS.acf(filled)):
        assert "FlatMapGroupsInArrow" in _plan(out) and "lag(_d" not in _plan(out) and "collect_list" not in _plan(out)


def test_line_items_are_dealt_by_their_number(spark, monkeypatch):
    """More line items bring more tasks to group them, with the same daily facts."""
    from shelfcast.sources import fixture as FX
    rows = [(s, D0 + dt.timedelta(days=i % 5), 10.0 * i, 0.01 * (i % 9), float(i)) for s in (1, 1, 2, 3, None) for i in range(8)]
    items = spark.createDataFrame(rows + [(4, None, 1.0, None, None)],
                                  "l_suppkey long, l_shipdate date, l_extendedprice double, l_discount double, l_quantity double")
    want = sorted(map(str, FX.daily_facts(items).collect()))
    monkeypatch.setattr(FX, "LINES_PER_TASK", 2)
    found = FX.daily_facts(items)
    assert "REPARTITION_BY_NUM" in _plan(found) and _plan(found).count("Exchange") == 1
    assert sorted(map(str, found.collect())) == want and len(want) == 21


def test_lag_forecast_writes_no_more_than_the_known_days(spark, monkeypatch):
    """the days between the known ones, several times as many, are neither stored nor dealt again."""
    from shelfcast.operators import timeseries as TS
    rows = [(s, dt.date(2014, 1, 1) + dt.timedelta(days=4 * i), 1, 100.0 + 10 * s + (7 * i * i) % 31) for s in (1, 2, 3) for i in range(50)]
    panel = spark.createDataFrame(rows, "store long, date date, open int, sales double")
    counts, real = {}, TS.written

    def watched(df, name):
        out = real(df, name)
        counts[name] = out.count()
        return out
    monkeypatch.setattr(TS, "written", watched)
    out, metrics = TS.lag_forecast(panel)
    assert counts["daily"] == 150 and max(counts.values()) == 150
    got = {r["store"]: r for r in metrics.collect()}
    stored, again = TS.series_forecast(real(TS.store_series(panel), "series"))
    want = {r["store"]: r for r in again.collect()}
    assert got.keys() == want.keys() == {1, 2, 3} and out.count() == stored.count() > 500
    assert all(got[s]["rmse"] == pytest.approx(want[s]["rmse"]) and got[s]["test_windows"] == want[s]["test_windows"] for s in got)
