"""Per-store daily series operators, run for every store at once (TS1-TS10, K4).

All operators key on ``store`` and order by ``date``. A store's series is at
most one row per calendar day after TS1 (the daily aggregate is partial +
final, so a store holding a third of the raw rows is combined map-side), so
each window partition and each grouped-pandas group is bounded by the number
of days, not by the number of raw rows.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.aggregates import exact_mean
from shelfcast.session import written

DAYS_PER_TASK = 250_000  # known days that one task takes where the series are longer than the cores would bring in


def by_date():
    return Window.partitionBy("store").orderBy("date")


def whole():
    return Window.partitionBy("store")


# ---------------------------------------------------------------- TS1, TS2

def _daily_means(panel: DataFrame, value: str) -> DataFrame:
    """F9 + the per-day mean: open days only, one row per (store, day)."""
    return (panel.where(F.col("open") == 1)
            .groupBy("store", "date").agg(exact_mean(value).alias("y")))


def _dealt(daily: DataFrame) -> DataFrame:
    """The known days written once and dealt to tasks by store: of a table that grows the number of tasks grows, not their size."""
    daily = written(daily, "daily")
    tasks = math.ceil(daily.count() / DAYS_PER_TASK)
    return daily.repartition(tasks, "store") if tasks > daily.sparkSession.sparkContext.defaultParallelism else daily


def _gaps(daily: DataFrame) -> DataFrame:
    """Each known day with the next known day of its store and the store's first day.

    One window (partitioned by store, ordered by date) replaces a calendar
    spine and its join: the days in between are generated from each row.
    """
    nxt = Window.partitionBy("store").orderBy("date")
    return daily.withColumns({"_nd": F.lead("date").over(nxt), "_nv": F.lead("y").over(nxt),
                              "_d0": F.min("date").over(whole())})


def _fill_days(daily: DataFrame, interpolate_values: bool) -> DataFrame:
    g = _gaps(_dealt(daily))
    gap = F.coalesce(F.datediff("_nd", "date"), F.lit(1))
    g = g.withColumn("_k", F.explode(F.sequence(F.lit(0), gap - 1)))
    k = F.col("_k").cast("double")
    if interpolate_values:
        y = (F.when(F.col("_k") == 0, F.col("y"))
             .otherwise(F.col("y") + (F.col("_nv") - F.col("y")) * (k / gap.cast("double"))))
    else:
        y = F.when(F.col("_k") == 0, F.col("y"))
    day = F.date_add("date", F.col("_k"))
    return g.select("store", day.alias("date"), y.alias("y"),
                    (F.datediff(day, "_d0") + 1).cast("int").alias("t"))


def daily_series(panel: DataFrame, value: str = "sales") -> DataFrame:
    """F9 + TS1: open days only, mean per (store, day), days without rows as nulls,
    from each store's first to its last open day."""
    return _fill_days(_daily_means(panel, value), interpolate_values=False).drop("t")


def interpolate(series: DataFrame, col: str = "y", out: str = "y") -> DataFrame:
    """TS2 on a series with null days: linear interpolation between the nearest known
    days on each side (days beyond the last known value keep it).

    The next known day comes from the window in descending order: a frame from the current row to the end
    would read the rest of the series again for every day."""
    known_d = F.when(F.col(col).isNotNull(), F.col("date"))
    back = by_date().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = Window.partitionBy("store").orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = series.withColumns({
        "_pv": F.last(col, ignorenulls=True).over(back), "_pd": F.last(known_d, ignorenulls=True).over(back),
        "_nv": F.last(col, ignorenulls=True).over(fwd), "_nd": F.last(known_d, ignorenulls=True).over(fwd),
    })
    gap = F.datediff("_nd", "_pd").cast("double")
    step = F.datediff("date", "_pd").cast("double")
    filled = (F.when(F.col(col).isNotNull(), F.col(col))
              .when(F.col("_pv").isNull(), F.col("_nv"))
              .when(F.col("_nv").isNull(), F.col("_pv"))
              .otherwise(F.col("_pv") + (F.col("_nv") - F.col("_pv")) * (step / gap)))
    return s.withColumn(out, filled).drop("_pv", "_pd", "_nv", "_nd")


def store_series(panel: DataFrame, value: str = "sales") -> DataFrame:
    """TS1 + TS2 in one pass: daily means, missing days generated between known
    neighbours and interpolated on the spot, with a 1-based day index ``t``."""
    return _fill_days(_daily_means(panel, value), interpolate_values=True)


# ---------------------------------------------------------------- TS4

def first_difference(series: DataFrame, col: str = "y") -> DataFrame:
    """TS4: y_t - y_{t-1}; the first day of each store is dropped."""
    d = F.col(col) - F.lag(col).over(by_date())
    return series.withColumn("diff", d).where(F.col("diff").isNotNull())


def make_stationary(series: DataFrame, adf_result: DataFrame, col: str = "y") -> DataFrame:
    """TS4 chosen by TS3: stores found non-stationary are differenced, the others kept.

    Output ``(store, date, t, y)`` where ``y`` is the level or the difference.
    """
    flags = adf_result.select("store", "is_stationary")
    s = series.join(flags, "store", "left")
    lagged = F.lag(col).over(by_date())
    out = s.withColumn("y_out", F.when(F.col("is_stationary"), F.col(col)).otherwise(F.col(col) - lagged))
    out = out.where(F.col("y_out").isNotNull())
    return (out.select("store", "date", F.col("y_out").alias("y"), "is_stationary")
            .withColumn("t", F.row_number().over(by_date())))


# ---------------------------------------------------------------- TS3 (ADF)

def mackinnon_p(tau: float) -> float:
    """Approximate p-value of the Dickey-Fuller statistic (constant, one series).

    Fixed values: MacKinnon (1994) response-surface coefficients for the
    constant-only case; below tau* = -1.61 the small-p polynomial
    (2.1659, 1.4412, 0.038269), above it the large-p polynomial
    (1.7339, 0.93202, -0.12745, -0.010368); p = 1 above 2.74, 0 below -18.83.
    """
    if tau > 2.74:
        return 1.0
    if tau < -18.83:
        return 0.0
    if tau <= -1.61:
        q = 2.1659 + 1.4412 * tau + 0.038269 * tau * tau
    else:
        q = 1.7339 + 0.93202 * tau - 0.12745 * tau ** 2 - 0.010368 * tau ** 3
    return NormalDist().cdf(q)


def _ols(y: np.ndarray, x: np.ndarray):
    beta, _, rank, _ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ beta
    ssr = float(resid @ resid)
    return beta, ssr, int(rank)


def adf_test(values: np.ndarray, max_lag: int | None = None) -> tuple[float, float, int, int]:
    """Augmented Dickey-Fuller with a constant and AIC lag choice; returns (stat, p, lag, nobs).

    Lags 0..max_lag are compared on the common sample, the chosen lag is
    refitted on all rows it allows, and the statistic is the t-value of the
    lagged level. ``max_lag`` defaults to ceil(12 * (n/100)^(1/4)), capped at
    n//2 - 2.
    """
    x = np.asarray(values, dtype=float)
    n = x.size
    if max_lag is None:
        max_lag = int(math.ceil(12.0 * (n / 100.0) ** 0.25))
        max_lag = min(n // 2 - 2, max_lag)
    if max_lag < 0 or n < 4:
        return float("nan"), float("nan"), 0, 0
    dx = np.diff(x)

    def design(lag: int, start: int):
        # rows t = start..len(dx)-1 : dx[t] ~ const + x[t] + dx[t-1..t-lag]
        rows = np.arange(start, dx.size)
        cols = [np.ones(rows.size), x[rows]]
        cols += [dx[rows - j] for j in range(1, lag + 1)]
        return dx[rows], np.column_stack(cols)

    best = None
    # All candidate models share the common sample and are nested (const, level,
    # lag 1, lag 2, ...), so one QR of the widest design gives every model's SSR.
    y_all, X_all = design(max_lag, max_lag)
    m = y_all.size
    Q, R = np.linalg.qr(X_all)
    diag = np.abs(np.diag(R))
    if m > 0 and diag.size and diag.min() > 1e-10 * max(diag.max(), 1e-300):
        qty2 = np.cumsum((Q.T @ y_all) ** 2)
        yy = float(y_all @ y_all)
        for lag in range(0, max_lag + 1):
            ssr = yy - float(qty2[lag + 1])
            if ssr <= 0:
                continue
            llf = -m / 2.0 * (math.log(2 * math.pi) + math.log(ssr / m) + 1.0)
            aic = -2.0 * llf + 2.0 * (lag + 2)
            if best is None or aic < best[0]:
                best = (aic, lag)
    else:
        for lag in range(0, max_lag + 1):
            y, X = design(lag, max_lag)
            _, ssr, rank = _ols(y, X)
            if y.size == 0 or ssr <= 0:
                continue
            llf = -y.size / 2.0 * (math.log(2 * math.pi) + math.log(ssr / y.size) + 1.0)
            aic = -2.0 * llf + 2.0 * rank
            if best is None or aic < best[0]:
                best = (aic, lag)
    lag = best[1] if best else 0
    y, X = design(lag, lag)
    stat = _t_value(y, X, 1)
    p = mackinnon_p(stat) if not math.isnan(stat) else float("nan")
    return stat, p, lag, y.size


def _t_value(y: np.ndarray, X: np.ndarray, k: int) -> float:
    """t-value of coefficient ``k`` from a QR of the design with columns scaled to length 1.

    Nothing is squared, so the value does not move with the scale of the series; nan where the design
    is singular or leaves no residual."""
    n, m = X.shape
    size = np.sqrt((X * X).sum(axis=0))
    if n <= m or not np.all(size > 0):
        return float("nan")
    q, r = np.linalg.qr(X / size)
    diag = np.abs(np.diag(r))
    if diag.min() <= 1e-10 * diag.max():
        return float("nan")
    inv = np.linalg.inv(r)
    beta = inv @ (q.T @ y)
    resid = y - (X / size) @ beta
    s2 = float(resid @ resid) / (n - m)
    se = math.sqrt(s2 * float(inv[k] @ inv[k]))
    return float(beta[k] / se) if se > 0 else float("nan")


ADF_SCHEMA = "store long, adf_stat double, p_value double, used_lag int, nobs int, is_stationary boolean"
ADF_MAX_LAG = 40


def adf(series: DataFrame, col: str = "y", threshold: float = 0.05, max_lag: int = ADF_MAX_LAG) -> DataFrame:
    """TS3 for every store (see :func:`adf_test` for the definition).

    Spark deals the stores out, and a task takes one store's days at a time (at most one row per calendar day). What the regressions
    of all lag orders need are products of the centred level and of its differences with differences up to ``max_lag`` days back;
    each regression's sample differs from the whole series by a few days at either end. One nested elimination of some 160
    numbers then gives the residuals of all lag orders.

    A store with too few days has null results and 0 days. ``max_lag`` 40 serves series of up to 12,345 days; a
    longer one is an error that says so.
    """
    ends = max_lag + 2
    fields = pa.schema([("store", pa.int64()), ("adf_stat", pa.float64()), ("p_value", pa.float64()), ("used_lag", pa.int32()),
                        ("nobs", pa.int32()), ("is_stationary", pa.bool_())])

    def run(key, days):
        y = _in_order(days, "date")["_y"].to_numpy()
        y = y - y.mean()
        d, n = np.diff(y), len(y)
        dd, yd = ([float(v[k:] @ d[:max(n - 1 - k, 0)]) for k in range(max_lag + 1)] for v in (d, y[:-1]))
        row = _adf_of_sums(key[0].as_py(), n, float(y.sum()), float(y @ y), dd, yd, y[:ends], y[-ends:], threshold, max_lag)
        return pa.table([[None if v != v else v] for v in row], schema=fields)
    days = series.where(F.col(col).isNotNull()).select("store", "date", F.col(col).cast("double").alias("_y"))
    return days.groupBy("store").applyInArrow(run, ADF_SCHEMA)


def _in_order(rows: pa.Table, by: str) -> pa.Table:
    """One store's rows in Spark's ascending order (nulls first)."""
    return rows.take(pc.sort_indices(rows, sort_keys=[(by, "ascending")], null_placement="at_start"))


def _adf_of_sums(store, n, sy, syy, dd, yd, head, tail, threshold: float, max_lag: int) -> tuple:
    """ADF of one centred series y_0..y_N from its product sums and its ends."""
    top = min(n // 2 - 2, math.ceil(12.0 * (n / 100.0) ** 0.25))
    if top < 0 or n < 4:
        return store, math.nan, math.nan, 0, 0, False
    if top > max_lag:
        raise ValueError(f"store {store} has {n} days: pass max_lag={top} or more")
    first, last = np.asarray(head, float), np.asarray(tail, float)[::-1]  # y_0, y_1, ... and y_N, y_(N-1), ...
    step, rear = np.diff(first), last[:-1] - last[1:]  # d_1, d_2, ... and d_N, d_(N-1), ...
    total = n - 1

    def gram(start: int, lag: int) -> np.ndarray:
        """Products of (1, y_(t-1), d_(t-1) .. d_(t-lag), d_t) summed over t = start + 1 .. N."""
        g = np.zeros((lag + 3, lag + 3))
        at = np.array([lag + 2, *range(2, lag + 2)])  # place of d_(t-i)
        for k in range(lag + 1):
            i = np.arange(lag + 1 - k)
            before = np.concatenate([np.zeros(k + 1), np.cumsum(step[k:start] * step[:start - k])])  # d_s d_(s-k) up to s
            after = np.concatenate([[0.0], np.cumsum(rear[:lag - k] * rear[k:lag])])  # the last i of them
            g[at[i], at[i + k]] = g[at[i + k], at[i]] = dd[k] - before[start - i] - after[i]
        for x in range(lag + 1):
            g[0, at[x]] = g[at[x], 0] = last[x] - first[start - x]
            g[1, at[x]] = g[at[x], 1] = yd[x] - first[x:start] @ step[:start - x]
        g[0, 0] = total - start
        g[0, 1] = g[1, 0] = sy - first[:start].sum() - last[0]
        g[1, 1] = syy - first[:start] @ first[:start] - last[0] ** 2
        return g

    rss, rank = _eliminate(gram(top, top))
    m, best, lag = total - top, math.inf, 0
    for k in range(top + 1):
        if rss[k + 2] > 0 and m > 0:
            aic = m * (math.log(2 * math.pi) + math.log(rss[k + 2] / m) + 1.0) + 2.0 * rank[k + 2]
            if aic < best:
                best, lag = aic, k
    g = gram(lag, lag)
    order = [0, *range(2, lag + 2), 1, lag + 2]
    rss, rank = _eliminate(g[np.ix_(order, order)])
    nobs, k = total - lag, lag + 2
    stat = math.nan
    if nobs > k and rank[k] == k and rss[k] > 0:
        # the level stands last: what it takes off the residual is its squared t-value's numerator
        level = _eliminate(g[np.ix_(order[:-2] + [lag + 2, 1], order[:-2] + [lag + 2, 1])], steps=lag + 1, whole=True)
        slope = level[-2, -1] / level[-1, -1]
        stat = slope / math.sqrt(rss[k] / (nobs - k) / level[-1, -1])
    p = mackinnon_p(stat) if not math.isnan(stat) else math.nan
    return store, stat, p, lag, nobs, bool(p < threshold)


def _eliminate(g: np.ndarray, steps: int | None = None, whole: bool = False, tiny: float = 1e-11):
    """Residual sums of squares of the last variable on the first 0, 1, 2, ... others, and their ranks.

    A variable that the ones before it explain up to ``tiny`` of its square adds nothing. ``whole``: what is
    left of the products after ``steps`` variables."""
    size = np.sqrt(np.maximum(np.diag(g), 0.0))
    scale = np.where(size > 0, size, 1.0)
    a = g / np.outer(scale, scale)
    rss, rank = [a[-1, -1]], [0]
    for k in range(len(a) - 1 if steps is None else steps):
        used = a[k, k] > tiny
        if used:
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:]) / a[k, k]
        rss.append(a[-1, -1])
        rank.append(rank[-1] + used)
    if whole:
        return a * np.outer(scale, scale)
    return np.where(np.array(rss) > 1e-13 * rss[0], rss, 0.0) * scale[-1] ** 2, rank


def dickey_fuller_lag0(series: DataFrame, col: str = "y") -> DataFrame:
    """Plain Dickey-Fuller t (constant, no lagged differences) as aggregates only."""
    s = series.withColumn("_lag", F.lag(col).over(by_date())).withColumn("_dy", F.col(col) - F.col("_lag"))
    s = s.where(F.col("_dy").isNotNull())
    agg = s.groupBy("store").agg(F.regr_slope("_dy", "_lag").alias("b"), F.regr_sxx("_dy", "_lag").alias("sxx"),
                                 F.regr_syy("_dy", "_lag").alias("syy"), F.regr_count("_dy", "_lag").alias("n"))
    ssr = F.col("syy") - F.col("b") * F.col("b") * F.col("sxx")
    t = F.col("b") / F.sqrt(ssr / (F.col("n") - 2) / F.col("sxx"))
    return agg.select("store", F.col("n").cast("bigint").alias("n"), t.alias("df_stat"))


# ---------------------------------------------------------------- TS5, TS6

def acf(series: DataFrame, col: str = "y", nlags: int = 40, z: float = 1.96) -> DataFrame:
    """TS5: biased autocorrelation for lags 0..nlags with the Bartlett band, per store.

    A task takes one store's days at a time and sums the products of all lags; the band is a running sum over the lag axis.
    """
    kind = series.schema["store"].dataType
    fields = [("n", pa.int64()), ("c", pa.list_(pa.float64()))]

    def run(key, days):
        d = _in_order(days, "date")["_y"].to_numpy()
        d = d - d.mean()
        c = [float(d[k:] @ d[:max(len(d) - k, 0)]) for k in range(nlags + 1)]
        return pa.table([pa.array([key[0].as_py()], key[0].type), *(pa.array([v], t) for v, (_, t) in zip((len(d), c), fields))], names=["store", "n", "c"])
    days = series.where(F.col(col).isNotNull()).select("store", "date", F.col(col).cast("double").alias("_y"))
    agg = days.groupBy("store").applyInArrow(run, f"store {kind.simpleString()}, n long, c array<double>")
    cells = F.array(*[F.struct(F.lit(k).alias("lag"), (F.lit(1.0) if k == 0 else F.col("c")[k] / F.col("c")[0]).alias("acf"))
                      for k in range(0, nlags + 1)])
    long = agg.select("store", "n", F.explode(cells).alias("c")).select("store", "n", "c.lag", "c.acf")
    prior = Window.partitionBy("store").orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    cum = F.coalesce(F.sum(F.when(F.col("lag") >= 1, F.col("acf") * F.col("acf"))).over(prior), F.lit(0.0))
    var = (F.when(F.col("lag") == 0, F.lit(0.0)).when(F.col("lag") == 1, 1.0 / F.col("n"))
           .otherwise((1 + 2 * cum) / F.col("n")))
    return long.withColumn("band", z * F.sqrt(var))


def pacf(acf_table: DataFrame, z: float = 1.96) -> DataFrame:
    """TS6: partial autocorrelation (Yule-Walker on the biased ACF, Durbin-Levinson), per store.

    Input is TS5's output: a store's 41 numbers become one array, and a batch of stores runs the
    recursion at once.
    """
    lags = F.array_sort(F.collect_list(F.struct("lag", "acf")))
    rows = acf_table.groupBy("store").agg(F.max("n").alias("n"), F.transform(lags, lambda s: s["acf"]).alias("r"))

    def run(batches):
        for pdf in batches:
            r = np.array([[np.nan if x is None else x for x in v] for v in pdf["r"]], dtype=float)
            m = r.shape[1] - 1 if len(r) else 0
            out, phi, v = np.full((len(r), m + 1), np.nan), np.zeros((len(r), m + 1)), np.ones(len(r))
            out[:, :1] = 1.0
            for k in range(1, m + 1):
                alive = v > 0
                a = (r[:, k] - (phi[:, 1:k] * r[:, k - 1:0:-1]).sum(axis=1)) / np.where(alive, v, np.nan)
                phi[:, 1:k] = phi[:, 1:k] - a[:, None] * phi[:, k - 1:0:-1]
                phi[:, k] = a
                v = np.where(alive, v * (1 - a * a), v)
                out[:, k] = a
            yield pd.DataFrame({"store": pdf["store"].astype("int64"), "n": pdf["n"].astype("int64"), "p": list(out)})
    solved = rows.mapInPandas(run, "store long, n long, p array<double>")
    return solved.select("store", "n", F.posexplode("p").alias("lag", "pacf")).select(
        "store", "lag", "pacf", F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(z / F.sqrt("n")).alias("band"))


# ---------------------------------------------------------------- TS7-TS9, K4

def minmax_scale(series: DataFrame, col: str = "y", lo: float = -1.0, hi: float = 1.0) -> DataFrame:
    """TS8: per-store min-max scaling into [lo, hi]; a constant series gives null."""
    mn, mx = F.min(col).over(whole()), F.max(col).over(whole())
    s = series.withColumns({"v_min": mn, "v_max": mx})
    scaled = F.lit(lo) + (hi - lo) * F.try_divide(F.col(col) - F.col("v_min"), F.col("v_max") - F.col("v_min"))
    return s.withColumn("scaled", scaled)


def unscale(scaled: Column, v_min: Column, v_max: Column, lo: float = -1.0, hi: float = 1.0) -> Column:
    """TS9."""
    return v_min + (scaled - lo) / (hi - lo) * (v_max - v_min)


def sliding_windows(series: DataFrame, col: str = "y", look_back: int = 14, order: str = "t") -> DataFrame:
    """TS7: (x = previous ``look_back`` values, y = current) for every position past the first window."""
    w = Window.partitionBy("store").orderBy(order)
    frame = w.rowsBetween(-look_back, -1)
    s = series.withColumns({"_pos": F.row_number().over(w), "x": F.collect_list(col).over(frame)})
    return s.where(F.col("_pos") > look_back).select("store", F.col(order).alias("t"), "x",
                                                     F.col(col).alias("target"))


def ordered_cut(windows: DataFrame, frac: float = 0.85) -> DataFrame:
    """K4: the first int(n * frac) windows of each store train, the rest test."""
    n = F.count(F.lit(1)).over(whole())
    rn = F.row_number().over(Window.partitionBy("store").orderBy("t"))
    return windows.withColumn("is_train", (rn <= F.floor(n * F.lit(frac))).cast("int"))


# ---------------------------------------------------------------- TS10

def fit_lag_regression(cut: DataFrame, look_back: int = 14, rcond: float = 1e-10) -> DataFrame:
    """Least-squares autoregression on the lag window, per store, fitted on the training
    windows and applied to all windows of that store.

    A task takes one store's training windows at a time, forms the normal equations (X'X and X'y, with an
    intercept column) and solves them with a pseudo-inverse (minimum-norm solution for collinear lags).
    Predictions are a dot product in a native higher-order expression.
    """
    m = look_back + 1

    def solve(key, windows):
        f, y = _design(windows, look_back)
        beta = np.linalg.pinv(f.T @ f, rcond=rcond) @ (f.T @ y)
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([beta], pa.list_(pa.float64()))], names=["store", "beta"])

    train = cut.where(F.col("is_train") == 1).select("store", "t", "x", F.col("target").cast("double").alias("target"))
    coefs = train.groupBy("store").applyInArrow(solve, "store long, beta array<double>")
    return _lag_predictions(cut, coefs, look_back, "left")


def _design(windows: pa.Table, look_back: int) -> tuple[np.ndarray, np.ndarray]:
    """(1, lags) of each window, and the targets."""
    lags = windows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(windows), look_back)
    return np.hstack([np.ones((len(windows), 1)), lags]), windows["target"].to_numpy()


def _lag_predictions(cut: DataFrame, coefs: DataFrame, look_back: int, how: str) -> DataFrame:
    scored = cut.join(coefs, "store", how)
    dot = F.aggregate(F.zip_with(F.slice("beta", 2, look_back), "x", lambda w, v: w * v),
                      F.element_at("beta", 1), lambda acc, v: acc + v)
    return scored.select("store", F.col("t").cast("int").alias("t"), F.col("target").cast("double").alias("target"),
                         dot.alias("prediction"), F.col("is_train").cast("int").alias("is_train"))


def lag_windows(series: DataFrame, look_back: int = 14, train_frac: float = 0.85,
                threshold: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """TS3/TS4 -> TS8 -> TS7 -> K4: (windows with is_train, each store's bounds).

    Only TS3's row a store and the bounds are written. The days themselves, several times the known ones, are neither written nor
    dealt again: each step makes them from the known days where its store's lie (see :func:`store_series`)."""
    flags = written(adf(series, threshold=threshold), "adf")
    stat = make_stationary(series, flags)
    bounds = written(stat.groupBy("store").agg(F.min("y").alias("v_min"), F.max("y").alias("v_max")), "bounds")
    scaled = minmax_scale(stat, "y")
    windows = sliding_windows(scaled.where(F.col("scaled").isNotNull()), "scaled", look_back)
    return ordered_cut(windows, train_frac), bounds


def _series_errors(fitted: DataFrame, bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """TS9 and the test windows' RMSE and MAE: (all windows in series units, metrics per store)."""
    out = fitted.join(bounds, "store").withColumns({
        "y_true": unscale(F.col("target"), F.col("v_min"), F.col("v_max")),
        "y_pred": unscale(F.col("prediction"), F.col("v_min"), F.col("v_max"))})
    err = F.col("y_true") - F.col("y_pred")
    metrics = out.where(F.col("is_train") == 0).groupBy("store").agg(
        F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"), F.count(F.lit(1)).alias("test_windows"))
    return out, metrics


def lag_forecast(panel: DataFrame, look_back: int = 14, train_frac: float = 0.85,
                 threshold: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """TS10 for all stores: TS1 -> TS2 -> TS3/TS4 -> TS8 -> TS7 -> K4 -> fit -> TS9 -> RMSE/MAE.

    Returns (per-window predictions in series units, per-store metrics). As in
    the reference, scaling uses the whole series and a differenced store's
    errors are in difference units.
    """
    return series_forecast(store_series(panel), look_back, train_frac, threshold)


def series_forecast(series: DataFrame, look_back: int = 14, train_frac: float = 0.85,
                    threshold: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """:func:`lag_forecast` from the daily series (of :func:`store_series`, or stored)."""
    cut, bounds = lag_windows(series, look_back, train_frac, threshold)
    return _series_errors(fit_lag_regression(cut, look_back), bounds)


def train_lag_epochs(cut: DataFrame, look_back: int = 14, epochs: int = 50, batch_size: int = 32, patience: int = 10,
                     step: float = 0.05, min_delta: float = 1e-7) -> tuple[DataFrame, DataFrame]:
    """The lag model trained by gradient epochs: (weights, history).

    An epoch takes a store's training windows in order, ``batch_size`` at a time, and moves the weights against each
    batch's mean-squared-error gradient. Training stops after ``patience`` epochs without a test loss more than
    ``min_delta`` below the best so far, and the weights of the best epoch are kept. Weights: store, beta (intercept first), epochs, best_epoch;
    history: store, epoch, loss (training windows), val_loss (test windows), both at the epoch's end.

    A task takes one store's windows at a time. The gradient needs a batch's products only and the steps of an epoch are affine in
    the weights, so they are composed once per store and an epoch is one matrix product.
    """
    m = look_back + 1

    def train(windows):
        f, y = _design(windows, look_back)
        f = np.column_stack([f, y])
        is_train = windows["is_train"].to_numpy(zero_copy_only=False) == 1
        batch = np.where(is_train, np.arange(len(f)) // batch_size, -1)
        names = np.unique(batch)
        parts = [f[batch == name] for name in names]
        g, n, learn = np.stack([p.T @ p for p in parts]), np.array([len(p) for p in parts]), names >= 0
        move, shift = np.eye(m), np.zeros(m)
        for a, k in zip(g[learn], n[learn]):
            part = np.eye(m) - 2.0 * step / k * a[:m, :m]
            move, shift = part @ move, part @ shift + 2.0 * step / k * a[:m, m]
        total, test = (g[mask].sum(axis=0) / max(n[mask].sum(), 1) for mask in (learn, ~learn))
        w, history, best = np.zeros(m), [], (math.inf, 0, np.zeros(m))
        if not learn.any() or learn.all():
            return w, history, 0
        for epoch in range(1, epochs + 1):
            w = move @ w + shift
            v = np.append(w, -1.0)
            history.append((epoch, float(v @ total @ v), float(v @ test @ v)))
            if history[-1][2] < best[0] - min_delta:
                best = (history[-1][2], epoch, w)
            elif epoch - best[1] >= patience:
                break
        return best[2], history, best[1]

    kinds = pa.schema([("store", pa.int64()), ("beta", pa.list_(pa.float64())), ("best_epoch", pa.int32()), ("history", pa.list_(
        pa.struct([("epoch", pa.int32()), ("loss", pa.float64()), ("val_loss", pa.float64())])))])

    def run(key, windows):
        beta, history, best = train(_in_order(windows, "t"))
        history = [{"epoch": e, "loss": x, "val_loss": y} for e, x, y in history]
        return pa.Table.from_pylist([{"store": key[0].as_py(), "beta": beta.tolist(), "best_epoch": best, "history": history}], kinds)
    windows = cut.select("store", "t", "x", F.col("target").cast("double").alias("target"), "is_train")
    trained = written(windows.groupBy("store").applyInArrow(run, "store long, beta array<double>, best_epoch int, history array<struct<epoch:int,loss:double,val_loss:double>>"),
                      "lag-training")
    weights = trained.where(F.size("history") > 0).select("store", "beta", F.size("history").alias("epochs"), "best_epoch")
    return weights, trained.select("store", F.explode("history").alias("h")).select("store", "h.*")


def lag_training(series: DataFrame, look_back: int = 14, train_frac: float = 0.85, threshold: float = 0.05, epochs: int = 50,
                 batch_size: int = 32, patience: int = 10, step: float = 0.05) -> tuple[DataFrame, DataFrame, DataFrame]:
    """TS10 with epochs, batches and early stopping, from the daily series (of :func:`store_series`, or stored).

    Returns (per-window predictions in series units, metrics with epochs and best_epoch, loss history). A store without
    both training and test windows has no row."""
    cut, bounds = lag_windows(series, look_back, train_frac, threshold)
    weights, history = train_lag_epochs(cut, look_back, epochs, batch_size, patience, step)
    out, metrics = _series_errors(_lag_predictions(cut, weights.select("store", "beta"), look_back, "inner"), bounds)
    return out, metrics.join(weights.drop("beta"), "store"), history
