"""Exploratory aggregates over the open panel.

Every aggregate is a hash aggregate with map-side partial aggregation, so a
hot store or a hot date is combined before the shuffle. Group counts are
bounded by calendar or category sizes (days, months, weekdays, store types,
bands), except G11 which counts distinct stores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.aggregates import MONEY, count_mean, exact_mean, lift_pct
from shelfcast.functions.display import (ASSORTMENT_LABELS, DISTANCE_LABELS, WEEKDAY_NAMES,
                                         assortment_label, distance_band_index,
                                         spend_per_customer)
from shelfcast.operators.quantiles import exact_median


def daily_mean_sales(open_panel: DataFrame) -> DataFrame:
    """G1: mean sales per date."""
    return open_panel.groupBy("date").agg(exact_mean("sales").alias("mean_sales"))


def promo_lift(open_panel: DataFrame, value: str = "sales") -> DataFrame:
    """Mean without and with promo and the lift in percent, one pass."""
    mean = exact_mean if value == "sales" else count_mean
    p = F.col("promo") == 1
    q = F.col("promo") == 0
    out = open_panel.agg(mean(value, q).alias("mean_no_promo"),
                         mean(value, p).alias("mean_promo"))
    return out.withColumn("lift_pct", lift_pct(F.col("mean_promo"), F.col("mean_no_promo")))


def monthly_mean(open_panel: DataFrame) -> DataFrame:
    """Mean sales by (year, month)."""
    return (open_panel.groupBy(F.year("date").alias("year"), F.month("date").alias("month"))
            .agg(exact_mean("sales").alias("mean_sales")))


def _spine(spark, labels: list[str], name: str) -> DataFrame:
    """A fixed display axis (index, label) to left-join an aggregate onto."""
    arr = F.array(*[F.lit(x) for x in labels])
    return spark.range(len(labels)).select(F.col("id").cast("int").alias("idx"),
                                           F.element_at(arr, F.col("id").cast("int") + 1).alias(name))


def weekday_mean(open_panel: DataFrame) -> DataFrame:
    """Mean sales per weekday name, Monday..Sunday; a weekday with no rows stays as null."""
    agg = (open_panel.groupBy(F.weekday("date").alias("idx"))
           .agg(exact_mean("sales").alias("mean_sales")))
    spine = _spine(open_panel.sparkSession, WEEKDAY_NAMES, "weekday")
    return spine.join(agg, "idx", "left").select("idx", "weekday", "mean_sales")


def store_type_mean(open_panel: DataFrame) -> DataFrame:
    """Mean sales per store type, highest first."""
    return (open_panel.groupBy("store_type").agg(exact_mean("sales").alias("mean_sales"))
            .orderBy(F.desc("mean_sales")))


def assortment_mean(open_panel: DataFrame) -> DataFrame:
    """Mean sales per assortment label, fixed order Basic/Extra/Extended."""
    agg = (open_panel.groupBy(assortment_label("assortment").alias("assortment_label"))
           .agg(exact_mean("sales").alias("mean_sales")))
    spine = _spine(open_panel.sparkSession, [lbl for _, lbl in ASSORTMENT_LABELS], "assortment_label")
    return spine.join(agg, "assortment_label", "left").select("idx", "assortment_label", "mean_sales")


def distance_band_mean(open_panel: DataFrame) -> DataFrame:
    """G8 (with F10): mean sales per right-closed distance band; empty bands absent."""
    banded = (open_panel.na.drop(subset=["competition_distance"])
              .withColumn("idx", distance_band_index("competition_distance"))
              .where(F.col("idx").isNotNull()))
    labels = F.array(*[F.lit(x) for x in DISTANCE_LABELS])
    return (banded.groupBy("idx").agg(exact_mean("sales").alias("mean_sales"))
            .select("idx", F.element_at(labels, F.col("idx") + 1).alias("band"), "mean_sales"))


def promo_share(train: DataFrame, test: DataFrame) -> DataFrame:
    """Promo value counts and shares (%) over all rows, train vs test."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy("promo").agg(F.count(F.lit(1)).alias("rows"))
        total = df.agg(F.count(F.lit(1))).scalar()
        return counts.select(F.lit(name).alias("dataset"), "promo", "rows",
                             (F.col("rows") * 100.0 / total).alias("share_pct"))
    return shares(train, "train").unionByName(shares(test, "test"))


def with_spend(open_panel: DataFrame) -> DataFrame:
    return open_panel.withColumn("spc", spend_per_customer("sales", "customers"))


def spend_medians(open_panel: DataFrame, max_spend: float = 30.0) -> DataFrame:
    """Median spend per customer overall (below ``max_spend``) and by promo (no cut), in one pass."""
    spc = with_spend(open_panel).select("promo", "spc").where(F.col("spc").isNotNull())
    whole = F.col("_whole")  # true: the row in the cut whole, false: the row in its promo group
    both = spc.select("spc", "promo", F.explode(F.array(F.when(F.col("spc") < max_spend, True), F.lit(False))).alias("_whole")) \
        .where(whole.isNotNull()).select(F.when(whole, "all_below_cut").otherwise("by_promo").alias("subset"),
                                         F.when(~whole, F.col("promo").cast("int")).alias("promo"), "spc")
    return exact_median(both, "spc", by=["subset", "promo"])


def histogram(df: DataFrame, col: str, bins: int, density: bool = False) -> DataFrame:
    """Equal-width histogram over [min, max], every bin (empty ones count 0); the last bin is closed.

    min/max/count come from one merged scalar-subquery aggregate; the binning
    is a partial-aggregated group-by on at most ``bins`` keys. A column without values has no bins.
    """
    x = F.col(col)
    vals = df.where(x.isNotNull())
    stats = vals.agg(F.min(x).alias("mn"), F.max(x).alias("mx"), F.count(x).alias("n"))
    mn, mx, n = stats.select("mn").scalar(), stats.select("mx").scalar(), stats.select("n").scalar()
    raw = F.floor(F.try_divide((x - mn) * bins, mx - mn))
    idx = F.least(F.coalesce(raw, F.lit(0)).cast("int"), F.lit(bins - 1))
    counted = vals.select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (F.col("mx") - F.col("mn")) / bins
    out = (every.join(counted, "bin", "left").withColumns({"mn": mn, "mx": mx, "n": n})
           .where(F.col("n") > 0)
           .select("bin", (F.col("mn") + F.col("bin") * width).alias("lo"),
                   (F.col("mn") + (F.col("bin") + 1) * width).alias("hi"),
                   F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), "n", width.alias("_width")))
    if density:
        out = out.withColumn("density", F.try_divide(F.col("count").cast("double"), F.col("n") * F.col("_width")))
    return out.drop("n", "_width")


def spend_histogram(open_panel: DataFrame, max_spend: float = 30.0, bins: int = 50) -> DataFrame:
    return histogram(with_spend(open_panel).where(F.col("spc") < max_spend), "spc", bins)


def distinct_stores(df: DataFrame) -> DataFrame:
    """G11."""
    return df.agg(F.count_distinct("store").alias("stores"))


def kpis(panel: DataFrame) -> DataFrame:
    """Rows, mean open-day sales, promo lift and stores in one pass over the clean panel.

    Sums are taken per store first, so counting the stores needs no second copy of the rows."""
    is_open = (F.col("open") == 1) & (F.col("sales") > 0)
    parts = {"": is_open, "_promo": is_open & (F.col("promo") == 1), "_plain": is_open & (F.col("promo") == 0)}
    sales = F.col("sales")
    money = sales.cast(MONEY)
    per_store = panel.groupBy("store").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(F.when(w, money)).alias(f"_m{k}") for k, w in parts.items()],
        *[F.sum(F.when(w, sales - money.cast("double"))).alias(f"_r{k}") for k, w in parts.items()],
        *[F.count_if(w & sales.isNotNull()).alias(f"_n{k}") for k, w in parts.items()])

    def mean(k: str) -> Column:
        return F.try_divide(F.sum(f"_m{k}").cast("double") + F.sum(f"_r{k}"), F.sum(f"_n{k}").cast("double"))
    out = per_store.agg(F.sum("_rows").alias("rows"), mean("").alias("mean_sales"), mean("_promo").alias("_m1"),
                        mean("_plain").alias("_m0"), F.count("store").alias("stores"))
    return out.select(F.coalesce("rows", F.lit(0)).alias("rows"), "mean_sales",
                      lift_pct(F.col("_m1"), F.col("_m0")).alias("lift_pct"), "stores")


CORR_COLUMNS = ["sales", "customers", "promo", "school_holiday"]


def corr_matrix(open_panel: DataFrame, cols: list[str] = CORR_COLUMNS) -> DataFrame:
    """Pearson matrix of ``cols`` from one aggregation, unpivoted to (row, col, r)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    agg = open_panel.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                           for a, b in pairs])
    cells = []
    for a in cols:
        for b in cols:
            if a == b:
                cells.append(F.struct(F.lit(a).alias("row_var"), F.lit(b).alias("col_var"),
                                      F.lit(1.0).alias("r")))
            else:
                name = f"{a}__{b}" if (a, b) in pairs else f"{b}__{a}"
                cells.append(F.struct(F.lit(a).alias("row_var"), F.lit(b).alias("col_var"),
                                      F.col(name).alias("r")))
    return agg.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def sales_fit_line(open_panel: DataFrame, points: int = 100) -> DataFrame:
    """Least-squares line of sales on customers, plus ``points`` evenly spaced line points."""
    x, y = F.col("customers").cast("double"), F.col("sales")
    fit = open_panel.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                         F.corr(y, x).alias("r"), F.min(x).alias("x_min"), F.max(x).alias("x_max"))
    grid = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    px = F.col("x_min") + F.col("i") * (F.col("x_max") - F.col("x_min")) / (points - 1)
    return grid.select("i", "slope", "intercept", "r", px.alias("x"),
                       (F.col("slope") * px + F.col("intercept")).alias("y"))
