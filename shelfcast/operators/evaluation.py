"""Metrics, model choice and residual analysis.

All of it is aggregates and projections over a (y, p) table; nothing is
collected. The only ordered outputs are the first-n coverage (an ordered
limit) and the Q-Q points (ranked in value buckets, never in one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.aggregates import exact_mean
from shelfcast.functions.stats import norm_pdf, with_inv_norm_cdf
from shelfcast.operators.eda import histogram
from shelfcast.session import written

EPS = 2.220446049250313e-16  # float64 machine epsilon, the MAPE floor


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rmspe(y="y", p="p") -> Column:
    """M3: root mean squared percentage error x 100; rows with y = 0 are left out."""
    y, p = _c(y), _c(p)
    return F.sqrt(F.avg(F.when(y != 0, F.pow((y - p) / y, 2)))) * 100


def regression_metrics(df: DataFrame, y: str = "y", p: str = "p", by: list[str] = ()) -> DataFrame:
    """M4: RMSE, MAE, MAPE (%), RMSPE (%), R^2 in one aggregation (optionally per group)."""
    yc, pc = F.col(y).cast("double"), F.col(p).cast("double")
    err = yc - pc
    agg = [F.sqrt(F.avg(err * err)).alias("rmse"),
           F.avg(F.abs(err)).alias("mae"),
           (F.avg(F.abs(err) / F.greatest(F.abs(yc), F.lit(EPS))) * 100).alias("mape"),
           rmspe(yc, pc).alias("rmspe"),
           F.sum(err * err).alias("_sse"),
           (F.var_pop(yc) * F.count(yc)).alias("_sst"),
           F.count(F.lit(1)).alias("rows")]
    out = df.groupBy(*by).agg(*agg) if by else df.agg(*agg)
    r2 = (F.when(F.col("_sst") != 0, 1 - F.col("_sse") / F.col("_sst"))
          .when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return out.withColumn("r2", r2).drop("_sse", "_sst")


def pick_winner(metrics: DataFrame, preferred_on_tie: str = "GradientBoosting") -> DataFrame:
    """M6: the model with the lower RMSPE; on a tie the ``preferred_on_tie`` model wins."""
    key = F.struct(F.col("rmspe"), (F.col("model") != preferred_on_tie).cast("int"))
    return metrics.agg(F.min_by("model", key).alias("best_model"), F.min("rmspe").alias("best_rmspe"))


def residual_std(df: DataFrame, y: str = "y", p: str = "p") -> Column:
    return df.agg(F.stddev_pop(F.col(y) - F.col(p))).scalar()


def confidence_band(df: DataFrame, y: str = "y", p: str = "p", z: float = 1.96) -> DataFrame:
    """M8: p +- z * population std of all residuals."""
    s = residual_std(df, y, p)
    return df.withColumns({"ci_lo": F.col(p) - z * s, "ci_hi": F.col(p) + z * s,
                           "inside": ((F.col(y) >= F.col(p) - z * s) & (F.col(y) <= F.col(p) + z * s)).cast("int")})


def coverage(df: DataFrame, order: list[str], n: int = 150, y: str = "y", p: str = "p",
             z: float = 1.96) -> DataFrame:
    """M9: % of actuals inside the band on the first ``n`` rows (and on all rows)."""
    band = confidence_band(df, y, p, z)
    first = band.orderBy(*order).limit(n).agg(F.avg("inside").alias("first_n"))
    full = band.agg(F.avg("inside").alias("all_rows"))
    return first.select((F.col("first_n") * 100).alias("coverage_first_n"), F.lit(n).alias("n"),
                        (full.scalar() * 100).alias("coverage_all"))


def residuals(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """M10."""
    return df.withColumn("residual", F.col(y) - F.col(p))


def residual_hist(df: DataFrame, bins: int = 70, y: str = "y", p: str = "p") -> DataFrame:
    """Residual density histogram."""
    return histogram(residuals(df, y, p), "residual", bins, density=True)


def normal_curve(df: DataFrame, points: int = 200, y: str = "y", p: str = "p") -> DataFrame:
    """Fitted normal pdf (mean, population std) on an even grid over the residual range."""
    r = F.col(y) - F.col(p)
    st = df.agg(F.avg(r).alias("mu"), F.stddev_pop(r).alias("sigma"), F.min(r).alias("lo"), F.max(r).alias("hi"))
    grid = st.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1)
    return grid.select("i", x.alias("x"), norm_pdf(x, F.col("mu"), F.col("sigma")).alias("pdf"))


def qq_points(df: DataFrame, y: str = "y", p: str = "p", rows_per_bucket: int = 1_000_000,
              chunk: int = 1_000_000, buckets: int | None = None) -> DataFrame:
    """Normal Q-Q points (Filliben order-statistic medians) and the least-squares line.

    Ranks are never taken with one task over all rows:
    residuals are first collapsed to (value, count) pairs (a partial
    aggregate, so a value repeated a billion times is one pair); the pairs
    are range-partitioned, numbered by a running count inside each partition plus the counts of
    the partitions below, and each pair expands to its rank range (one count per
    ``rows_per_bucket`` pairs is gathered). A pair whose range is longer than ``chunk`` is split into chunks that are spread over
    tasks before expanding.
    """
    r = residuals(df, y, p).select(F.col("residual").alias("v")).where(F.col("v").isNotNull())
    vc = written(r.groupBy("v").agg(F.count(F.lit(1)).alias("c")), "qq-values")
    head = vc.agg(F.count(F.lit(1)).alias("k"), F.sum("c").alias("n")).first()
    k, n = int(head["k"] or 0), int(head["n"] or 0)
    # every later step reads these pairs and their partition, not the predictions
    bucketed = written(vc.repartitionByRange(buckets or 8 + k // rows_per_bucket, "v").withColumn("_b", F.spark_partition_id()), "qq-ranges")
    inner = Window.partitionBy("_b").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = bucketed.withColumn("_cum", F.sum("c").over(inner))
    totals = bucketed.groupBy("_b").agg(F.sum("c").alias("_t"))
    below = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    offsets = totals.select("_b", F.coalesce(F.sum("_t").over(below), F.lit(0)).alias("_off"))
    ranged = numbered.join(offsets, "_b").select(
        "v", "c", (F.col("_off") + F.col("_cum") - F.col("c")).alias("_o"))
    # Expand each pair to its ranks; long ranges are chunked and redistributed first.
    ranged = ranged.withColumn("_nch", F.ceil(F.col("c") / F.lit(chunk)).cast("int"))
    chunks = ranged.select("v", "c", "_o", F.explode(F.sequence(F.lit(0), F.col("_nch") - 1)).alias("_ch"))
    hot = chunks.where(F.col("c") > chunk).repartition("v", "_ch")
    spans = chunks.where(F.col("c") <= chunk).unionByName(hot)
    lo = F.col("_o") + 1 + F.col("_ch") * chunk
    hi = F.least(F.col("_o") + F.col("c"), lo + chunk - 1)
    ranks = spans.select(F.explode(F.sequence(lo, hi)).alias("i"), F.col("v").alias("ordered"))
    last = F.pow(F.lit(0.5), 1.0 / n) if n else F.lit(None)
    m = (F.when(F.col("i") == n, last).when(F.col("i") == 1, 1 - last)
         .otherwise((F.col("i") - 0.3175) / (n + 0.365)))
    pts = with_inv_norm_cdf(ranks.withColumn("_m", m), "_m", "theoretical").select("i", "theoretical", "ordered")
    fit = pts.agg(F.regr_slope("ordered", "theoretical").alias("slope"),
                  F.regr_intercept("ordered", "theoretical").alias("intercept"),
                  F.corr("ordered", "theoretical").alias("r")).first()  # three numbers
    return pts.withColumns({c: F.lit(fit[c]).cast("double") for c in ("slope", "intercept", "r")})


class StoreMeanModel:
    """A deterministic reference predictor (mean of the training target per key) with a pipeline's
    ``transform``: it lets the metric, band and scoring operators be compared with SQL."""

    def __init__(self, train: DataFrame, y: str = "sales", keys: tuple[str, ...] = ("store",)):
        self.keys = list(keys)
        self.means = train.groupBy(*self.keys).agg(exact_mean(y).alias("prediction"))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.join(self.means, self.keys, "left").withColumn("prediction", F.coalesce("prediction", F.lit(0.0)))


def store_mean_predictions(train: DataFrame, val: DataFrame, y: str = "sales",
                           keys: list[str] = ("store",)) -> DataFrame:
    """Predictions ``p`` of :class:`StoreMeanModel` on ``val``."""
    return StoreMeanModel(train, y, tuple(keys)).transform(val).withColumnRenamed("prediction", "p")
