"""Scoring paths: horizon submission, what-if forecasts, uploaded batches.

Each path is one job over all requested rows: closed rows get 0 without
touching the model, open rows go through ``PipelineModel.transform``, and
the two are a union of two filters of the same input (no shuffle).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.display import clean_prediction, display_date, display_money, yes_no
from shelfcast.operators.clean import drop_present
from shelfcast.operators.eda import histogram
from shelfcast.operators.joins import enrich_if_missing


def score_rows(model: PipelineModel, df: DataFrame, out: str = "predicted_sales") -> DataFrame:
    """F4 + F15 + X22: open rows scored and cleaned, closed rows 0."""
    rows = df.withColumn("open", F.coalesce(F.col("open"), F.lit(1)))
    closed = rows.where(F.col("open") == 0).withColumn(out, F.lit(0.0))
    # The feature stage rewrites and drops columns; the request's own columns
    # ride along under private names (no join back, no shuffle).
    carried = rows.where(F.col("open") != 0).select(
        *rows.columns, *[F.col(c).alias(f"__in_{c}") for c in rows.columns])
    opened = model.transform(carried).select(
        *[F.col(f"__in_{c}").alias(c) for c in rows.columns],
        clean_prediction(F.col("prediction")).alias(out))
    return opened.unionByName(closed)


def submission(model: PipelineModel, horizon_panel: DataFrame) -> DataFrame:
    """M13 / S5 contents: (id, sales) for every horizon row."""
    scored = score_rows(model, drop_present(horizon_panel, "customers", "sales"), "sales")
    return scored.select("id", "sales")


def submission_summary(sub: DataFrame, col: str = "sales") -> DataFrame:
    """G17."""
    return sub.agg(F.count(F.lit(1)).alias("rows"), F.min(col).alias("min"), F.avg(col).alias("mean"),
                   F.max(col).alias("max"))


def forecast_calendar(horizon: DataFrame, requests: DataFrame, weeks_col: str = "weeks") -> DataFrame:
    """For each request, the last 7*weeks days ending at the horizon's last date."""
    last = horizon.agg(F.max("date")).scalar()
    n = F.col(weeks_col) * 7
    days = F.sequence(F.date_sub(last, n - 1), last)
    return requests.withColumn("date", F.explode(days))


def forecast_requests(horizon: DataFrame, store: DataFrame, requests: DataFrame) -> DataFrame:
    """What-if rows: fixed promo and school-holiday flags, no state holiday,
    closed on Sunday unless the store type is 'b'; day_of_week 1..7."""
    cal = forecast_calendar(horizon, requests)
    joined = cal.join(store, "store", "left")
    dow = F.weekday("date") + 1
    return joined.withColumns({
        "day_of_week": dow,
        "open": F.when((dow == 7) & (F.coalesce(F.col("store_type"), F.lit("")) != "b"), 0).otherwise(1),
        "state_holiday": F.lit("None"),
    })


def scenario_forecast(model: PipelineModel, horizon: DataFrame, store: DataFrame,
                      requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Score every request's calendar; returns (daily rows, per-request summary G18)."""
    keys = [c for c in requests.columns if c != "weeks"]
    rows = forecast_requests(horizon, store, requests)
    scored = score_rows(model, rows, "predicted_sales")
    daily = scored.select(*keys, "date", "open", "predicted_sales",
                          display_date("date").alias("date_label"), yes_no("open").alias("open_label"),
                          display_money("predicted_sales").alias("predicted_label"))
    p = F.col("predicted_sales")
    summary = scored.groupBy(*keys).agg(
        F.sum(p).alias("total"),
        F.coalesce(F.avg(F.when(p > 0, p)), F.lit(0.0)).alias("daily_mean"),
        F.max(p).alias("peak"))
    return daily, summary


def batch_score(model: PipelineModel, upload: DataFrame, store: DataFrame) -> DataFrame:
    """M17 / S7 contents: [id,] date, store, predicted_sales for an uploaded table.

    The upload is enriched only when it lacks store attributes (J2), leak
    columns are dropped (F12), and the feature stage fills what is missing.
    """
    has_id = "id" in [c.lower() for c in upload.columns]
    rows = enrich_if_missing(upload, store)
    rows = drop_present(rows, "customers", "sales")
    scored = score_rows(model, rows, "predicted_sales")
    return scored.select(*(["id"] if has_id else []), "date", "store", "predicted_sales")


def batch_summary(scored: DataFrame) -> DataFrame:
    """G19."""
    p = F.col("predicted_sales")
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.sum(p).alias("total"), F.avg(p).alias("mean"))


def batch_histogram(scored: DataFrame, bins: int = 60) -> DataFrame:
    """G16 on scored predictions (60 bins)."""
    return histogram(scored, "predicted_sales", bins)
