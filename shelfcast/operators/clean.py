"""Cleaning and filtering of the joined panel (F1-F16, S3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.joins import with_store
from shelfcast.operators.quantiles import exact_median

ZERO_FILLED = ["competition_open_since_month", "competition_open_since_year",
               "promo2_since_week", "promo2_since_year"]


def row_weighted_median(fact: DataFrame, store: DataFrame, col: str = "competition_distance") -> Column:
    """F1's fill value: the median of a store attribute over the *fact rows*.

    Equal to the median of the joined column, but computed on one row per
    store weighted by its fact count, so the full panel is never sorted or
    shipped, and in value buckets, so no task holds all distinct values.
    Returned as a scalar subquery column (null when every value is null).
    """
    counts = fact.groupBy("store").agg(F.count(F.lit(1)).alias("_n"))
    weighted = counts.join(store.select("store", col), "store")
    return exact_median(weighted, col, weight="_n").scalar()


def state_holiday_label(c="state_holiday") -> Column:
    """exact value "0" becomes "None"; a missing value prints as "nan"."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "0", F.lit("None")).otherwise(F.coalesce(c.cast("string"), F.lit("nan")))


def clean(panel: DataFrame, distance_fill: Column | None = None) -> DataFrame:
    """F1-F5 on a joined panel (train or horizon).

    ``distance_fill`` defaults to the median of the panel's own distance
    column (one scalar subquery), which is what the reference does per table.
    """
    if distance_fill is None:
        distance_fill = exact_median(panel, "competition_distance").scalar()
    out = panel.withColumns({
        "competition_distance": F.coalesce(F.col("competition_distance"), distance_fill),
        **{c: F.coalesce(F.col(c), F.lit(0)) for c in ZERO_FILLED},
        "promo_interval": F.coalesce(F.col("promo_interval"), F.lit("")),
        "open": F.coalesce(F.col("open"), F.lit(1)),
        "state_holiday": state_holiday_label("state_holiday"),
    })
    return out


def open_predicate() -> Column:
    return (F.col("open") == 1) & (F.col("sales") > 0)


def open_days(panel: DataFrame) -> DataFrame:
    """open days with positive sales."""
    return panel.where(open_predicate())


def open_filter_counts(panel: DataFrame) -> DataFrame:
    """rows kept and removed by F6, in one pass."""
    keep = open_predicate()
    return panel.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(keep).alias("kept"),
        F.count_if(~keep | keep.isNull()).alias("removed"))


def null_counts(df: DataFrame) -> DataFrame:
    """F8: nulls per column and in total, one aggregation pass."""
    per = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    counted = df.agg(*per)
    total = sum((F.col(c) for c in df.columns), F.lit(0).cast("bigint"))
    return counted.select(total.cast("bigint").alias("missing_total"), *df.columns)


def profile(df: DataFrame, date_col: str = "date") -> DataFrame:
    """S3: row count, column count, date range."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("columns"),
                  F.min(date_col).alias("first_date"),
                  F.max(date_col).alias("last_date"))


def drop_present(df: DataFrame, *cols: str) -> DataFrame:
    """drop columns that exist, ignore the rest."""
    present = {c.lower() for c in df.columns}
    return df.drop(*[c for c in cols if c.lower() in present])


def prepare(fact: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F16: join, clean and filter; returns (clean panel, open panel).

    Everything stays one lazy plan: Catalyst pushes ``sales > 0`` below the
    join onto the fact scan for the open panel.
    """
    joined = with_store(fact, store)
    panel = clean(joined, row_weighted_median(fact, store))
    return panel, open_days(panel)
