"""Joins of the panel to its store dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def has_at_most(df: DataFrame, n: int) -> bool:
    """True when ``df`` has at most ``n`` rows; reads at most n+1 rows to decide."""
    return df.limit(n + 1).count() <= n


STORE_COLUMNS = ["store_type", "assortment", "competition_distance",
                 "competition_open_since_month", "competition_open_since_year",
                 "promo2", "promo2_since_week", "promo2_since_year", "promo_interval"]


def with_store(fact: DataFrame, store: DataFrame, how: str = "left") -> DataFrame:
    """Left equi-join of daily facts to the store dimension on ``store``.

    No hint: the planner broadcasts the dimension while its size in bytes is below the session's
    threshold, AQE decides again from the real size, and a larger one is shuffled."""
    return fact.join(store, on="store", how=how)


def enrich_if_missing(df: DataFrame, store: DataFrame) -> DataFrame:
    """Join the store attributes only when the upload lacks them."""
    if "store_type" in [c.lower() for c in df.columns]:
        return df
    return with_store(df, store)


def store_profile(requests: DataFrame, store: DataFrame) -> DataFrame:
    """Store attributes for a table of requested store ids (bulk lookup)."""
    return requests.select("store").distinct().join(store, "store", "left")
