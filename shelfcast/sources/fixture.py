"""Adapter from the driver's star-schema tables to the store x day panel.

A store is a supplier; a fact row is one supplier on one ship date. The rules
are fixed so that the same statements run in Spark and in DuckDB (see
``shelfcast.oracle``), and they deliberately produce nulls in every nullable
dimension column, closed days, null ``open`` flags, every distance band and
the unknown ``"Sept"`` promo token.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators.ordering import global_row_number
from shelfcast.session import written

MONEY = "decimal(18,4)"
HORIZON_DAYS = 42  # six weeks, the forecast horizon
LINES_PER_TASK = 250_000  # line items that one task groups where there are more than the cores would bring in


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store_dimension(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    interval = (F.when(k % 2 == 0, F.lit(None).cast("string"))
                .when(k % 3 == 0, "Jan,Apr,Jul,Oct")
                .when(k % 3 == 1, "Feb,May,Aug,Nov")
                .otherwise("Mar,Jun,Sept,Dec"))
    return supplier.select(
        k.alias("store"),
        F.substring(F.lit("abcd"), (k % 4 + 1).cast("int"), 1).alias("store_type"),
        F.substring(F.lit("abc"), (F.col("s_nationkey") % 3 + 1).cast("int"), 1).alias("assortment"),
        F.when(k % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.round(F.abs(F.col("s_acctbal")), 0)).alias("competition_distance"),
        F.when(k % 5 == 0, F.lit(None).cast("int"))
         .otherwise((k % 12 + 1).cast("int")).alias("competition_open_since_month"),
        F.when(k % 5 == 0, F.lit(None).cast("int"))
         .otherwise((1992 + k % 9).cast("int")).alias("competition_open_since_year"),
        (k % 2).cast("int").alias("promo2"),
        F.when(k % 2 == 1, (k % 52 + 1).cast("int")).alias("promo2_since_week"),
        F.when(k % 2 == 1, (1994 + k % 6).cast("int")).alias("promo2_since_year"),
        interval.alias("promo_interval"),
    )


def daily_facts(lineitem: DataFrame) -> DataFrame:
    """One row per (supplier, ship day): net revenue as sales, quantity as customers.

    Line items of a table that grows are dealt by supplier and day to a growing number of tasks, so what a task
    holds does not grow and a supplier holding a third of all line items never lands whole on one task. A small
    table's are grouped where they are read and once more behind the shuffle.
    """
    d = F.col("l_shipdate").cast("date")
    li = lineitem.select(
        F.col("l_suppkey"), d.alias("d"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(MONEY).alias("net"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.when(F.col("l_discount") >= 0.06, 1).otherwise(0).alias("pr"))
    tasks = math.ceil(lineitem.count() / LINES_PER_TASK)
    if tasks > lineitem.sparkSession.sparkContext.defaultParallelism:
        li = li.repartition(tasks, "l_suppkey", "d")
    a = li.groupBy("l_suppkey", "d").agg(
        F.sum("net").cast("double").alias("net"),
        F.sum("qty").cast("bigint").alias("qty"),
        F.max("pr").alias("pr"))
    day = F.dayofmonth("d")
    op = (F.when((day % 7 == 0) & (F.col("l_suppkey") % 4 != 1), F.lit(0))
          .when((F.col("l_suppkey") + day) % 29 == 0, F.lit(None).cast("int"))
          .otherwise(F.lit(1)))
    b = a.withColumn("op", op)
    closed = F.col("op") == 0
    holiday = (F.when((F.month("d") == 12) & day.isin(25, 26), "c")
               .when(day == 1, "a")
               .when((F.month("d") == 4) & (day <= 3), "b")
               .otherwise("0"))
    return b.select(
        F.col("l_suppkey").alias("store"),
        F.col("d").alias("date"),
        (F.weekday("d") + 1).alias("day_of_week"),
        F.when(closed, F.lit(0.0)).otherwise(F.col("net")).alias("sales"),
        F.when(closed, F.lit(0).cast("bigint")).otherwise(F.col("qty")).alias("customers"),
        F.col("op").alias("open"),
        F.col("pr").alias("promo"),
        holiday.alias("state_holiday"),
        F.when(F.month("d").isin(7, 8), 1).otherwise(0).alias("school_holiday"),
    )


def horizon_cutoff(lineitem: DataFrame, days: int = HORIZON_DAYS) -> Column:
    """First horizon day, ``max(ship date) - days``, as a literal of the raw column's type.

    One small job over the pruned date column; a literal on the raw column is pushed
    to the scan, so history and horizon read only their own row groups."""
    last = lineitem.agg(F.max(F.col("l_shipdate").cast("date"))).first()[0]
    day = F.lit(None if last is None else last - dt.timedelta(days=days)).cast("date")
    return day.cast(lineitem.schema["l_shipdate"].dataType)


@dataclass
class Panel:
    """The three inputs of the reference pipeline, lazily defined."""
    fact: DataFrame      # history ("train"): facts before the horizon
    store: DataFrame     # store dimension
    horizon: DataFrame   # rows to forecast ("test"): no sales, no customers, with id


def load_panel(spark: SparkSession, sf_dir: str, days: int = HORIZON_DAYS, stored: bool = False) -> Panel:
    """The panel's inputs. ``stored`` writes the daily facts and the horizon to shared storage first, for
    work that reads them several times (model fits, quantiles, series): the line items are then read once."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    cutoff = horizon_cutoff(lineitem, days)
    history = daily_facts(lineitem.where(F.col("l_shipdate") < cutoff))
    future = daily_facts(lineitem.where(F.col("l_shipdate") >= cutoff)).drop("sales", "customers")
    if stored:
        history, future = written(history, "facts"), written(future, "horizon")
    horizon = global_row_number(future, ["store", "date"], "id", partition_col="store")
    store = store_dimension(read_table(spark, sf_dir, "supplier"))
    cols = ["id"] + [c for c in future.columns]
    return Panel(fact=history, store=store, horizon=horizon.select(*cols))
