"""Hand-worked boundary cases for the calendar features, bands and cleaning rules."""

import datetime as dt

from pyspark.sql import functions as F


def _one(spark, col, d):
    return spark.createDataFrame([(d,)], "date date").select(col.alias("v")).first()["v"]


def test_christmas_boundaries(spark):
    from shelfcast.functions.calendar import days_to_christmas
    c = days_to_christmas("date")
    assert _one(spark, c, dt.date(2015, 12, 25)) == 0
    assert _one(spark, c, dt.date(2015, 12, 26)) == 365  # next year's Christmas (2016 is a leap year)
    assert _one(spark, c, dt.date(2015, 12, 24)) == 1


def test_easter_table_and_fallback(spark):
    from shelfcast.functions.calendar import days_to_easter
    c = days_to_easter("date")
    assert _one(spark, c, dt.date(2014, 4, 20)) == 0
    assert _one(spark, c, dt.date(2016, 3, 20)) == 7
    assert _one(spark, c, dt.date(2017, 4, 16)) == 15  # not in the table: April 1 is used


def test_iso_week_53_flags(spark):
    from shelfcast.functions.calendar import date_feature_columns
    f = date_feature_columns("date")
    d = dt.date(2015, 12, 31)  # ISO week 53
    assert _one(spark, f["week_of_year"], d) == 53 and _one(spark, f["is_year_end"], d) == 1
    d = dt.date(2016, 1, 3)  # still ISO week 53 of 2015
    assert _one(spark, f["is_year_end"], d) == 1 and _one(spark, f["is_year_start"], d) == 0
    d = dt.date(2018, 12, 31)  # ISO week 1 of 2019
    assert _one(spark, f["is_year_start"], d) == 1


def test_promo2_tokens(spark):
    from shelfcast.functions.calendar import promo2_active
    rows = [(1, "Jan, Apr,Jul,Oct", 4), (1, "Mar,Jun,Sept,Dec", 9), (1, "Mar,Jun,Sep,Dec", 9), (0, "Jan", 1),
            (1, "", 1)]
    df = spark.createDataFrame(rows, "promo2 int, pi string, m int")
    got = [r[0] for r in df.select(promo2_active("promo2", "pi", "m")).collect()]
    assert got == [1, 0, 1, 0, 0]


def test_distance_band_edges(spark):
    from shelfcast.functions.display import distance_band
    df = spark.createDataFrame([(0.0,), (500.0,), (500.5,), (5000.0,), (5000.1,), (None,)], "d double")
    assert [r[0] for r in df.select(distance_band("d")).collect()] == [None, "<500m", "500m-1km", "2-5km",
                                                                       ">5km", None]


def test_clean_rules_and_missing_store(spark):
    from shelfcast.operators.clean import prepare
    fact = spark.createDataFrame(
        [(1, dt.date(2015, 1, 2), 5, 10.0, 2, None, 0, "0", 0),
         (1, dt.date(2015, 1, 3), 6, 0.0, 0, 1, 0, "a", 0),
         (9, dt.date(2015, 1, 3), 6, 7.0, 1, 1, 1, None, 0)],
        "store long, date date, day_of_week int, sales double, customers long, open int, promo int, "
        "state_holiday string, school_holiday int")
    store = spark.createDataFrame([(1, "a", "a", None, None, None, 0, None, None, None)],
                                  "store long, store_type string, assortment string, competition_distance double, "
                                  "competition_open_since_month int, competition_open_since_year int, promo2 int, "
                                  "promo2_since_week int, promo2_since_year int, promo_interval string")
    panel, open_panel = prepare(fact, store)
    rows = {(r["store"], r["date"].day): r for r in panel.collect()}
    assert rows[(1, 2)]["open"] == 1 and rows[(1, 2)]["state_holiday"] == "None"
    assert rows[(9, 3)]["state_holiday"] == "nan" and rows[(9, 3)]["store_type"] is None
    assert rows[(1, 2)]["promo_interval"] == "" and rows[(1, 2)]["competition_open_since_year"] == 0
    assert rows[(1, 2)]["competition_distance"] is None  # no distance anywhere: nothing to fill with
    assert sorted((r["store"], r["date"].day) for r in open_panel.collect()) == [(1, 2), (9, 3)]


def test_row_weighted_median(spark):
    from shelfcast.operators.clean import row_weighted_median
    fact = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,)], "store long")
    store = spark.createDataFrame([(1, 100.0), (2, 300.0), (3, None)], "store long, competition_distance double")
    # joined distances: 100, 100, 100, 300 (store 3 has none) -> median 100
    assert spark.range(1).select(row_weighted_median(fact, store)).first()[0] == 100.0
