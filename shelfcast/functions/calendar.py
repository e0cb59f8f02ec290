"""Calendar, holiday, promotion and competition features (X1-X17) as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's for identical features):
# Easter Sunday for the years the reference knows; any other year falls back to April 1.
EASTER_DATES = {2013: "2013-03-31", 2014: "2014-04-20", 2015: "2015-04-05", 2016: "2016-03-27"}
EASTER_FALLBACK_MONTH, EASTER_FALLBACK_DAY = 4, 1
# The three-letter month names recognised in a promo interval list.
MONTH_ABBREVIATIONS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
                       "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
# Day-of-month limits of the month position flags; Christmas day.
MONTH_START_LAST_DAY, MONTH_MID_LAST_DAY = 5, 20
CHRISTMAS_MONTH, CHRISTMAS_DAY = 12, 25


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def weekday0(d) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(d))


def iso_week(d) -> Column:
    return F.weekofyear(_c(d))


def flag(pred: Column) -> Column:
    return pred.cast("int")


def days_to_christmas(d) -> Column:
    d = _c(d)
    y = F.year(d)
    this_year = F.make_date(y, F.lit(CHRISTMAS_MONTH), F.lit(CHRISTMAS_DAY))
    next_year = F.make_date(y + 1, F.lit(CHRISTMAS_MONTH), F.lit(CHRISTMAS_DAY))
    return F.datediff(F.when(d > this_year, next_year).otherwise(this_year), d)


def days_after_new_year(d) -> Column:
    return F.dayofyear(_c(d)) - 1


def easter_date(year: Column) -> Column:
    expr = None
    for y, day in EASTER_DATES.items():
        expr = (F.when(year == y, F.lit(day).cast("date")) if expr is None
                else expr.when(year == y, F.lit(day).cast("date")))
    return expr.otherwise(F.make_date(year, F.lit(EASTER_FALLBACK_MONTH), F.lit(EASTER_FALLBACK_DAY)))


def days_to_easter(d) -> Column:
    d = _c(d)
    return F.abs(F.datediff(easter_date(F.year(d)), d))


def promo2_active(promo2, promo_interval, month) -> Column:
    """1 when the row's month is listed in the store's promo interval.

    Tokens are trimmed and matched against the strict three-letter names, so an
    unknown token such as ``Sept`` never matches. The since-week/year columns
    are not consulted.
    """
    pi = _c(promo_interval)
    m = _c(month)
    abbrev = F.when(m.between(1, 12), F.element_at(F.array(*[F.lit(x) for x in MONTH_ABBREVIATIONS]), m))
    listed = F.array_contains(F.transform(F.split(pi, ","), lambda t: F.trim(t)), abbrev)
    return (F.when((_c(promo2) == 0) | (pi == ""), F.lit(0))
            .otherwise(listed.cast("int")))


def competition_open_months(year, month, since_year, since_month) -> Column:
    raw = (_c(year) - _c(since_year)) * 12 + (_c(month) - _c(since_month))
    return F.when(raw.isNull(), F.lit(None)).otherwise(F.greatest(raw, F.lit(0)))


def date_feature_columns(d="date") -> dict[str, Column]:
    """X1-X15 in the order the model sees them."""
    d = _c(d)
    dow = weekday0(d)
    day = F.dayofmonth(d)
    week = iso_week(d)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": day,
        "day_of_week": dow,
        "week_of_year": week,
        "quarter": F.quarter(d),
        "is_weekend": flag(dow >= 5),
        "is_month_start": flag(day <= MONTH_START_LAST_DAY),
        "is_month_mid": flag((day > MONTH_START_LAST_DAY) & (day <= MONTH_MID_LAST_DAY)),
        "is_month_end": flag(day > MONTH_MID_LAST_DAY),
        "is_year_start": flag(week == 1),
        "is_year_end": flag(week >= 52),
        "days_to_christmas": days_to_christmas(d),
        "days_after_new_year": days_after_new_year(d),
        "days_to_easter": days_to_easter(d),
    }
