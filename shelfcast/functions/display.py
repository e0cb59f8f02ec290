"""Labels, bands and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Assortment codes and their labels, in display order.
ASSORTMENT_LABELS = [("a", "Basic"), ("b", "Extra"), ("c", "Extended")]
# Weekday names in display order (Monday first).
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# Competition distance bands, right-closed: (0,500] (500,1000] (1000,2000] (2000,5000] (5000,inf).
DISTANCE_EDGES = [0, 500, 1000, 2000, 5000]
DISTANCE_LABELS = ["<500m", "500m-1km", "1-2km", "2-5km", ">5km"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def spend_per_customer(sales="sales", customers="customers") -> Column:
    """Sales / customers; null (not inf) when there are no customers."""
    return F.try_divide(_c(sales), _c(customers).cast("double"))


def assortment_label(c="assortment") -> Column:
    c = _c(c)
    expr = None
    for code, label in ASSORTMENT_LABELS:
        expr = F.when(c == code, label) if expr is None else expr.when(c == code, label)
    return expr


def weekday_name(d="date") -> Column:
    return F.date_format(_c(d), "EEEE")


def distance_band_index(c="competition_distance") -> Column:
    """0-based right-closed band index; null for 0, negatives and nulls."""
    c = _c(c)
    expr = None
    for i in range(len(DISTANCE_EDGES)):
        lo = DISTANCE_EDGES[i]
        cond = c > lo if i == len(DISTANCE_EDGES) - 1 else (c > lo) & (c <= DISTANCE_EDGES[i + 1])
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def distance_band(c="competition_distance") -> Column:
    idx = distance_band_index(c)
    return F.when(idx.isNotNull(), F.element_at(F.array(*[F.lit(x) for x in DISTANCE_LABELS]), idx + 1))


def clean_prediction(p) -> Column:
    """Clip at 0, round half-even to cents."""
    return F.rint(F.greatest(_c(p), F.lit(0.0)) * 100) / 100


def display_date(d) -> Column:
    """E.g. 'Tue 03 Mar 2015'."""
    return F.date_format(_c(d), "EEE dd MMM yyyy")


def display_money(x) -> Column:
    return F.format_number(_c(x), 2)


def yes_no(flag_col) -> Column:
    return F.when(_c(flag_col) == 1, "Yes").otherwise("No")
