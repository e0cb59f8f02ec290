"""Aggregate expressions with results that do not depend on partitioning.

Money (values with up to 4 decimals) is summed as DECIMAL: the sum is exact, so the mean of a
column is the same number whatever the partitioning, task order or engine (it matches the
DuckDB oracle to the last bit), and it does not drift on 10^12 rows the way a
floating-point running sum does. What a value has beyond 4 decimals is summed beside it as a
double, so nothing is rounded away; that part is 0 for money.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c, where: Column | None = None) -> Column:
    """Sum as a double: exact for money, to double precision for other values."""
    x = _col(c)
    if where is not None:
        x = F.when(where, x)
    money = x.cast(MONEY)
    return F.sum(money).cast("double") + F.sum(x.cast("double") - money.cast("double"))


def exact_mean(c, where: Column | None = None) -> Column:
    """Mean of a column: exact sum / count, one rounding at the end."""
    x = _col(c)
    if where is not None:
        x = F.when(where, x)
    return F.try_divide(exact_sum(x), F.count(x).cast("double"))


def count_mean(c, where: Column | None = None) -> Column:
    """Mean of an integer column (exact integer sum / count)."""
    x = _col(c)
    if where is not None:
        x = F.when(where, x)
    return F.try_divide(F.sum(x.cast("bigint")).cast("double"), F.count(x).cast("double"))


def lift_pct(treated: Column, control: Column) -> Column:
    """(treated - control) / control * 100; null when the control mean is 0 or missing."""
    return F.try_divide(treated - control, control) * 100


def rnd(c, digits: int = 6) -> Column:
    """Round half away from zero as ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``.

    Written out so that the same IEEE operations happen in every engine
    (Spark's ``round`` rounds the exact binary value, other engines round
    ``x * 10^d``; the two disagree on values that print as exact ties).
    """
    x = _col(c)
    m = float(10 ** digits)
    return F.signum(x) * F.floor(F.abs(x) * m + 0.5) / m


def r6(c) -> Column:
    """Round a floating statistic to 6 decimals (engines differ in the last bits)."""
    return rnd(c, 6)
