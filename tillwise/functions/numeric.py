"""Column helpers for money, ratios and averages.

Money and ratios that will be summed are kept as fixed-point decimals: a decimal
sum does not depend on the order in which tasks finish, a double sum does. They
become doubles last, after the sum.
"""

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def dbl(col) -> Column:
    return _col(col).cast("double")


def rnd(col, places: int) -> Column:
    """Round a double half away from zero, in plain IEEE steps that stay in generated code."""
    x = dbl(col)
    scale = float(10**places)
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / F.lit(scale)


def fixed(col, places: int) -> Column:
    """A double rounded into a decimal, so that later sums are exact."""
    return rnd(col, places).cast(f"decimal(18,{places})")


def money(col) -> Column:
    return _col(col).cast("decimal(12,2)")


def total(col) -> Column:
    return F.sum(_col(col))


def mean(col) -> Column:
    """Average as exact sum over count of the non-null values."""
    return dbl(F.sum(_col(col))) / F.nullif(F.count(_col(col)), F.lit(0))


def mean_over(col, window) -> Column:
    x = _col(col)
    return dbl(F.sum(x).over(window)) / F.nullif(F.count(x).over(window), F.lit(0))


def min_count_mean(col, window, at_least: int) -> Column:
    """Window average that stays null until `at_least` values are in the frame."""
    x = _col(col)
    return F.when(F.count(x).over(window) >= at_least, mean_over(x, window))


def ratio(num, den) -> Column:
    """Division that gives null on a zero or missing divisor."""
    return dbl(num) / F.nullif(dbl(den), F.lit(0.0))


def pct(num, den) -> Column:
    return dbl(num) * 100.0 / F.nullif(dbl(den), F.lit(0.0))


def pct_change(new, old) -> Column:
    return pct(_col(new) - _col(old), old)


def quantile(col, q: float) -> Column:
    """Exact interpolated quantile of a group of bounded size, settled at four places."""
    return rnd(F.percentile(dbl(col), q), 4)


def big(col) -> Column:
    return _col(col).cast("bigint")


def trailing(order_by, rows: int, partition_by=()) -> Window:
    """Frame of the current row and the rows - 1 before it."""
    return Window.partitionBy(*partition_by).orderBy(*order_by).rowsBetween(-(rows - 1), 0)


def _col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
