"""Calendar, temperature and event columns."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwise.functions.numeric import rnd

# --- fixed values -----------------------------------------------------------
DAYS_OF_WEEK = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTH_LABELS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
EVENTS = ["Arigato", "Christmas", "EOFY", "Vivid", "LongWeekend"]
NO_EVENT = "None"
FIXED_HOLIDAYS = ["01-01", "01-26", "04-25", "12-25", "12-26"]
PUBLIC_HOLIDAYS = [
    "2024-01-01", "2024-01-26", "2024-03-29", "2024-03-30", "2024-04-01", "2024-04-25",
    "2024-06-10", "2024-08-05", "2024-10-07", "2024-12-25", "2024-12-26",
    "2025-01-01", "2025-01-27", "2025-04-18", "2025-04-19", "2025-04-21", "2025-04-25",
    "2025-06-09", "2025-08-04", "2025-10-06", "2025-12-25", "2025-12-26",
]
LONG_WEEKENDS = [
    "2024-03-29", "2024-03-30", "2024-04-01", "2024-04-25", "2024-04-26", "2024-04-27",
    "2024-06-08", "2024-06-09", "2024-06-10", "2024-10-05", "2024-10-06", "2024-10-07",
    "2025-04-18", "2025-04-19", "2025-04-21", "2025-04-25", "2025-04-26", "2025-04-27",
    "2025-06-07", "2025-06-08", "2025-06-09", "2025-10-04", "2025-10-05", "2025-10-06",
]
COLD_SNAP_BELOW = 15
VIVID_ABOVE = 14.0
# ----------------------------------------------------------------------------


def day_name(d) -> Column:
    return F.date_format(d, "EEEE")


def dow_num(d) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(d)


def dow_rank(name) -> Column:
    """Monday-first sort key of a weekday name."""
    return F.array_position(F.array(*map(F.lit, DAYS_OF_WEEK)), _col(name))


def year_month(d) -> Column:
    return F.date_format(d, "yyyy-MM")


def year_week(d) -> Column:
    """Year and Monday-based week; days before the first Monday are week 00."""
    d = _col(d)
    week = F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7)
    return F.concat(F.year(d).cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def week_floor(d) -> Column:
    return F.date_trunc("week", _col(d)).cast("date")


def in_year(d, year: int) -> Column:
    """Year test as a date range, which Parquet statistics can use."""
    d = _col(d)
    return (d >= F.lit(f"{year}-01-01").cast("date")) & (d < F.lit(f"{year + 1}-01-01").cast("date"))


def seasonal_temperature(d) -> Column:
    """Noise-free southern-hemisphere temperature curve, two places."""
    curve = 20.5 + 7.5 * F.cos(F.lit(2 * math.pi) * (F.dayofyear(d) - 15) / 365)
    return rnd(curve, 2).cast("decimal(5,2)")


def event_flag(d, temperature, long_weekends: list[str] = ()) -> Column:
    """Event of a day; the first rule that fits wins."""
    d = _col(d)
    md = F.date_format(d, "MM-dd")
    flag = (
        F.when(md.between("05-21", "05-27"), "Arigato")
        .when(md.between("12-24", "12-27"), "Christmas")
        .when(md.between("06-20", "07-15"), "EOFY")
        .when(md.between("05-24", "06-15") & (_col(temperature) > VIVID_ABOVE), "Vivid")
    )
    if long_weekends:
        flag = flag.when(F.date_format(d, "yyyy-MM-dd").isin(list(long_weekends)), "LongWeekend")
    return flag.otherwise(NO_EVENT)


def is_holiday(d, month_days: list[str] = FIXED_HOLIDAYS, dates: list[str] = ()) -> Column:
    """True on a fixed month-day or on one of the listed ISO dates."""
    hit = F.date_format(d, "MM-dd").isin(list(month_days))
    return hit | F.date_format(d, "yyyy-MM-dd").isin(list(dates)) if dates else hit


def trading_hours(name) -> Column:
    return F.when(_col(name) == "Thursday", 12).when(_col(name) == "Sunday", 7).otherwise(9)


def temp_band(temperature) -> Column:
    t = _col(temperature)
    return (
        F.when(t < 12, "Very Cold (<12°C)")
        .when(t < 15, "Cold (12–15°C)")
        .when(t < 20, "Mild (15–20°C)")
        .otherwise("Warm (>20°C)")
    )


def _col(col) -> Column:
    return F.col(col) if isinstance(col, str) else col
