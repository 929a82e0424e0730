"""Data behind the report pages: range filters, headline numbers, scenarios, flags."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.numeric import dbl, fixed, mean, mean_over, pct_change, rnd, total, trailing

# --- fixed values -----------------------------------------------------------
RANGES = {"7D": 7, "1M": 30, "3M": 90, "6M": 180, "1Y": 365, "All": None}
DEPARTMENT_ORDER = ["Women", "Men", "Kids", "Others"]
MONTH_TEMPERATURE = [26, 26, 24, 20, 16, 13, 12, 14, 16, 19, 22, 25]
MONTH_MIDDLE_DAY = [15, 46, 74, 105, 135, 166, 196, 227, 258, 288, 319, 349]
MIN_MONTH_ROWS = 4
TOP_FLAGS = 6
# ----------------------------------------------------------------------------
CONTEXT_FEATURES = ["lag_7", "lag_14", "lag_28", "rolling_7_mean", "rolling_14_mean"]


def filter_range(df: DataFrame, date_col: str, label: str) -> DataFrame:
    """Rows of the last days before the newest date of the frame."""
    days = RANGES[label]
    if days is None:
        return df
    return df.where(F.col(date_col) >= F.date_sub(df.agg(F.max(date_col)).scalar(), days))


def store_kpis(daily: DataFrame, year: int, next_year: int) -> DataFrame:
    """Headline numbers of two years in one pass."""
    of = lambda y, c: F.when(cal.in_year("date", y), F.col(c))
    return daily.agg(
        total("actual_sales").alias("total_sales"),
        total(of(year, "actual_sales")).alias("sales_first"),
        total(of(next_year, "actual_sales")).alias("sales_second"),
        mean(of(year, "gross_profit_ratio")).alias("_gp1"),
        mean(of(next_year, "gross_profit_ratio")).alias("_gp2"),
        mean(of(year, "num_customers")).alias("_c1"),
        mean(of(next_year, "num_customers")).alias("_c2"),
        mean(of(next_year, "yoy_pct")).alias("_yoy"),
    ).select(
        "total_sales", "sales_first", "sales_second",
        rnd(pct_change("sales_second", "sales_first"), 2).alias("yoy_pct_change"),
        rnd(F.col("_gp2") * 100, 2).alias("avg_gp_pct"),
        rnd((F.col("_gp2") - F.col("_gp1")) * 100, 4).alias("gp_delta_points"),
        rnd("_c2", 0).alias("avg_customers"),
        rnd(pct_change("_c2", "_c1"), 2).alias("customers_delta_pct"),
        rnd(F.col("_yoy") * 100, 2).alias("avg_daily_yoy_pct"),
    )


def trend(daily: DataFrame, label: str) -> DataFrame:
    """Daily sales of a range; the seven-day mean starts afresh inside it."""
    return (
        filter_range(daily.select("date", "actual_sales", "target"), "date", label)
        .withColumn("rolling_7d", mean_over("actual_sales", trailing(["date"], 7)))
        .orderBy("date")
    )


def dow_average(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("day_of_week")
        .agg(mean("actual_sales").alias("avg_sales"))
        .orderBy(cal.dow_rank("day_of_week"))
    )


def division_monthly(division_daily: DataFrame) -> DataFrame:
    return (
        division_daily.groupBy("division_code", "division_name", "department", cal.year_month("date").alias("month"))
        .agg(mean("sales_amt").alias("avg_daily"))
        .orderBy("division_code", "month")
    )


def division_totals(division_daily: DataFrame) -> DataFrame:
    return division_daily.groupBy("division_code").agg(total("sales_amt").alias("total_sales"))


def department_rank(division_daily: DataFrame) -> DataFrame:
    """Divisions in the fixed department order, largest first within a department."""
    order = F.array_position(F.array(*map(F.lit, DEPARTMENT_ORDER)), F.col("department"))
    within = Window.partitionBy("department").orderBy(F.desc("total_sales"), "division_code")
    return (
        division_daily.groupBy("department", "division_code", "division_name")
        .agg(total("sales_amt").alias("total_sales"))
        .withColumns({"department_order": order, "position": F.row_number().over(within).cast("bigint")})
        .orderBy("department_order", "position")
    )


def minmax_series(division_daily: DataFrame) -> DataFrame:
    """Monthly series scaled to 0..1 per division; a flat series is divided by one."""
    of_division = Window.partitionBy("division_code")
    low = F.min("avg_daily").over(of_division)
    span = F.max("avg_daily").over(of_division) - low
    return (
        division_monthly(division_daily)
        .select(
            "division_code", "month",
            rnd((F.col("avg_daily") - low) / F.coalesce(F.nullif(span, F.lit(0.0)), F.lit(1.0)), 6).alias("scaled"),
        )
        .orderBy("division_code", "month")
    )


# --- scenarios ---------------------------------------------------------------


def scenario_context(features: DataFrame) -> DataFrame:
    """Mean lags per division and month; the whole history where a month has under four rows."""
    exact = {c: fixed(dbl(c), 4) for c in CONTEXT_FEATURES}
    per_month = (
        features.withColumns(exact)
        .groupBy("division_code", "month")
        .agg(
            F.count("*").alias("num_rows"),
            *[F.sum(c).alias(f"s_{c}") for c in CONTEXT_FEATURES],
            *[F.count(c).alias(f"n_{c}") for c in CONTEXT_FEATURES],
        )
    )
    whole = per_month.groupBy("division_code").agg(
        *[(dbl(F.sum(f"s_{c}")) / F.nullif(F.sum(f"n_{c}"), F.lit(0))).alias(f"all_{c}") for c in CONTEXT_FEATURES]
    )
    months = whole.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    enough = F.col("num_rows") >= MIN_MONTH_ROWS
    return (
        months.join(per_month, ["division_code", "month"], "left")
        .select(
            "division_code", "month", F.coalesce("num_rows", F.lit(0).cast("bigint")).alias("num_rows"),
            *[
                F.when(enough, dbl(f"s_{c}") / F.nullif(F.col(f"n_{c}"), F.lit(0))).otherwise(F.col(f"all_{c}")).alias(c)
                for c in CONTEXT_FEATURES
            ],
        )
        .orderBy("division_code", "month")
    )


def _of_month(values: list[int]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.col("month"))


def scenario_rows(context: DataFrame) -> DataFrame:
    """One feature row per division, month, weekday and event: the grid of what-if questions."""
    grid = (
        context.drop("num_rows")
        .withColumn("day_of_week", F.explode(F.array(*map(F.lit, cal.DAYS_OF_WEEK))))
        .withColumn("event_flag", F.explode(F.array(*map(F.lit, [cal.NO_EVENT, *cal.EVENTS]))))
    )
    return grid.select(
        "division_code", "month", "day_of_week", "event_flag",
        _of_month(MONTH_TEMPERATURE).alias("temperature_index"),
        cal.trading_hours("day_of_week").alias("trading_hours"),
        F.lit(0).alias("is_public_holiday"), F.lit(0).alias("promo_flag"),
        (cal.dow_rank("day_of_week") - 1).cast("int").alias("dow_num"),
        _of_month(MONTH_MIDDLE_DAY).alias("day_of_year"),
        *[(F.col("event_flag") == e).cast("int").alias(f"event_{e}") for e in cal.EVENTS],
        *CONTEXT_FEATURES,
    )


def scenario_forecast(predicted: DataFrame, fallback: float) -> DataFrame:
    """Forecast and bounds, none below zero. Without columns low and high the bounds are a fixed band."""
    pred = F.greatest(F.lit(0.0), F.col("yhat"))
    has_bounds = {"low", "high"} <= set(predicted.columns)
    bound = lambda column, other: F.greatest(F.lit(0.0), F.col(column)) if has_bounds else pred * other
    return predicted.select(
        "division_code", "month", "day_of_week", "event_flag",
        pred.alias("predicted"), bound("low", 1 - fallback).alias("lower"), bound("high", 1 + fallback).alias("upper"),
    )


def scenario_vs_history(predicted: DataFrame, joined: DataFrame) -> DataFrame:
    """Each scenario against the average of the same division, month and weekday."""
    history = joined.groupBy("division_code", F.month("date").alias("month"), "day_of_week").agg(
        mean("sales_amt").alias("hist_avg")
    )
    return predicted.join(history, ["division_code", "month", "day_of_week"], "left").withColumn(
        "vs_hist_pct", rnd((dbl("predicted") - F.col("hist_avg")) * 100.0 / F.nullif(F.col("hist_avg"), F.lit(0.0)), 2)
    )


def month_bars(joined: DataFrame, code: int, label: str) -> DataFrame:
    """Average daily sales per calendar month of one division."""
    own = joined.where(F.col("division_code") == code).select("date", "sales_amt")
    return (
        filter_range(own, "date", label)
        .groupBy(F.trunc("date", "month").alias("month"))
        .agg(mean("sales_amt").alias("avg_daily_sales"))
        .orderBy("month")
    )


# --- confidence and self-check -----------------------------------------------


def mape_heatmap(lookup: DataFrame) -> DataFrame:
    return (
        lookup.groupBy("event_flag")
        .pivot("day_of_week", cal.DAYS_OF_WEEK)
        .agg(F.first("mean_mape"))
        .orderBy("event_flag")
    )


def ci_series(named_log: DataFrame, label: str) -> DataFrame:
    sums = {"actual": "actual_sales", "predicted": "predicted_sales", "lower": "lower_bound", "upper": "upper_bound"}
    return (
        filter_range(named_log, "target_date", label)
        .groupBy("target_date")
        .agg(*[total(c).alias(n) for n, c in sums.items()])
        .orderBy("target_date")
    )


def strongest_first() -> list[Column]:
    return [F.desc(F.abs("latest_rolling_bias_pct")), F.asc("division_code"), F.asc("day_of_week")]


def top_flags(flags: DataFrame, k: int = TOP_FLAGS) -> DataFrame:
    return flags.orderBy(*strongest_first()).limit(k)


def flag_kpis(flags: DataFrame) -> DataFrame:
    """Counts and extremes of the flags; of equals the first division and weekday is named."""
    size, length = F.abs("latest_rolling_bias_pct"), F.col("consecutive_flagged_periods")
    first_by = lambda key: F.min_by("division_name", F.struct(-key, "division_code", "day_of_week"))
    return flags.agg(
        F.count("*").alias("num_flags"),
        F.count_if(F.col("direction") == "underestimating").alias("num_under"),
        F.count_if(F.col("direction") == "overestimating").alias("num_over"),
        F.max(size).alias("worst_bias_pct"),
        first_by(size).alias("worst_bias_division"),
        F.max(length).alias("longest_streak"),
        first_by(length).alias("longest_streak_division"),
    )


def division_list(log: DataFrame, names: DataFrame) -> DataFrame:
    return log.select("division_code").distinct().join(names, "division_code", "left").orderBy("division_code")


def bias_of_division(bias: DataFrame, code: int, label: str) -> DataFrame:
    own = bias.where((F.col("division_code") == code) & F.col("rolling_6w_bias").isNotNull())
    return filter_range(own, "target_date", label).orderBy("day_of_week", "target_date")


def bias_table(flags: DataFrame) -> DataFrame:
    return flags.orderBy(*strongest_first()).select(
        F.col("division_name").alias("Division"),
        F.col("day_of_week").alias("Day"),
        F.col("consecutive_flagged_periods").alias("Consecutive Weeks Flagged"),
        F.col("latest_rolling_bias_pct").alias("Latest Bias %"),
        F.col("direction").alias("Direction"),
    )
