"""Walk-forward forecast log, error tracking and detection of persistent bias."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.numeric import big, dbl, fixed, mean, mean_over, min_count_mean, pct, ratio, rnd, total

# --- fixed values -----------------------------------------------------------
WARM_UP_WEEKS = 26
MIN_TRAIN_ROWS = 100
LOG_LEAD_DAYS = 7
BIAS_WINDOW = 6
BIAS_MIN_VALUES = 4
BIAS_THRESHOLD = 5.0
BIAS_STREAK = 4
ALWAYS_LOW_EVENTS = ["Arigato", "Christmas", "Vivid"]
HIGH_BELOW, MEDIUM_BELOW = 5, 12
NO_HISTORY_TEXT = "Insufficient history for this context."
EVENT_TEXT = "Event week (%s) — historical forecast accuracy is lower for irregular events."
CONTEXT_TEXT = "Historical MAPE for %s / %s: %.1f%%"
HIGH_TEXT, MEDIUM_TEXT = " — reliable context.", "."
LOW_TEXT = " — forecasts are less reliable in this context."
ALERT_TEXT = "Heads up: %d consecutive weeks %s %s sales in %s by ~%.1f%%."
# ----------------------------------------------------------------------------
# The normal points that leave 15% on either side.
BAND_DEVIATIONS = 1.0364
GROUP = ["division_code", "day_of_week"]


def eligible_dates(joined: DataFrame, warm_up_weeks: int = WARM_UP_WEEKS, min_rows: int = MIN_TRAIN_ROWS) -> DataFrame:
    """Dates with enough history before them. Runs over one row per date."""
    before = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    start = Window.partitionBy()
    return (
        joined.groupBy("date")
        .agg(F.count("*").alias("_n"))
        .select("date", F.sum("_n").over(before).alias("_train"), F.min("date").over(start).alias("_first"))
        .where((F.col("date") >= F.date_add("_first", 7 * warm_up_weeks)) & (F.col("_train") >= min_rows))
        .select("date")
    )


def history_before(horizon: int) -> Window:
    """The same division's and weekday's rows at least `horizon` days before."""
    return (
        Window.partitionBy(*GROUP)
        .orderBy(F.unix_date("date"))
        .rangeBetween(Window.unboundedPreceding, -horizon)
    )


def walk_forward_means(joined: DataFrame, horizon: int = 1) -> DataFrame:
    """Forecast every day from the days at least `horizon` days before it.

    The forecast is the mean of the division's earlier days with the same weekday. Forecast
    and band are expanding frames over one partitioning, so all refits are one pass.
    """
    mean_before = fixed(mean_over("sales_amt", history_before(horizon)), 2)
    return with_band(joined.withColumn("predicted_sales", mean_before), horizon)


def with_band(forecast: DataFrame, horizon: int = 1) -> DataFrame:
    """Adds bounds: the forecast plus and minus the spread of the earlier forecasts' errors."""
    past = history_before(horizon)
    n = F.count("_error").over(past)
    s = dbl(F.sum("_error").over(past))
    squares = dbl(F.sum((F.col("_error") * F.col("_error")).cast("decimal(38,4)")).over(past))
    deviation = F.when(n >= 2, F.sqrt(F.greatest(F.lit(0.0), squares - s * s / n) / n))
    spread = forecast.withColumn("_error", F.col("sales_amt") - F.col("predicted_sales")).withColumn(
        "_band", deviation * BAND_DEVIATIONS
    )
    return spread.withColumns(
        {
            "lower_bound": fixed(dbl("predicted_sales") - F.col("_band"), 2),
            "upper_bound": fixed(dbl("predicted_sales") + F.col("_band"), 2),
        }
    ).drop("_error", "_band")


def as_log(forecast: DataFrame, dates: DataFrame) -> DataFrame:
    """Forecast rows in the shape of the log; zero actuals and zero errors are kept as null."""
    actual = F.nullif(F.col("sales_amt"), F.lit(0).cast("decimal(18,2)"))
    error = fixed(ratio(actual - F.col("predicted_sales"), actual), 4)
    return forecast.join(dates, "date", "left_semi").select(
        F.date_sub("date", LOG_LEAD_DAYS).alias("forecast_date"),
        F.col("date").alias("target_date"),
        "division_code", "predicted_sales", "lower_bound", "upper_bound",
        actual.alias("actual_sales"),
        F.when(actual != F.col("predicted_sales"), error).alias("error_pct"),
        F.concat_ws("/", "day_of_week", "event_flag").alias("context_flags"),
    )


def walk_forward_log(joined: DataFrame, horizon: int = 1) -> DataFrame:
    return as_log(walk_forward_means(joined, horizon), eligible_dates(joined))


def weekday_of_context(context) -> Column:
    return F.split_part(context, F.lit("/"), F.lit(1))


def event_of_context(context) -> Column:
    return F.split_part(context, F.lit("/"), F.lit(2))


def signed_error(actual="actual_sales", predicted="predicted_sales") -> Column:
    """Error in percent of the actual: positive means the forecast was too low."""
    return fixed(pct(F.col(actual) - F.col(predicted), actual), 6)


def with_context(log: DataFrame) -> DataFrame:
    return log.withColumn("day_of_week", weekday_of_context(F.col("context_flags")))


def division_names(division_days: DataFrame) -> DataFrame:
    return division_days.select("division_code", "division_name").distinct()


def named_log(log: DataFrame, division_days: DataFrame) -> DataFrame:
    """Log rows that have an actual, with division name and weekday."""
    return (
        with_context(known_rows(log))
        .join(division_names(division_days), "division_code", "left")
        .select("forecast_date", "target_date", "division_code", "division_name", "predicted_sales",
                "lower_bound", "upper_bound", "actual_sales", "error_pct", "context_flags",
                F.col("day_of_week").alias("dow"))
    )


def rolling_bias(log: DataFrame) -> DataFrame:
    """Mean signed error of the last six forecasts for the same division and weekday."""
    recent = Window.partitionBy(*GROUP).orderBy("target_date").rowsBetween(-(BIAS_WINDOW - 1), 0)
    return (
        with_context(log)
        .withColumn("signed_error_pct", signed_error())
        .select(
            "target_date", *GROUP, "signed_error_pct",
            min_count_mean("signed_error_pct", recent, BIAS_MIN_VALUES).alias("rolling_6w_bias"),
        )
    )


def known_rows(log: DataFrame) -> DataFrame:
    """Log rows with an actual, as the report pages read them: the six-row frame then skips empty days."""
    return log.where(F.col("actual_sales").isNotNull())


def bias_streaks(bias: DataFrame, threshold: float = BIAS_THRESHOLD) -> DataFrame:
    """Length of the newest run of values beyond the threshold, per division and weekday."""
    known = bias.where(F.col("rolling_6w_bias").isNotNull()).withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*GROUP).orderBy("target_date"))
    )
    inside = F.max(F.when(F.abs("rolling_6w_bias") <= threshold, F.col("_rn")))
    return known.groupBy(*GROUP).agg(
        F.count("*").alias("num_periods"),
        big(F.max("_rn") - F.coalesce(inside, F.lit(0))).alias("streak"),
        F.max_by("rolling_6w_bias", "target_date").alias("latest_bias"),
    )


def bias_flags(log: DataFrame, division_days: DataFrame, streak: int = BIAS_STREAK) -> DataFrame:
    flagged = bias_streaks(rolling_bias(log)).where(
        (F.col("num_periods") >= streak) & (F.col("streak") >= streak)
    )
    direction = F.when(F.col("latest_bias") > 0, "underestimating").otherwise("overestimating")
    named = flagged.join(division_names(division_days), "division_code", "left").withColumn("direction", direction)
    return named.select(
        "division_code", "division_name", "day_of_week",
        F.col("streak").alias("consecutive_flagged_periods"),
        rnd("latest_bias", 2).alias("latest_rolling_bias_pct"),
        "direction",
        F.format_string(
            ALERT_TEXT, "streak", "direction", "day_of_week", "division_name", rnd(F.abs("latest_bias"), 1)
        ).alias("alert"),
    ).orderBy("division_code", "day_of_week")


def accuracy_lookup(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Mean absolute error in percent per weekday and event; rows without sales have none."""
    off = F.abs(fixed(pct(F.col(actual) - F.col(predicted), actual), 6))
    return (
        scored.withColumn("_off", off)
        .groupBy("day_of_week", "event_flag")
        .agg(mean("_off").alias("mean_mape"))
        .where(F.col("mean_mape").isNotNull())
        .orderBy("day_of_week", "event_flag")
    )


def lookup_from_log(log: DataFrame) -> DataFrame:
    contexts = with_context(log).withColumn("event_flag", event_of_context(F.col("context_flags")))
    return accuracy_lookup(contexts, "actual_sales", "predicted_sales")


def reliability(contexts: DataFrame, lookup: DataFrame) -> DataFrame:
    """HIGH, MEDIUM or LOW per weekday and event, with the reason. The lookup has a few dozen rows."""
    event, mape = F.col("event_flag"), F.col("mean_mape")
    always_low = event.isin(ALWAYS_LOW_EVENTS)
    flag = (
        F.when(always_low, "LOW")
        .when(mape.isNull(), "MEDIUM")
        .when(mape < HIGH_BELOW, "HIGH")
        .when(mape < MEDIUM_BELOW, "MEDIUM")
        .otherwise("LOW")
    )
    ending = F.when(mape < HIGH_BELOW, HIGH_TEXT).when(mape < MEDIUM_BELOW, MEDIUM_TEXT).otherwise(LOW_TEXT)
    reason = (
        F.when(always_low, F.format_string(EVENT_TEXT, event))
        .when(mape.isNull(), NO_HISTORY_TEXT)
        .otherwise(F.concat(F.format_string(CONTEXT_TEXT, "day_of_week", event, rnd(mape, 1)), ending))
    )
    return contexts.join(lookup, ["day_of_week", "event_flag"], "left").select(
        *contexts.columns, flag.alias("flag"), reason.alias("explanation")
    )


def bias_series(log: DataFrame, codes: list[int], weekday: str, threshold: float = BIAS_THRESHOLD) -> DataFrame:
    chosen = known_rows(log).where(F.col("division_code").isin(codes))
    return (
        rolling_bias(chosen)
        .where((F.col("day_of_week") == weekday) & F.col("rolling_6w_bias").isNotNull())
        .withColumn("flagged", F.abs("rolling_6w_bias") > threshold)
        .orderBy("division_code", "target_date")
    )


def error_heatmap(log: DataFrame, division_days: DataFrame) -> DataFrame:
    """Mean signed error, divisions down and weekdays across."""
    named = rolling_bias(log).join(division_names(division_days), "division_code", "left")
    return (
        named.groupBy("division_name")
        .pivot("day_of_week", cal.DAYS_OF_WEEK)
        .agg(rnd(mean("signed_error_pct"), 4))
        .orderBy("division_name")
    )


def errors(scored: DataFrame, actual: str, predicted: str, *by: str) -> DataFrame:
    """MAPE and RMSE; rows with a zero actual count for RMSE only."""
    diff = F.col(actual) - F.col(predicted)
    off = F.abs(fixed(pct(diff, actual), 6))
    square = (diff * diff).cast("decimal(38,4)")
    return (
        scored.withColumns({"_off": off, "_square": square})
        .groupBy(*by)
        .agg(
            F.count("*").alias("num_rows"),
            rnd(mean("_off"), 4).alias("mape"),
            rnd(F.sqrt(dbl(F.sum("_square")) / F.count("*")), 4).alias("rmse"),
        )
    )


def daily_totals(scored: DataFrame, date: str, **columns: str) -> DataFrame:
    """Store totals per day of the named columns."""
    return scored.groupBy(date).agg(*[total(src).alias(out) for out, src in columns.items()]).orderBy(date)
