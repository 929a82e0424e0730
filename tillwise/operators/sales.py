"""Store-level and division-level sales summaries."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.numeric import mean, min_count_mean, pct, pct_change, quantile, ratio, rnd, total, trailing

DIVISION = ["division_code", "division_name", "department"]


def daily_summary(daily: DataFrame) -> DataFrame:
    return daily.select(
        "date", "day_of_week", "event_flag", "temperature_index", "actual_sales", "target",
        "achievement_pct", "gross_profit_amt", "gross_profit_ratio", "num_customers", "avg_spend",
    ).orderBy("date")


def weekly_sales(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy(cal.year_week("date").alias("year_week"))
        .agg(
            F.min("date").alias("week_start"),
            total("actual_sales").alias("weekly_sales"),
            total("gross_profit_amt").alias("weekly_gp"),
            rnd(mean("gross_profit_ratio"), 4).alias("avg_gp_pct"),
            total("num_customers").alias("total_customers"),
            rnd(mean("achievement_pct"), 4).alias("avg_achievement"),
            F.count("*").alias("trading_days"),
        )
        .orderBy("year_week")
    )


def monthly_sales(daily: DataFrame) -> DataFrame:
    on_target = F.count_if(F.col("achievement_pct") >= 1)
    return (
        daily.groupBy(cal.year_month("date").alias("year_month"))
        .agg(
            total("actual_sales").alias("monthly_sales"),
            total("gross_profit_amt").alias("monthly_gp"),
            rnd(mean("gross_profit_ratio"), 4).alias("avg_gp_pct"),
            rnd(mean("actual_sales"), 0).alias("avg_daily_sales"),
            total("num_customers").alias("total_customers"),
            on_target.alias("days_on_target"),
            F.count("*").alias("trading_days"),
            rnd(on_target / F.count("*"), 4).alias("target_hit_rate"),
        )
        .orderBy("year_month")
    )


def dow_profile(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("day_of_week")
        .agg(
            F.count("*").alias("num_days"),
            rnd(mean("actual_sales"), 0).alias("avg_sales"),
            rnd(mean("target"), 0).alias("avg_target"),
            rnd(mean("achievement_pct"), 4).alias("avg_achievement"),
            rnd(F.min("actual_sales"), 0).alias("min_sales"),
            rnd(F.max("actual_sales"), 0).alias("max_sales"),
            rnd(mean("num_customers"), 0).alias("avg_customers"),
            rnd(mean("avg_spend"), 2).alias("avg_basket"),
        )
        .orderBy(cal.dow_rank("day_of_week"))
    )


def event_impact(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("event_flag")
        .agg(
            F.count("*").alias("num_days"),
            rnd(mean("actual_sales"), 0).alias("avg_sales"),
            rnd(mean("achievement_pct"), 4).alias("avg_achievement"),
            rnd(mean("num_customers"), 0).alias("avg_customers"),
            rnd(mean("avg_spend"), 2).alias("avg_basket"),
            rnd(mean("gross_profit_ratio"), 4).alias("avg_gp_pct"),
        )
        .orderBy(F.desc("avg_sales"), "event_flag")
    )


def top_divisions(division_daily: DataFrame, year: int) -> DataFrame:
    """Division totals of one year. The grand total is a sum over the finished groups."""
    everything = Window.partitionBy()
    return (
        division_daily.where(cal.in_year("date", year))
        .groupBy(*DIVISION)
        .agg(
            total("sales_amt").alias("_sales"),
            rnd(total("gp_amt"), 0).alias("total_gp"),
            rnd(mean("gp_ratio"), 4).alias("avg_gp_pct"),
        )
        .select(
            *DIVISION,
            rnd("_sales", 0).alias("total_sales"),
            "total_gp", "avg_gp_pct",
            rnd(pct("_sales", F.sum("_sales").over(everything)), 2).alias("pct_of_total"),
        )
        .orderBy(F.desc("total_sales"), "division_code")
    )


def division_month_sales(division_daily: DataFrame, year: int) -> DataFrame:
    return (
        division_daily.where(cal.in_year("date", year))
        .groupBy(cal.year_month("date").alias("year_month"), "division_code", "division_name")
        .agg(rnd(total("sales_amt"), 0).alias("monthly_sales"))
        .orderBy("year_month", F.desc("monthly_sales"), "division_code")
    )


def season_heatmap(division_daily: DataFrame) -> DataFrame:
    return (
        division_daily.groupBy(F.month("date").alias("month_num"), "division_code", "division_name")
        .agg(rnd(mean("sales_amt"), 0).alias("avg_daily_sales"))
        .orderBy("month_num", "division_code")
    )


def season_pivot(division_daily: DataFrame) -> DataFrame:
    """Seasonal heatmap as one column per calendar month."""
    months = list(range(1, 13))
    wide = (
        division_daily.withColumn("month_num", F.month("date"))
        .groupBy("division_name")
        .pivot("month_num", months)
        .agg(rnd(mean("sales_amt"), 0))
    )
    return wide.withColumnsRenamed(
        {str(m): label.lower() for m, label in zip(months, cal.MONTH_LABELS)}
    ).orderBy("division_name")


def cold_snap_effect(daily: DataFrame, division_daily: DataFrame, cold: list[int], flat: list[int]) -> DataFrame:
    sales_of = lambda codes: F.when(F.col("division_code").isin(codes), F.col("sales_amt"))
    context = daily.select("date", "temperature_index")
    return (
        division_daily.join(context, "date")
        .groupBy(cal.temp_band("temperature_index").alias("temp_band"))
        .agg(
            rnd(mean(sales_of(cold)), 0).alias("avg_outerwear_sales"),
            rnd(mean(sales_of(flat)), 0).alias("avg_cutsewn_sales"),
            F.countDistinct("date").alias("num_days"),
            F.min("temperature_index").alias("_coldest"),
        )
        .orderBy("_coldest")
        .drop("_coldest")
    )


def temp_vs_groups(daily: DataFrame, division_daily: DataFrame, cold: list[int], flat: list[int]) -> DataFrame:
    sales_of = lambda codes: F.sum(F.when(F.col("division_code").isin(codes), F.col("sales_amt")).otherwise(0))
    by_day = division_daily.groupBy("date").agg(
        sales_of(cold).alias("outerwear_sales"), sales_of(flat).alias("cutsewn_sales")
    )
    return daily.select("date", "temperature_index", "event_flag").join(by_day, "date")


def customer_segments(customers: DataFrame) -> DataFrame:
    return (
        customers.groupBy("customer_type")
        .agg(
            F.count("*").alias("num_customers"),
            rnd(mean("avg_spend_per_visit"), 2).alias("avg_spend"),
            rnd(mean("total_visits"), 1).alias("avg_visits"),
            rnd(mean("total_spend"), 2).alias("avg_total_spend"),
            rnd(total("total_spend"), 0).alias("sum_total_spend"),
        )
        .orderBy(F.desc("sum_total_spend"), "customer_type")
    )


def segment_spend(customers: DataFrame) -> DataFrame:
    return customer_segments(customers).select(
        "customer_type", "num_customers", "avg_spend", "avg_visits",
        F.col("sum_total_spend").alias("total_revenue"),
    )


def yoy_by_month(daily: DataFrame, year: int, next_year: int) -> DataFrame:
    sales_in = lambda y: F.sum(F.when(cal.in_year("date", y), F.col("actual_sales")).otherwise(0))
    return (
        daily.groupBy(F.date_format("date", "MM").alias("month_num"))
        .agg(sales_in(year).alias("sales_first"), sales_in(next_year).alias("sales_second"))
        .withColumn("yoy_pct_change", rnd(pct_change("sales_second", "sales_first"), 2))
        .orderBy("month_num")
    )


def yoy_by_month_labelled(daily: DataFrame, year: int, next_year: int) -> DataFrame:
    label = F.element_at(F.array(*map(F.lit, cal.MONTH_LABELS)), F.col("month_num").cast("int"))
    return yoy_by_month(daily, year, next_year).select(
        "month_num", "sales_first", "sales_second",
        pct_change("sales_second", "sales_first").alias("yoy_pct"),
        label.alias("month"),
    )


def gp_rank(division_daily: DataFrame) -> DataFrame:
    return (
        division_daily.groupBy(*DIVISION)
        .agg(
            rnd(mean("gp_ratio") * 100, 2).alias("avg_gp_pct"),
            rnd(total("sales_amt"), 0).alias("total_sales"),
            rnd(total("gp_amt"), 0).alias("total_gp"),
        )
        .orderBy(F.desc("avg_gp_pct"), "division_code")
    )


def gp_by_division(division_daily: DataFrame) -> DataFrame:
    return gp_rank(division_daily).select("division_name", "department", "avg_gp_pct", "total_sales")


def division_annual(division_daily: DataFrame) -> DataFrame:
    return (
        division_daily.groupBy(*DIVISION)
        .agg(total("sales_amt").alias("total_sales"), mean("gp_ratio").alias("avg_gp"))
        .orderBy(F.desc("total_sales"), "division_code")
    )


def daily_trend(daily: DataFrame) -> DataFrame:
    """Seven-day average that needs seven days. The window holds one row per day."""
    week = trailing(["date"], 7)
    return daily.select(
        "date", "actual_sales", "target", "achievement_pct", "gross_profit_amt", "gross_profit_ratio",
        "event_flag", "temperature_index", "num_customers",
        min_count_mean("actual_sales", week, 7).alias("rolling_7d"),
    ).orderBy("date")


def dow_distribution(daily: DataFrame) -> DataFrame:
    at = lambda q: quantile("actual_sales", q)
    return (
        daily.groupBy("day_of_week")
        .agg(
            F.min("actual_sales").alias("min_sales"),
            at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"),
            F.max("actual_sales").alias("max_sales"),
        )
        .orderBy(cal.dow_rank("day_of_week"))
    )


# --- published result tables -------------------------------------------------


def event_lift(daily: DataFrame) -> DataFrame:
    """Average sales per event against the days without one."""
    everything = Window.partitionBy()
    by_event = daily.groupBy("event_flag").agg(
        F.count("*").alias("num_days"), mean("actual_sales").alias("_avg")
    )
    base = F.max(F.when(F.col("event_flag") == cal.NO_EVENT, F.col("_avg"))).over(everything)
    lift = F.when(F.col("event_flag") != cal.NO_EVENT, rnd((F.col("_avg") - base) * 100.0 / base, 2))
    return by_event.select(
        "event_flag", "num_days", rnd("_avg", 0).alias("avg_sales"), lift.alias("lift_pct")
    ).orderBy(F.desc("avg_sales"))


def segment_mix(transactions: DataFrame) -> DataFrame:
    everything = Window.partitionBy()
    return (
        transactions.groupBy("customer_type")
        .agg(F.count("*").alias("num_transactions"), rnd(mean("total_amount"), 2).alias("avg_basket"))
        .withColumn("share_pct", rnd(pct("num_transactions", F.sum("num_transactions").over(everything)), 2))
        .orderBy(F.desc("num_transactions"))
    )


def dow_pattern(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("day_of_week")
        .agg(
            rnd(mean("actual_sales"), 0).alias("avg_sales"),
            rnd(mean("num_customers"), 0).alias("avg_customers"),
            rnd(mean("achievement_pct") * 100, 1).alias("avg_achievement_pct"),
        )
        .orderBy(F.desc("avg_sales"))
    )


def seasonal_ratio(division_daily: DataFrame) -> DataFrame:
    average_in = lambda months: mean(F.when(F.month("date").isin(months), F.col("sales_amt")))
    return (
        division_daily.groupBy(*DIVISION)
        .agg(average_in([6, 7, 8]).alias("_winter"), average_in([12, 1, 2]).alias("_summer"))
        .select(
            *DIVISION,
            rnd("_winter", 0).alias("winter_avg"),
            rnd("_summer", 0).alias("summer_avg"),
            rnd(ratio("_winter", "_summer"), 2).alias("winter_to_summer"),
        )
        .orderBy("division_code")
    )


def top_mix(division_daily: DataFrame, k: int = 10) -> DataFrame:
    """The k largest divisions with their own and their combined share."""
    everything = Window.partitionBy()
    largest_first = Window.orderBy(F.desc("total_sales"), "division_code")
    return (
        division_daily.groupBy(*DIVISION)
        .agg(total("sales_amt").alias("total_sales"))
        .withColumn("_all", F.sum("total_sales").over(everything))
        .select(
            *DIVISION, "total_sales",
            F.row_number().over(largest_first).cast("bigint").alias("position"),
            rnd(pct("total_sales", "_all"), 2).alias("share_pct"),
            rnd(
                pct(F.sum("total_sales").over(largest_first.rowsBetween(Window.unboundedPreceding, 0)), "_all"), 2
            ).alias("combined_share_pct"),
        )
        .where(F.col("position") <= k)
        .orderBy("position")
    )


def temp_bands(daily: DataFrame) -> DataFrame:
    t = F.col("temperature_index")
    band = F.when(t < 15, "Cold (<15°C)").when(t <= 22, "Mild (15-22°C)").otherwise("Warm (>22°C)")
    return (
        daily.groupBy(band.alias("temp_band"))
        .agg(F.count("*").alias("num_days"), rnd(mean("actual_sales"), 0).alias("avg_sales"))
        .orderBy("temp_band")
    )


def store_summary(daily: DataFrame, products: DataFrame) -> DataFrame:
    """Headline numbers in one row; the price figures come in as scalar subqueries."""
    price = lambda agg: products.agg(agg).scalar()
    return daily.agg(
        total("actual_sales").alias("total_revenue"),
        rnd(mean("gross_profit_ratio"), 4).alias("avg_gp_ratio"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    ).select(
        "*",
        price(F.min("unit_price")).alias("min_price"),
        price(F.max("unit_price")).alias("max_price"),
        price(rnd(mean("unit_price"), 2)).alias("avg_price"),
    )
