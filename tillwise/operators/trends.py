"""Running, rolling, ranked and year-on-year views.

Windows here run over daily or weekly roll-ups: one row per day, or per division and
period. Unpartitioned windows see one row per calendar day of the store.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.numeric import big, mean, mean_over, pct, pct_change, quantile, rnd, total, trailing

DIVISION = ["division_code", "division_name", "department"]


def division_weeks(division_daily: DataFrame) -> DataFrame:
    return division_daily.groupBy(
        cal.year_week("date").alias("year_week"), "division_code", "division_name"
    ).agg(F.min("date").alias("week_start"), total("sales_amt").alias("weekly_sales"))


def division_months(division_daily: DataFrame, *extra: str) -> DataFrame:
    return division_daily.groupBy(
        cal.year_month("date").alias("year_month"), "division_code", "division_name", *extra
    ).agg(total("sales_amt").alias("monthly_sales"))


def rolling_sales(daily: DataFrame) -> DataFrame:
    return daily.select(
        "date", "actual_sales",
        rnd(mean_over("actual_sales", trailing(["date"], 7)), 0).alias("rolling_7d_avg"),
        rnd(mean_over("actual_sales", trailing(["date"], 28)), 0).alias("rolling_28d_avg"),
    ).orderBy("date")


def year_to_date(daily: DataFrame) -> DataFrame:
    so_far = Window.partitionBy("year").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        daily.select("date", F.year("date").alias("year"), "actual_sales", "gross_profit_amt")
        .withColumns(
            {
                "ytd_sales": F.sum("actual_sales").over(so_far),
                "ytd_gp": F.sum("gross_profit_amt").over(so_far),
            }
        )
        .orderBy("date")
    )


def weekly_rank(division_daily: DataFrame) -> DataFrame:
    best_first = Window.partitionBy("year_week").orderBy(F.desc("weekly_sales"))
    return (
        division_weeks(division_daily)
        .drop("week_start")
        .withColumn("weekly_rank", big(F.rank().over(best_first)))
        .orderBy("year_week", "weekly_rank", "division_code")
    )


def rolling_four_weeks(division_daily: DataFrame) -> DataFrame:
    four = trailing(["year_week"], 4, ["division_code"])
    return (
        division_weeks(division_daily)
        .withColumn("rolling_4w_avg", rnd(mean_over("weekly_sales", four), 0))
        .orderBy("division_code", "year_week")
    )


def day_over_day(daily: DataFrame) -> DataFrame:
    before = F.lag("actual_sales").over(Window.orderBy("date"))
    return (
        daily.select("date", "day_of_week", "actual_sales", before.alias("prev_day_sales"))
        .withColumns(
            {
                "dod_change": F.col("actual_sales") - F.col("prev_day_sales"),
                "dod_pct_change": rnd(pct_change("actual_sales", "prev_day_sales"), 2),
            }
        )
        .orderBy("date")
    )


def week_over_week(division_daily: DataFrame) -> DataFrame:
    before = F.lag("weekly_sales").over(Window.partitionBy("division_code").orderBy("year_week"))
    return (
        division_weeks(division_daily)
        .drop("week_start")
        .withColumn("prev_week_sales", before)
        .withColumn("wow_pct", rnd(pct_change("weekly_sales", "prev_week_sales"), 2))
        .orderBy("division_code", "year_week")
    )


def cumulative_share(division_daily: DataFrame) -> DataFrame:
    """Month share per division, and the share of it and all larger ones."""
    month = Window.partitionBy("year_month")
    down_to_here = month.orderBy(F.desc("monthly_sales"), "division_code").rowsBetween(
        Window.unboundedPreceding, 0
    )
    whole = F.sum("monthly_sales").over(month)
    return (
        division_months(division_daily)
        .withColumns(
            {
                "pct_of_month": rnd(pct("monthly_sales", whole), 2),
                "cumulative_pct": rnd(pct(F.sum("monthly_sales").over(down_to_here), whole), 2),
            }
        )
        .orderBy("year_month", F.desc("monthly_sales"), "division_code")
    )


def percentiles(division_daily: DataFrame) -> DataFrame:
    """Exact interpolated quartiles; a division holds at most one value per day."""
    at = lambda q: rnd(quantile("sales_amt", q), 0)
    return (
        division_daily.groupBy("division_code", "division_name")
        .agg(
            rnd(F.min("sales_amt"), 0).alias("p0_min"),
            at(0.25).alias("p25"), at(0.5).alias("p50_median"), at(0.75).alias("p75"),
            rnd(F.max("sales_amt"), 0).alias("p100_max"),
        )
        .orderBy(F.desc("p50_median"), "division_code")
    )


def rolling_customers(daily: DataFrame) -> DataFrame:
    week = trailing(["date"], 7)
    return daily.select(
        "date", "num_customers", "avg_spend",
        rnd(mean_over("num_customers", week), 0).alias("rolling_7d_customers"),
        rnd(mean_over("avg_spend", week), 2).alias("rolling_7d_avg_spend"),
    ).orderBy("date")


def gp_rank_in_department(division_daily: DataFrame) -> DataFrame:
    within = Window.partitionBy("year", "department").orderBy(F.desc("_gp"))
    return (
        division_daily.groupBy(F.year("date").alias("year"), *DIVISION)
        .agg(rnd(total("sales_amt"), 0).alias("total_sales"), mean("gp_ratio").alias("_gp"))
        .select(
            "year", *DIVISION, "total_sales",
            rnd(F.col("_gp") * 100, 2).alias("avg_gp_pct"),
            big(F.rank().over(within)).alias("gp_rank_in_dept"),
        )
        .orderBy("year", "department", "gp_rank_in_dept", "division_code")
    )


def annual_leaderboard(division_daily: DataFrame) -> DataFrame:
    of_year = Window.partitionBy("year")
    return (
        division_daily.groupBy(F.year("date").alias("year"), *DIVISION)
        .agg(total("sales_amt").alias("_sales"), total("gp_amt").alias("_gp"), mean("gp_ratio").alias("_ratio"))
        .select(
            *DIVISION, "year",
            rnd("_sales", 0).alias("total_sales"),
            rnd("_gp", 0).alias("total_gp"),
            rnd(F.col("_ratio") * 100, 2).alias("avg_gp_pct"),
            big(F.rank().over(of_year.orderBy(F.desc("_sales")))).alias("revenue_rank"),
            big(F.rank().over(of_year.orderBy(F.desc("_ratio")))).alias("gp_pct_rank"),
        )
        .orderBy("year", "revenue_rank", "division_code")
    )


def mix_shift(division_daily: DataFrame) -> DataFrame:
    whole = F.sum("monthly_sales").over(Window.partitionBy("year_month"))
    return (
        division_months(division_daily, "department")
        .withColumn("revenue_pct", rnd(pct("monthly_sales", whole), 2))
        .orderBy("year_month", F.desc("revenue_pct"), "division_code")
    )


def division_yoy(division_daily: DataFrame, year: int, next_year: int) -> DataFrame:
    """Two years side by side from one pass; divisions missing in either year drop out."""
    sales_in = lambda y: F.sum(F.when(cal.in_year("date", y), F.col("sales_amt")))
    return (
        division_daily.where(cal.in_year("date", year) | cal.in_year("date", next_year))
        .groupBy(*DIVISION)
        .agg(sales_in(year).alias("sales_first"), sales_in(next_year).alias("sales_second"))
        .where(F.col("sales_first").isNotNull() & F.col("sales_second").isNotNull())
        .withColumn("yoy_pct", rnd(pct_change("sales_second", "sales_first"), 2))
        .orderBy(F.desc("yoy_pct"), "division_code")
    )


def month_yoy(division_daily: DataFrame, codes: list[int]) -> DataFrame:
    """Month totals against the twelfth month before, for chosen divisions."""
    year_ago = F.lag("monthly_sales", 12).over(Window.partitionBy("division_code").orderBy("year_month"))
    return (
        division_months(division_daily.where(F.col("division_code").isin(codes)))
        .withColumn("same_month_ly", year_ago)
        .withColumn("yoy_pct", rnd(pct_change("monthly_sales", "same_month_ly"), 2))
        .orderBy("division_code", "year_month")
    )


def temperature_response(daily: DataFrame, division_daily: DataFrame, codes: list[int]) -> DataFrame:
    context = daily.select("date", "temperature_index")
    return (
        division_daily.where(F.col("division_code").isin(codes))
        .join(context, "date")
        .groupBy(cal.temp_band("temperature_index").alias("temp_band"), "division_code", "division_name")
        .agg(
            F.countDistinct("date").alias("num_days"),
            rnd(mean("sales_amt"), 0).alias("avg_daily_sales"),
            rnd(F.max("sales_amt"), 0).alias("peak_daily_sales"),
            F.min("temperature_index").alias("_coldest"),
        )
        .orderBy("_coldest", "division_code")
        .drop("_coldest")
    )


def share_of_store(division_daily: DataFrame, code: int) -> DataFrame:
    """One division against the whole store, as conditional sums of a single month grouping."""
    own = F.col("division_code") == code
    mine = lambda c: F.when(own, F.col(c))
    return (
        division_daily.groupBy(cal.year_month("date").alias("year_month"))
        .agg(
            F.sum(mine("sales_amt")).alias("_sales"),
            F.sum(mine("gp_amt")).alias("_gp"),
            mean(mine("gp_ratio")).alias("_ratio"),
            total("sales_amt").alias("_store"),
        )
        .where(F.col("_sales").isNotNull())
        .select(
            "year_month",
            rnd("_sales", 0).alias("monthly_sales"),
            rnd(F.col("_ratio") * 100, 2).alias("avg_gp_pct"),
            rnd("_gp", 0).alias("monthly_gp"),
            rnd(pct("_sales", "_store"), 2).alias("pct_of_store_monthly"),
        )
        .orderBy("year_month")
    )


def department_share(division_daily: DataFrame) -> DataFrame:
    whole = F.sum("_sales").over(Window.partitionBy("year_month"))
    return (
        division_daily.groupBy(cal.year_month("date").alias("year_month"), "department")
        .agg(total("sales_amt").alias("_sales"), mean("gp_ratio").alias("_ratio"))
        .select(
            "year_month", "department",
            rnd("_sales", 0).alias("dept_sales"),
            rnd(F.col("_ratio") * 100, 2).alias("avg_gp_pct"),
            rnd(pct("_sales", whole), 2).alias("dept_pct"),
        )
        .orderBy("year_month", F.desc("dept_sales"))
    )


def top_skus(items: DataFrame, products: DataFrame, k: int = 30) -> DataFrame:
    """Largest SKUs by revenue: lines are summed per SKU before the product join."""
    per_sku = items.groupBy("sku_id").agg(
        F.count("*").alias("num_transactions"),
        F.sum("quantity").alias("units_sold"),
        F.sum(F.col("discounted_price") * F.col("quantity")).alias("_revenue"),
        total("gross_profit_amt").alias("_gp"),
    )
    largest = per_sku.orderBy(F.desc("_revenue"), "sku_id").limit(k)
    described = products.select(
        "sku_id", "product_name", "division_name", "department", "price_tier", "unit_price"
    )
    return (
        described.join(F.broadcast(largest), "sku_id")
        .select(
            *described.columns, "num_transactions", "units_sold",
            rnd("_revenue", 0).alias("total_revenue"),
            rnd("_gp", 0).alias("total_gp"),
        )
        .orderBy(F.desc("total_revenue"), "sku_id")
    )
