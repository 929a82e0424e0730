"""Hand-made frames for the rules that ordinary data seldom reaches."""

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.operators import dashboard, features, monitor, prep, sales, segments, stock, trends


def days(n, start=date(2024, 1, 1)):
    return [start + timedelta(i) for i in range(n)]


def division_frame(spark, rows):
    return spark.createDataFrame(
        [(d, c, f"D{c}", "Women", Decimal(str(a)), Decimal("1.00"), Decimal("0.5")) for d, c, a in rows],
        "date date, division_code int, division_name string, department string, sales_amt decimal(18,2), "
        "gp_amt decimal(18,2), gp_ratio decimal(18,4)",
    )


def daily_frame(spark, values, start=date(2024, 1, 1)):
    rows = [(d, Decimal(str(v)) if v is not None else None) for d, v in zip(days(len(values), start), values)]
    df = spark.createDataFrame(rows, "date date, actual_sales decimal(18,2)")
    return df.withColumns({"day_of_week": cal.day_name("date"), "target": F.lit(1).cast("decimal(18,2)")})


def test_equal_divisions_share_a_rank_and_keep_a_fixed_order(spark):
    df = division_frame(spark, [(d, c, a) for d in days(3) for c, a in ((1, 5), (2, 5), (3, 1))])
    board = {r.division_code: r.revenue_rank for r in trends.annual_leaderboard(df).collect()}
    assert board == {1: 1, 2: 1, 3: 3}
    share = [(r.division_code, r.cumulative_pct) for r in trends.cumulative_share(df).collect()]
    assert share == [(1, 45.45), (2, 90.91), (3, 100.0)]


@pytest.mark.parametrize("day, label", [("2023-12-31", "2023-W52"), ("2024-01-01", "2024-W01"), ("2025-01-01", "2025-W00")])
def test_week_labels_around_new_year(spark, day, label):
    assert spark.range(1).select(cal.year_week(F.lit(day).cast("date"))).first()[0] == label


def test_strict_and_partial_rolling_means(spark):
    df = daily_frame(spark, [1, 2, 3, 4, 5, 6])
    assert [r.rolling_7d_avg for r in trends.rolling_sales(df).collect()] == [1, 2, 2, 3, 3, 4]
    strict = df.withColumns({c: F.lit(None).cast("double") for c in (
        "achievement_pct", "gross_profit_amt", "gross_profit_ratio", "event_flag", "temperature_index", "num_customers")})
    assert {r.rolling_7d for r in sales.daily_trend(strict).collect()} == {None}


def test_short_history_has_no_lags(spark):
    df = division_frame(spark, [(d, 1, i) for i, d in enumerate(days(6))]).withColumns(
        {"event_flag": F.lit("None"), "temperature_index": F.lit(14.9), "is_public_holiday": F.lit(True), "promo_flag": F.lit(False)}
    )
    rows = features.build_features(df).orderBy("date").collect()
    assert {r.lag_7 for r in rows} == {None} and {r.lag_364 for r in rows} == {None}
    assert [r.rolling_7_mean for r in rows] == [None, 0.0, 0.5, 1.0, 1.5, 2.0]
    assert {(r.cold_snap, r.is_public_holiday, r.promo_flag) for r in rows} == {(1, 1, 0)}


def test_zero_and_missing_bases_give_null(spark):
    rows = trends.day_over_day(daily_frame(spark, [0, 5, 10])).collect()
    assert [r.dod_pct_change for r in rows] == [None, None, 100.0]
    yoy = prep.yoy_same_weekday(daily_frame(spark, [4] * 365)).orderBy("date").collect()
    assert [r.yoy_pct for r in yoy[:364]] == [None] * 364 and yoy[364].yoy_pct == 0


def test_lag_twelve_counts_rows_of_months(spark):
    df = division_frame(spark, [(date(2023 + m // 12, m % 12 + 1, 1), 28, 100 + m) for m in range(13)])
    rows = trends.month_yoy(df, [28]).collect()
    assert [r.same_month_ly for r in rows[:12]] == [None] * 12 and float(rows[12].same_month_ly) == 100


def loop_streak(values, limit):
    run = 0
    for v in reversed([v for v in values if v is not None]):
        if abs(v) <= limit:
            break
        run += 1
    return run


@pytest.mark.parametrize(
    "values", [[9, 9, 1, 9, 9, -9, 9], [9] * 5, [1] * 5, [9, None, 9, 1, None, 9, None, 8], [5.0, 5.01]]
)
def test_streak_matches_a_loop(spark, values):
    rows = [(d, 1, "Monday", float(v) if v is not None else None) for d, v in zip(days(len(values)), values)]
    df = spark.createDataFrame(rows, "target_date date, division_code int, day_of_week string, rolling_6w_bias double")
    assert monitor.bias_streaks(df).first().streak == loop_streak(values, 5)


def test_bias_needs_four_values_and_skips_zero_sales(spark):
    log = spark.createDataFrame(
        [(d, 1, Decimal("90"), Decimal(a) if a else None, "Monday/None") for d, a in zip(days(6), ["100", None, "100", "100", "100", "100"])],
        "target_date date, division_code int, predicted_sales decimal(18,2), actual_sales decimal(18,2), context_flags string",
    )
    rows = monitor.rolling_bias(log).orderBy("target_date").collect()
    assert [r.rolling_6w_bias for r in rows] == [None, None, None, None, 10.0, 10.0]


def test_zero_error_and_zero_actual_are_null_in_the_log(spark):
    rows = [(d, 1, Decimal(a)) for d, a in zip(days(4), ["10", "0", "8", "10"])]
    df = spark.createDataFrame(rows, "date date, division_code int, sales_amt decimal(18,2)").withColumns(
        {"day_of_week": F.lit("Monday"), "event_flag": F.lit("None"), "predicted_sales": F.lit(10).cast("decimal(18,2)"),
         "lower_bound": F.lit(1), "upper_bound": F.lit(2)})
    log = monitor.as_log(df, df.select("date")).orderBy("target_date").collect()
    assert [r.error_pct for r in log] == [None, None, Decimal("-0.2500"), None]
    assert log[1].actual_sales is None and log[0].forecast_date == days(1)[0] - timedelta(7)


def test_walk_forward_never_sees_its_own_day_or_later(spark):
    values = [(i * 37) % 101 for i in range(60)]
    df = spark.createDataFrame(
        [(d, 1, Decimal(v)) for d, v in zip(days(60), values)], "date date, division_code int, sales_amt decimal(18,2)"
    ).withColumn("day_of_week", cal.day_name("date"))
    for horizon in (1, 15):
        got = monitor.walk_forward_means(df, horizon).orderBy("date").collect()
        for i, row in enumerate(got):
            past = [v for j, v in enumerate(values) if j % 7 == i % 7 and i - j >= horizon]
            assert (row.predicted_sales is None) == (not past)
            if past:
                assert float(row.predicted_sales) == pytest.approx(sum(past) / len(past), abs=0.0051)


def test_reliability_boundaries(spark):
    contexts = spark.createDataFrame(
        [("Monday", e) for e in ("Arigato", "Christmas", "Vivid", "EOFY", "LongWeekend", "None")] + [("Friday", "None"), ("Sunday", "None")],
        "day_of_week string, event_flag string",
    )
    lookup = spark.createDataFrame(
        [("Monday", "Arigato", 1.0), ("Monday", "EOFY", 4.9), ("Monday", "LongWeekend", 5.0), ("Monday", "None", 12.0)],
        "day_of_week string, event_flag string, mean_mape double",
    )
    got = {(r.day_of_week, r.event_flag): (r.flag, r.explanation) for r in monitor.reliability(contexts, lookup).collect()}
    assert [got[("Monday", e)][0] for e in ("Arigato", "Christmas", "Vivid")] == ["LOW"] * 3
    assert got[("Monday", "EOFY")] == ("HIGH", "Historical MAPE for Monday / EOFY: 4.9% — reliable context.")
    assert got[("Monday", "LongWeekend")][0] == "MEDIUM" and got[("Monday", "None")][0] == "LOW"
    assert got[("Friday", "None")] == ("MEDIUM", "Insufficient history for this context.")


def test_scenario_context_falls_back_below_four_rows(spark):
    rows = [(1, 1, 10.0)] * 4 + [(1, 2, 50.0)] * 3
    df = spark.createDataFrame(rows, "division_code int, month int, lag_7 double").withColumns(
        {c: F.col("lag_7") for c in dashboard.CONTEXT_FEATURES[1:]}
    )
    got = {r.month: (r.num_rows, r.lag_14) for r in dashboard.scenario_context(df).collect()}
    assert got[1] == (4, 10.0)
    assert got[2] == (3, pytest.approx(190 / 7)) and got[3] == (0, pytest.approx(190 / 7))


def test_event_rules_take_the_first_match(spark):
    cases = [
        ("2024-05-21", 20, "Arigato"), ("2024-05-27", 20, "Arigato"), ("2024-05-28", 15, "Vivid"), ("2024-05-28", 14, "None"),
        ("2024-06-08", 10, "LongWeekend"), ("2024-06-15", 15, "Vivid"), ("2024-06-16", 20, "None"), ("2024-06-20", 20, "EOFY"),
        ("2024-07-15", 20, "EOFY"), ("2024-07-16", 20, "None"), ("2024-12-23", 20, "None"), ("2024-12-24", 20, "Christmas"),
        ("2024-12-27", 20, "Christmas"), ("2024-03-29", 20, "LongWeekend"),
    ]
    df = spark.createDataFrame([(date.fromisoformat(d), float(t)) for d, t, _ in cases], "date date, temperature_index double")
    got = {(str(r.date), r.temperature_index): r.event_flag for r in prep.event_calendar(df).collect()}
    assert got == {(d, float(t)): e for d, t, e in cases}


def test_segment_rules(spark):
    cases = {
        (4, 3, 3): "Champions", (4, 3, 2): "Loyal Customers", (4, 2, 4): "Recent Customers", (3, 2, 3): "Potential Loyalists",
        (2, 3, 3): "At Risk", (1, 3, 2): "Cant Lose Them", (2, 2, 3): "Hibernating High Value", (2, 4, 1): "Low Value",
    }
    df = spark.createDataFrame(list(cases), "r int, f int, m int").withColumn(
        "segment", segments.segment_name(F.col("r"), F.col("f"), F.col("m")))
    assert {(x.r, x.f, x.m): x.segment for x in df.collect()} == cases


def loop_ledger(sold, velocity):
    stock_now, out = velocity * stock.OPENING_WEEKS, []
    for units in sold:
        more = velocity * stock.TOP_UP_WEEKS if stock_now < 4 * velocity else 0
        close = max(0, stock_now + more - units)
        out.append((stock_now, units, more, close, close == 0 and units > 0))
        stock_now = close
    return out


def test_stock_ledger_matches_a_loop(spark):
    weeks = [date(2024, 1, 1) + timedelta(7 * i) for i in range(12)]
    sold = {1: [200, 0, 90, 5, 300, 0, 0, 161, 1, 0, 40, 9], 2: [0, 0, 3, 0, 0, 44, 0, 0, 0, 90, 2, 1], 3: [0] * 12}
    units = spark.createDataFrame(
        [(w, sku, u) for sku, us in sold.items() for w, u in zip(weeks, us) if u], "week_start date, sku_id bigint, units_sold bigint")
    products = spark.createDataFrame([(1, "Entry"), (2, "Premium"), (3, "Core")], "sku_id bigint, price_tier string")
    dates = spark.createDataFrame([(weeks[0] + timedelta(3),), (weeks[-1],)], "date date")
    got = stock.stock_ledger(units, products, dates).orderBy("sku_id", "week_start_date").collect()
    want = [row for sku, tier in ((1, "Entry"), (2, "Premium"), (3, "Core")) for row in loop_ledger(sold[sku], stock.VELOCITY[tier])]
    assert [(r.opening_stock, r.units_sold, r.units_received, r.closing_stock, r.oos_flag) for r in got] == want
    assert [r.week_start_date for r in got[:12]] == weeks
    assert any(r.units_received for r in got) and any(r.oos_flag for r in got)


def test_allocation_keeps_the_day_total(store):
    split = prep.allocate(store.daily_sales, store.products)
    days_total = split.groupBy("date").agg(F.sum("sales_amt").alias("s"), F.count("*").alias("n"))
    gap = days_total.join(store.daily_sales, "date").agg(F.max(F.abs(F.col("s") - F.col("actual_sales"))), F.min("n")).first()
    assert float(gap[0]) <= 0.005 * 25 and gap[1] == 25
