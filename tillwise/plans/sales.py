"""Sales summaries, trends and published tables over a store."""

from tillwise.operators import sales, trends

PLANS = {
    "eda_daily_summary": lambda s: sales.daily_summary(s.daily_sales),
    "eda_weekly_sales": lambda s: sales.weekly_sales(s.daily_sales),
    "eda_monthly_sales": lambda s: sales.monthly_sales(s.daily_sales),
    "eda_dow_profile": lambda s: sales.dow_profile(s.daily_sales),
    "eda_event_impact": lambda s: sales.event_impact(s.daily_sales),
    "eda_top_divisions_year": lambda s: sales.top_divisions(s.division_daily, s.settings.year),
    "eda_division_month_sales": lambda s: sales.division_month_sales(s.division_daily, s.settings.year),
    "eda_season_heatmap": lambda s: sales.season_heatmap(s.division_daily),
    "eda_cold_snap_effect": lambda s: sales.cold_snap_effect(s.daily_sales, s.division_daily, s.settings.cold_group, s.settings.flat_group),
    "eda_customer_segments": lambda s: sales.customer_segments(s.customers),
    "eda_yoy_by_month": lambda s: sales.yoy_by_month(s.daily_sales, s.settings.year, s.settings.next_year),
    "eda_gp_rank": lambda s: sales.gp_rank(s.division_daily),
    "win_rolling_7_28": lambda s: trends.rolling_sales(s.daily_sales),
    "win_ytd": lambda s: trends.year_to_date(s.daily_sales),
    "win_weekly_rank": lambda s: trends.weekly_rank(s.division_daily),
    "win_rolling_4w": lambda s: trends.rolling_four_weeks(s.division_daily),
    "win_dod": lambda s: trends.day_over_day(s.daily_sales),
    "win_wow": lambda s: trends.week_over_week(s.division_daily),
    "win_cum_share": lambda s: trends.cumulative_share(s.division_daily),
    "win_percentiles": lambda s: trends.percentiles(s.division_daily),
    "win_rolling_customers": lambda s: trends.rolling_customers(s.daily_sales),
    "win_gp_rank_in_dept": lambda s: trends.gp_rank_in_department(s.division_daily),
    "div_annual_leaderboard": lambda s: trends.annual_leaderboard(s.division_daily),
    "div_mix_shift": lambda s: trends.mix_shift(s.division_daily),
    "div_yoy": lambda s: trends.division_yoy(s.division_daily, s.settings.year, s.settings.next_year),
    "div_month_yoy_lag12": lambda s: trends.month_yoy(s.division_daily, s.settings.watched),
    "div_temp_response": lambda s: trends.temperature_response(s.daily_sales, s.division_daily, s.settings.cold_group),
    "div_share_of_store": lambda s: trends.share_of_store(s.division_daily, s.settings.spotlight),
    "dept_monthly_share": lambda s: trends.department_share(s.division_daily),
    "top_skus": lambda s: trends.top_skus(s.transaction_items, s.products),
    "nb_daily_trend": lambda s: sales.daily_trend(s.daily_sales),
    "nb_dow_distribution": lambda s: sales.dow_distribution(s.daily_sales),
    "nb_division_annual": lambda s: sales.division_annual(s.division_daily),
    "nb_season_pivot": lambda s: sales.season_pivot(s.division_daily),
    "nb_temp_vs_group": lambda s: sales.temp_vs_groups(s.daily_sales, s.division_daily, s.settings.cold_group, s.settings.flat_group),
    "nb_gp_by_division": lambda s: sales.gp_by_division(s.division_daily),
    "nb_yoy_by_month": lambda s: sales.yoy_by_month_labelled(s.daily_sales, s.settings.year, s.settings.next_year),
    "nb_segment_spend": lambda s: sales.segment_spend(s.customers),
    "rep_event_lift": lambda s: sales.event_lift(s.daily_sales),
    "rep_segment_mix": lambda s: sales.segment_mix(s.transactions),
    "rep_dow_pattern": lambda s: sales.dow_pattern(s.daily_sales),
    "rep_seasonal_ratio": lambda s: sales.seasonal_ratio(s.division_daily),
    "rep_top10_mix": lambda s: sales.top_mix(s.division_daily),
    "rep_temp_bands": lambda s: sales.temp_bands(s.daily_sales),
    "rep_store_summary": lambda s: sales.store_summary(s.daily_sales, s.products),
}
