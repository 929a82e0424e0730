"""Check statements of the sales summaries, trends and published tables."""

from oracle.tables import statement as q

Y1, Y2 = 1999, 2000

SQL = {
    "eda_daily_summary": q("daily_sales", """
SELECT date::VARCHAR AS date, day_of_week, event_flag, temperature_index::DOUBLE AS temperature_index,
       actual_sales::DOUBLE AS actual_sales, target::DOUBLE AS target, achievement_pct::DOUBLE AS achievement_pct,
       gross_profit_amt::DOUBLE AS gross_profit_amt, gross_profit_ratio::DOUBLE AS gross_profit_ratio,
       num_customers, avg_spend::DOUBLE AS avg_spend
FROM daily_sales"""),
    "eda_weekly_sales": q("daily_sales", """
SELECT strftime(date, '%Y-W%W') AS year_week, min(date)::VARCHAR AS week_start,
       sum(actual_sales)::DOUBLE AS weekly_sales, sum(gross_profit_amt)::DOUBLE AS weekly_gp,
       round(sum(gross_profit_ratio)::DOUBLE / count(*), 4) AS avg_gp_pct,
       sum(num_customers)::BIGINT AS total_customers,
       round(sum(achievement_pct)::DOUBLE / count(*), 4) AS avg_achievement, count(*) AS trading_days
FROM daily_sales GROUP BY 1"""),
    "eda_monthly_sales": q("daily_sales", """
SELECT strftime(date, '%Y-%m') AS year_month, sum(actual_sales)::DOUBLE AS monthly_sales,
       sum(gross_profit_amt)::DOUBLE AS monthly_gp,
       round(sum(gross_profit_ratio)::DOUBLE / count(*), 4) AS avg_gp_pct,
       round(sum(actual_sales)::DOUBLE / count(*), 0) AS avg_daily_sales,
       sum(num_customers)::BIGINT AS total_customers,
       count(*) FILTER (achievement_pct >= 1) AS days_on_target, count(*) AS trading_days,
       round((count(*) FILTER (achievement_pct >= 1))::DOUBLE / count(*), 4) AS target_hit_rate
FROM daily_sales GROUP BY 1"""),
    "eda_dow_profile": q("daily_sales", """
SELECT day_of_week, count(*) AS num_days,
       round(sum(actual_sales)::DOUBLE / count(*), 0) AS avg_sales,
       round(sum(target)::DOUBLE / count(*), 0) AS avg_target,
       round(sum(achievement_pct)::DOUBLE / count(*), 4) AS avg_achievement,
       round(min(actual_sales)::DOUBLE, 0) AS min_sales, round(max(actual_sales)::DOUBLE, 0) AS max_sales,
       round(sum(num_customers)::DOUBLE / count(*), 0) AS avg_customers,
       round(sum(avg_spend)::DOUBLE / count(*), 2) AS avg_basket
FROM daily_sales GROUP BY 1"""),
    "eda_event_impact": q("daily_sales", """
SELECT event_flag, count(*) AS num_days,
       round(sum(actual_sales)::DOUBLE / count(*), 0) AS avg_sales,
       round(sum(achievement_pct)::DOUBLE / count(*), 4) AS avg_achievement,
       round(sum(num_customers)::DOUBLE / count(*), 0) AS avg_customers,
       round(sum(avg_spend)::DOUBLE / count(*), 2) AS avg_basket,
       round(sum(gross_profit_ratio)::DOUBLE / count(*), 4) AS avg_gp_pct
FROM daily_sales GROUP BY 1"""),
    "eda_top_divisions_year": q("division_daily", f"""
, y AS (SELECT * FROM division_daily WHERE year(date) = {Y1})
SELECT division_code, division_name, department,
       round(sum(sales_amt)::DOUBLE, 0) AS total_sales, round(sum(gp_amt)::DOUBLE, 0) AS total_gp,
       round(sum(gp_ratio)::DOUBLE / count(*), 4) AS avg_gp_pct,
       round(sum(sales_amt)::DOUBLE * 100 / (SELECT sum(sales_amt)::DOUBLE FROM y), 2) AS pct_of_total
FROM y GROUP BY ALL"""),
    "eda_division_month_sales": q("division_daily", f"""
SELECT strftime(date, '%Y-%m') AS year_month, division_code, division_name,
       round(sum(sales_amt)::DOUBLE, 0) AS monthly_sales
FROM division_daily WHERE year(date) = {Y1} GROUP BY ALL"""),
    "eda_season_heatmap": q("division_daily", """
SELECT month(date)::INTEGER AS month_num, division_code, division_name,
       round(sum(sales_amt)::DOUBLE / count(*), 0) AS avg_daily_sales
FROM division_daily GROUP BY ALL"""),
    "eda_cold_snap_effect": q("daily_sales division_daily", """
SELECT CASE WHEN temperature_index < 12 THEN 'Very Cold (<12°C)' WHEN temperature_index < 15 THEN 'Cold (12–15°C)'
            WHEN temperature_index < 20 THEN 'Mild (15–20°C)' ELSE 'Warm (>20°C)' END AS temp_band,
       round((sum(sales_amt) FILTER (division_code IN (21, 11)))::DOUBLE
             / count(*) FILTER (division_code IN (21, 11)), 0) AS avg_outerwear_sales,
       round((sum(sales_amt) FILTER (division_code IN (24, 14)))::DOUBLE
             / count(*) FILTER (division_code IN (24, 14)), 0) AS avg_cutsewn_sales,
       count(DISTINCT date) AS num_days
FROM division_daily JOIN daily_sales USING (date) GROUP BY 1"""),
    "eda_customer_segments": q("customers", """
SELECT customer_type, count(*) AS num_customers,
       round(sum(avg_spend_per_visit)::DOUBLE / count(avg_spend_per_visit), 2) AS avg_spend,
       round(sum(total_visits)::DOUBLE / count(*), 1) AS avg_visits,
       round(sum(total_spend)::DOUBLE / count(*), 2) AS avg_total_spend,
       round(sum(total_spend)::DOUBLE, 0) AS sum_total_spend
FROM customers GROUP BY 1"""),
    "eda_yoy_by_month": q("daily_sales", f"""
, m AS (SELECT strftime(date, '%m') AS month_num,
        sum(CASE WHEN year(date) = {Y1} THEN actual_sales ELSE 0 END) AS s1,
        sum(CASE WHEN year(date) = {Y2} THEN actual_sales ELSE 0 END) AS s2 FROM daily_sales GROUP BY 1)
SELECT month_num, s1::DOUBLE AS sales_first, s2::DOUBLE AS sales_second,
       round((s2 - s1)::DOUBLE * 100 / nullif(s1, 0)::DOUBLE, 2) AS yoy_pct_change FROM m"""),
    "eda_gp_rank": q("division_daily", """
SELECT division_code, division_name, department,
       round(sum(gp_ratio)::DOUBLE / count(*) * 100, 2) AS avg_gp_pct,
       round(sum(sales_amt)::DOUBLE, 0) AS total_sales, round(sum(gp_amt)::DOUBLE, 0) AS total_gp
FROM division_daily GROUP BY ALL"""),
    "nb_daily_trend": q("daily_sales", """
SELECT date::VARCHAR AS date, actual_sales::DOUBLE AS actual_sales, target::DOUBLE AS target,
       achievement_pct::DOUBLE AS achievement_pct, gross_profit_amt::DOUBLE AS gross_profit_amt,
       gross_profit_ratio::DOUBLE AS gross_profit_ratio, event_flag,
       temperature_index::DOUBLE AS temperature_index, num_customers,
       CASE WHEN count(*) OVER w = 7 THEN sum(actual_sales) OVER w::DOUBLE / 7 END AS rolling_7d
FROM daily_sales WINDOW w AS (ORDER BY date ROWS 6 PRECEDING)"""),
    "nb_dow_distribution": q("daily_sales", """
SELECT day_of_week, min(actual_sales)::DOUBLE AS min_sales,
       round(quantile_cont(actual_sales::DOUBLE, 0.25), 4) AS q1,
       round(quantile_cont(actual_sales::DOUBLE, 0.5), 4) AS median,
       round(quantile_cont(actual_sales::DOUBLE, 0.75), 4) AS q3,
       max(actual_sales)::DOUBLE AS max_sales
FROM daily_sales GROUP BY 1"""),
    "nb_division_annual": q("division_daily", """
SELECT division_code, division_name, department, sum(sales_amt)::DOUBLE AS total_sales,
       sum(gp_ratio)::DOUBLE / count(*) AS avg_gp
FROM division_daily GROUP BY ALL"""),
    "nb_season_pivot": q("division_daily", "SELECT division_name, " + ", ".join(
        f"round((sum(sales_amt) FILTER (month(date) = {i}))::DOUBLE / count(*) FILTER (month(date) = {i}), 0) AS {m}"
        for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)
    ) + " FROM division_daily GROUP BY 1"),
    "nb_temp_vs_group": q("daily_sales division_daily", """
SELECT date::VARCHAR AS date, any_value(temperature_index)::DOUBLE AS temperature_index,
       any_value(event_flag) AS event_flag,
       sum(CASE WHEN division_code IN (21, 11) THEN sales_amt ELSE 0 END)::DOUBLE AS outerwear_sales,
       sum(CASE WHEN division_code IN (24, 14) THEN sales_amt ELSE 0 END)::DOUBLE AS cutsewn_sales
FROM daily_sales JOIN division_daily USING (date) GROUP BY daily_sales.date, date"""),
    "nb_gp_by_division": q("division_daily", """
SELECT division_name, department, round(sum(gp_ratio)::DOUBLE / count(*) * 100, 2) AS avg_gp_pct,
       round(sum(sales_amt)::DOUBLE, 0) AS total_sales
FROM division_daily GROUP BY division_code, division_name, department"""),
    "nb_yoy_by_month": q("daily_sales", f"""
, m AS (SELECT month(date) AS mo, strftime(date, '%m') AS month_num,
        sum(CASE WHEN year(date) = {Y1} THEN actual_sales ELSE 0 END) AS s1,
        sum(CASE WHEN year(date) = {Y2} THEN actual_sales ELSE 0 END) AS s2 FROM daily_sales GROUP BY 1, 2)
SELECT month_num, s1::DOUBLE AS sales_first, s2::DOUBLE AS sales_second,
       (s2 - s1)::DOUBLE * 100 / nullif(s1, 0)::DOUBLE AS yoy_pct,
       strftime(make_date(2000, mo::INTEGER, 1), '%b') AS month FROM m"""),
    "nb_segment_spend": q("customers", """
SELECT customer_type, count(*) AS num_customers,
       round(sum(avg_spend_per_visit)::DOUBLE / count(avg_spend_per_visit), 2) AS avg_spend,
       round(sum(total_visits)::DOUBLE / count(*), 1) AS avg_visits,
       round(sum(total_spend)::DOUBLE, 0) AS total_revenue
FROM customers GROUP BY 1"""),
    "rep_event_lift": q("daily_sales", """
, e AS (SELECT event_flag, count(*) AS n, sum(actual_sales)::DOUBLE / count(*) AS a FROM daily_sales GROUP BY 1),
b AS (SELECT a AS base FROM e WHERE event_flag = 'None')
SELECT event_flag, n AS num_days, round(a, 0) AS avg_sales,
       CASE WHEN event_flag <> 'None' THEN round((a - base) * 100 / base, 2) END AS lift_pct FROM e, b"""),
    "rep_segment_mix": q("transactions", """
SELECT customer_type, count(*) AS num_transactions,
       round(sum(total_amount)::DOUBLE / count(*), 2) AS avg_basket,
       round(count(*)::DOUBLE * 100 / (SELECT count(*) FROM transactions), 2) AS share_pct
FROM transactions GROUP BY 1"""),
    "rep_dow_pattern": q("daily_sales", """
SELECT day_of_week, round(sum(actual_sales)::DOUBLE / count(*), 0) AS avg_sales,
       round(sum(num_customers)::DOUBLE / count(*), 0) AS avg_customers,
       round(sum(achievement_pct)::DOUBLE / count(*) * 100, 1) AS avg_achievement_pct
FROM daily_sales GROUP BY 1"""),
    "rep_seasonal_ratio": q("division_daily", """
, s AS (SELECT division_code, division_name, department,
  (sum(sales_amt) FILTER (month(date) IN (6,7,8)))::DOUBLE / nullif(count(*) FILTER (month(date) IN (6,7,8)), 0) AS w,
  (sum(sales_amt) FILTER (month(date) IN (12,1,2)))::DOUBLE / nullif(count(*) FILTER (month(date) IN (12,1,2)), 0) AS u
  FROM division_daily GROUP BY ALL)
SELECT division_code, division_name, department, round(w, 0) AS winter_avg, round(u, 0) AS summer_avg,
       round(w / nullif(u, 0), 2) AS winter_to_summer FROM s"""),
    "rep_top10_mix": q("division_daily", """
, t AS (SELECT division_code, division_name, department, sum(sales_amt) AS s FROM division_daily GROUP BY ALL)
SELECT division_code, division_name, department, s::DOUBLE AS total_sales,
       row_number() OVER (ORDER BY s DESC, division_code) AS position,
       round(s::DOUBLE * 100 / sum(s) OVER ()::DOUBLE, 2) AS share_pct,
       round(sum(s) OVER (ORDER BY s DESC, division_code ROWS UNBOUNDED PRECEDING)::DOUBLE * 100
             / sum(s) OVER ()::DOUBLE, 2) AS combined_share_pct
FROM t QUALIFY position <= 10"""),
    "rep_temp_bands": q("daily_sales", """
SELECT CASE WHEN temperature_index < 15 THEN 'Cold (<15°C)' WHEN temperature_index <= 22 THEN 'Mild (15-22°C)'
            ELSE 'Warm (>22°C)' END AS temp_band, count(*) AS num_days,
       round(sum(actual_sales)::DOUBLE / count(*), 0) AS avg_sales
FROM daily_sales GROUP BY 1"""),
    "rep_store_summary": q("daily_sales products", """
SELECT sum(actual_sales)::DOUBLE AS total_revenue, round(sum(gross_profit_ratio)::DOUBLE / count(*), 4) AS avg_gp_ratio,
       min(date)::VARCHAR AS first_date, max(date)::VARCHAR AS last_date,
       (SELECT min(unit_price)::DOUBLE FROM products) AS min_price,
       (SELECT max(unit_price)::DOUBLE FROM products) AS max_price,
       (SELECT round(sum(unit_price)::DOUBLE / count(*), 2) FROM products) AS avg_price
FROM daily_sales"""),
}
