"""Check statements of the window and division queries."""

from oracle.tables import statement as q

Y1, Y2 = 1999, 2000

WEEKS = """
, weeks AS (SELECT strftime(date, '%Y-W%W') AS year_week, division_code, division_name,
                   min(date) AS week_start, sum(sales_amt) AS s
            FROM division_daily GROUP BY 1, 2, 3)"""
MONTHS = """
, months AS (SELECT strftime(date, '%Y-%m') AS year_month, division_code, division_name, department,
                    sum(sales_amt) AS s FROM division_daily GROUP BY 1, 2, 3, 4)"""

SQL = {
    "win_rolling_7_28": q("daily_sales", """
SELECT date::VARCHAR AS date, actual_sales::DOUBLE AS actual_sales,
       round(sum(actual_sales) OVER a::DOUBLE / count(*) OVER a, 0) AS rolling_7d_avg,
       round(sum(actual_sales) OVER b::DOUBLE / count(*) OVER b, 0) AS rolling_28d_avg
FROM daily_sales WINDOW a AS (ORDER BY date ROWS 6 PRECEDING), b AS (ORDER BY date ROWS 27 PRECEDING)"""),
    "win_ytd": q("daily_sales", """
SELECT date::VARCHAR AS date, year(date)::INTEGER AS year, actual_sales::DOUBLE AS actual_sales,
       gross_profit_amt::DOUBLE AS gross_profit_amt, sum(actual_sales) OVER w::DOUBLE AS ytd_sales,
       sum(gross_profit_amt) OVER w::DOUBLE AS ytd_gp
FROM daily_sales WINDOW w AS (PARTITION BY year(date) ORDER BY date)"""),
    "win_weekly_rank": q("division_daily", WEEKS + """
SELECT year_week, division_code, division_name, s::DOUBLE AS weekly_sales,
       rank() OVER (PARTITION BY year_week ORDER BY s DESC) AS weekly_rank FROM weeks"""),
    "win_rolling_4w": q("division_daily", WEEKS + """
SELECT year_week, division_code, division_name, week_start::VARCHAR AS week_start, s::DOUBLE AS weekly_sales,
       round(sum(s) OVER w::DOUBLE / count(*) OVER w, 0) AS rolling_4w_avg
FROM weeks WINDOW w AS (PARTITION BY division_code ORDER BY year_week ROWS 3 PRECEDING)"""),
    "win_dod": q("daily_sales", """
, l AS (SELECT *, lag(actual_sales) OVER (ORDER BY date) AS p FROM daily_sales)
SELECT date::VARCHAR AS date, day_of_week, actual_sales::DOUBLE AS actual_sales, p::DOUBLE AS prev_day_sales,
       (actual_sales - p)::DOUBLE AS dod_change,
       round((actual_sales - p)::DOUBLE * 100 / nullif(p, 0)::DOUBLE, 2) AS dod_pct_change FROM l"""),
    "win_wow": q("division_daily", WEEKS + """
, l AS (SELECT *, lag(s) OVER (PARTITION BY division_code ORDER BY year_week) AS p FROM weeks)
SELECT year_week, division_code, division_name, s::DOUBLE AS weekly_sales, p::DOUBLE AS prev_week_sales,
       round((s - p)::DOUBLE * 100 / nullif(p, 0)::DOUBLE, 2) AS wow_pct FROM l"""),
    "win_cum_share": q("division_daily", MONTHS + """
, t AS (SELECT year_month, sum(s) AS whole FROM months GROUP BY 1)
SELECT m.year_month, division_code, division_name, s::DOUBLE AS monthly_sales,
       round(s::DOUBLE * 100 / whole::DOUBLE, 2) AS pct_of_month,
       round(sum(s) OVER (PARTITION BY m.year_month ORDER BY s DESC, division_code ROWS UNBOUNDED PRECEDING)::DOUBLE
             * 100 / whole::DOUBLE, 2) AS cumulative_pct
FROM months m JOIN t ON m.year_month = t.year_month"""),
    "win_percentiles": q("division_daily", """
SELECT division_code, division_name, round(min(sales_amt)::DOUBLE, 0) AS p0_min,
       round(round(quantile_cont(sales_amt::DOUBLE, 0.25), 4), 0) AS p25,
       round(round(quantile_cont(sales_amt::DOUBLE, 0.5), 4), 0) AS p50_median,
       round(round(quantile_cont(sales_amt::DOUBLE, 0.75), 4), 0) AS p75,
       round(max(sales_amt)::DOUBLE, 0) AS p100_max
FROM division_daily GROUP BY 1, 2"""),
    "win_rolling_customers": q("daily_sales", """
SELECT date::VARCHAR AS date, num_customers, avg_spend::DOUBLE AS avg_spend,
       round(sum(num_customers) OVER a::DOUBLE / count(*) OVER a, 0) AS rolling_7d_customers,
       round(sum(avg_spend) OVER a::DOUBLE / count(*) OVER a, 2) AS rolling_7d_avg_spend
FROM daily_sales WINDOW a AS (ORDER BY date ROWS 6 PRECEDING)"""),
    "win_gp_rank_in_dept": q("division_daily", """
, g AS (SELECT year(date)::INTEGER AS year, division_code, division_name, department, sum(sales_amt)::DOUBLE AS s,
        sum(gp_ratio)::DOUBLE / count(*) AS r FROM division_daily GROUP BY ALL)
SELECT year, division_code, division_name, department, round(s, 0) AS total_sales, round(r * 100, 2) AS avg_gp_pct,
       rank() OVER (PARTITION BY year, department ORDER BY r DESC) AS gp_rank_in_dept FROM g"""),
    "div_annual_leaderboard": q("division_daily", """
, g AS (SELECT year(date)::INTEGER AS year, division_code, division_name, department, sum(sales_amt) AS s,
        sum(gp_amt) AS p, sum(gp_ratio)::DOUBLE / count(*) AS r FROM division_daily GROUP BY ALL)
SELECT division_code, division_name, department, year, round(s::DOUBLE, 0) AS total_sales,
       round(p::DOUBLE, 0) AS total_gp, round(r * 100, 2) AS avg_gp_pct,
       rank() OVER (PARTITION BY year ORDER BY s DESC) AS revenue_rank,
       rank() OVER (PARTITION BY year ORDER BY r DESC) AS gp_pct_rank FROM g"""),
    "div_mix_shift": q("division_daily", MONTHS + """
SELECT year_month, division_code, division_name, department, s::DOUBLE AS monthly_sales,
       round(s::DOUBLE * 100 / sum(s) OVER (PARTITION BY year_month)::DOUBLE, 2) AS revenue_pct FROM months"""),
    "div_yoy": q("division_daily", f"""
, y AS (SELECT division_code, division_name, department, year(date) AS yr, sum(sales_amt) AS s
        FROM division_daily GROUP BY ALL)
SELECT a.division_code, a.division_name, a.department, a.s::DOUBLE AS sales_first, b.s::DOUBLE AS sales_second,
       round((b.s - a.s)::DOUBLE * 100 / a.s::DOUBLE, 2) AS yoy_pct
FROM y a JOIN y b ON a.division_code = b.division_code AND a.yr = {Y1} AND b.yr = {Y2}"""),
    "div_month_yoy_lag12": q("division_daily", MONTHS + """
, l AS (SELECT *, lag(s, 12) OVER (PARTITION BY division_code ORDER BY year_month) AS p
        FROM months WHERE division_code IN (8, 18))
SELECT year_month, division_code, division_name, s::DOUBLE AS monthly_sales, p::DOUBLE AS same_month_ly,
       round((s - p)::DOUBLE * 100 / nullif(p, 0)::DOUBLE, 2) AS yoy_pct FROM l"""),
    "div_temp_response": q("daily_sales division_daily", """
SELECT CASE WHEN temperature_index < 12 THEN 'Very Cold (<12°C)' WHEN temperature_index < 15 THEN 'Cold (12–15°C)'
            WHEN temperature_index < 20 THEN 'Mild (15–20°C)' ELSE 'Warm (>20°C)' END AS temp_band,
       division_code, division_name, count(DISTINCT date) AS num_days,
       round(sum(sales_amt)::DOUBLE / count(*), 0) AS avg_daily_sales,
       round(max(sales_amt)::DOUBLE, 0) AS peak_daily_sales
FROM division_daily JOIN daily_sales USING (date) WHERE division_code IN (21, 11) GROUP BY 1, 2, 3"""),
    "div_share_of_store": q("division_daily", """
, store AS (SELECT strftime(date, '%Y-%m') AS ym, sum(sales_amt) AS whole FROM division_daily GROUP BY 1)
SELECT ym AS year_month, round(sum(sales_amt)::DOUBLE, 0) AS monthly_sales,
       round(sum(gp_ratio)::DOUBLE / count(*) * 100, 2) AS avg_gp_pct,
       round(sum(gp_amt)::DOUBLE, 0) AS monthly_gp,
       round(sum(sales_amt)::DOUBLE * 100 / any_value(whole)::DOUBLE, 2) AS pct_of_store_monthly
FROM division_daily JOIN store ON strftime(date, '%Y-%m') = ym WHERE division_code = 9 GROUP BY 1"""),
    "dept_monthly_share": q("division_daily", """
SELECT strftime(date, '%Y-%m') AS year_month, department, round(sum(sales_amt)::DOUBLE, 0) AS dept_sales,
       round(sum(gp_ratio)::DOUBLE / count(*) * 100, 2) AS avg_gp_pct,
       round(sum(sales_amt)::DOUBLE * 100
             / (sum(sum(sales_amt)) OVER (PARTITION BY strftime(date, '%Y-%m')))::DOUBLE, 2) AS dept_pct
FROM division_daily GROUP BY 1, 2"""),
    "top_skus": q("products transaction_items", """
SELECT p.sku_id, product_name, division_name, department, price_tier, p.unit_price::DOUBLE AS unit_price,
       count(*) AS num_transactions, sum(quantity)::BIGINT AS units_sold,
       round(sum(discounted_price * quantity)::DOUBLE, 0) AS total_revenue,
       round(sum(gross_profit_amt)::DOUBLE, 0) AS total_gp
FROM transaction_items t JOIN products p USING (sku_id)
GROUP BY ALL ORDER BY sum(discounted_price * quantity) DESC, sku_id LIMIT 30"""),
}
