"""Check statements of the report-page queries."""

from oracle.features import FEATURES, JOINED
from oracle.forecast import BIAS, DAYS, KNOWN_BIAS, LOG, LOOKUP
from oracle.tables import statement as q

Y1, Y2 = 1999, 2000
TABLES = "daily_sales dense_days"
CONTEXT = ["lag_7", "lag_14", "lag_28", "rolling_7_mean", "rolling_14_mean"]


def avg_of(value: str, where: str = "TRUE") -> str:
    return f"(sum({value}) FILTER ({where}))::DOUBLE / nullif(count({value}) FILTER ({where}), 0)"


SCENARIO = FEATURES + ", exact AS (SELECT division_code, month, " + ", ".join(
    f"CAST(round({c}::DOUBLE, 4) AS DECIMAL(18,4)) AS {c}" for c in CONTEXT
) + """ FROM features),
per_month AS (SELECT division_code, month, count(*) AS num_rows, """ + ", ".join(
    f"{avg_of(c)} AS m_{c}" for c in CONTEXT) + """ FROM exact GROUP BY 1, 2),
whole AS (SELECT division_code, unnest(range(1, 13))::INTEGER AS month, """ + ", ".join(
    f"a_{c}" for c in CONTEXT) + " FROM (SELECT division_code, " + ", ".join(
    f"{avg_of(c)} AS a_{c}" for c in CONTEXT) + """ FROM exact GROUP BY 1)),
context AS (SELECT division_code, month, coalesce(num_rows, 0) AS num_rows, """ + ", ".join(
    f"CASE WHEN num_rows >= 4 THEN m_{c} ELSE a_{c} END AS {c}" for c in CONTEXT
) + " FROM whole LEFT JOIN per_month USING (division_code, month))"
GRID = """
SELECT c.division_code, c.month, d.day_of_week, e.event_flag,
       [26, 26, 24, 20, 16, 13, 12, 14, 16, 19, 22, 25][c.month]::INTEGER AS temperature_index,
       CASE d.day_of_week WHEN 'Thursday' THEN 12 WHEN 'Sunday' THEN 7 ELSE 9 END AS trading_hours,
       0 AS is_public_holiday, 0 AS promo_flag, d.dow_num,
       [15, 46, 74, 105, 135, 166, 196, 227, 258, 288, 319, 349][c.month]::INTEGER AS day_of_year,
       (e.event_flag = 'Arigato')::INTEGER AS "event_Arigato", (e.event_flag = 'Christmas')::INTEGER AS "event_Christmas",
       (e.event_flag = 'EOFY')::INTEGER AS "event_EOFY", (e.event_flag = 'Vivid')::INTEGER AS "event_Vivid",
       (e.event_flag = 'LongWeekend')::INTEGER AS "event_LongWeekend",
       lag_7, lag_14, lag_28, rolling_7_mean, rolling_14_mean
FROM context c
CROSS JOIN (SELECT unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']) AS day_of_week,
                   unnest(range(0, 7))::INTEGER AS dow_num) d
CROSS JOIN (SELECT unnest(['None', 'Arigato', 'Christmas', 'EOFY', 'Vivid', 'LongWeekend']) AS event_flag) e"""
BY_SIZE = "ORDER BY abs(latest_rolling_bias_pct) DESC, division_code, day_of_week"
DAILY = """date::VARCHAR AS date, day_of_week, trading_hours, is_public_holiday, event_flag,
  temperature_index::DOUBLE AS temperature_index, target::DOUBLE AS target, actual_sales::DOUBLE AS actual_sales,
  achievement_pct::DOUBLE AS achievement_pct, num_customers, avg_spend::DOUBLE AS avg_spend, avg_qty::DOUBLE AS avg_qty,
  avg_unit_price::DOUBLE AS avg_unit_price, gross_profit_amt::DOUBLE AS gross_profit_amt,
  gross_profit_ratio::DOUBLE AS gross_profit_ratio, yoy_pct::DOUBLE AS yoy_pct, promo_flag"""

SQL = {
    "dash_filter_range": q("daily_sales", f"""
SELECT {DAILY} FROM daily_sales WHERE daily_sales.date >= (SELECT max(date) FROM daily_sales) - 90"""),
    "dash_store_kpis": q("daily_sales", f"""
, k AS (SELECT sum(actual_sales) AS t, sum(actual_sales) FILTER (year(date) = {Y1}) AS s1,
  sum(actual_sales) FILTER (year(date) = {Y2}) AS s2,
  {avg_of('gross_profit_ratio', f'year(date) = {Y1}')} AS g1, {avg_of('gross_profit_ratio', f'year(date) = {Y2}')} AS g2,
  {avg_of('num_customers', f'year(date) = {Y1}')} AS c1, {avg_of('num_customers', f'year(date) = {Y2}')} AS c2,
  {avg_of('yoy_pct', f'year(date) = {Y2}')} AS y FROM daily_sales)
SELECT t::DOUBLE AS total_sales, s1::DOUBLE AS sales_first, s2::DOUBLE AS sales_second,
       round((s2 - s1)::DOUBLE * 100 / s1::DOUBLE, 2) AS yoy_pct_change, round(g2 * 100, 2) AS avg_gp_pct,
       round((g2 - g1) * 100, 4) AS gp_delta_points, round(c2, 0) AS avg_customers,
       round((c2 - c1) * 100 / c1, 2) AS customers_delta_pct, round(y * 100, 2) AS avg_daily_yoy_pct FROM k"""),
    "dash_trend": q("daily_sales", """
, f AS (SELECT * FROM daily_sales WHERE date >= (SELECT max(date) FROM daily_sales) - 90)
SELECT date::VARCHAR AS date, actual_sales::DOUBLE AS actual_sales, target::DOUBLE AS target,
       sum(actual_sales) OVER w::DOUBLE / count(*) OVER w AS rolling_7d
FROM f WINDOW w AS (ORDER BY f.date ROWS 6 PRECEDING)"""),
    "dash_dow_average": q("daily_sales", """
SELECT day_of_week, sum(actual_sales)::DOUBLE / count(*) AS avg_sales FROM daily_sales GROUP BY 1"""),
    "dash_division_monthly": q("division_daily", """
SELECT division_code, division_name, department, strftime(date, '%Y-%m') AS month,
       sum(sales_amt)::DOUBLE / count(*) AS avg_daily FROM division_daily GROUP BY 1, 2, 3, 4"""),
    "dash_division_totals": q("division_daily", """
SELECT division_code, sum(sales_amt)::DOUBLE AS total_sales FROM division_daily GROUP BY 1"""),
    "dash_dept_rank": q("division_daily", """
, t AS (SELECT department, division_code, division_name, sum(sales_amt) AS s FROM division_daily GROUP BY 1, 2, 3)
SELECT department, division_code, division_name, s::DOUBLE AS total_sales,
       list_position(['Women', 'Men', 'Kids', 'Others'], department)::BIGINT AS department_order,
       row_number() OVER (PARTITION BY department ORDER BY s DESC, division_code) AS position FROM t"""),
    "dash_minmax_series": q("division_daily", """
, m AS (SELECT division_code, strftime(date, '%Y-%m') AS month, sum(sales_amt)::DOUBLE / count(*) AS v
        FROM division_daily GROUP BY 1, 2)
SELECT division_code, month, round((v - min(v) OVER w) / coalesce(nullif(max(v) OVER w - min(v) OVER w, 0), 1), 6) AS scaled
FROM m WINDOW w AS (PARTITION BY division_code)"""),
    "dash_scenario_context": q(TABLES, SCENARIO + "\nSELECT * FROM context"),
    "dash_scenario_rows": q(TABLES, SCENARIO + GRID),
    "dash_scenario_vs_history": q(TABLES, SCENARIO + """
, model AS (SELECT division_code, day_of_week, CAST(round(sum(sales_amt)::DOUBLE / count(*), 2) AS DECIMAL(18,2)) AS p
            FROM joined GROUP BY 1, 2),
hist AS (SELECT division_code, month(date) AS month, day_of_week, sum(sales_amt)::DOUBLE / count(*) AS h
         FROM joined GROUP BY 1, 2, 3)
SELECT c.division_code, c.month, m.day_of_week, e.event_flag, p::DOUBLE AS predicted, h AS hist_avg,
       round((p::DOUBLE - h) * 100 / nullif(h, 0), 2) AS vs_hist_pct
FROM context c JOIN model m USING (division_code)
CROSS JOIN (SELECT unnest(['None', 'Arigato', 'Christmas', 'EOFY', 'Vivid', 'LongWeekend']) AS event_flag) e
LEFT JOIN hist ON hist.division_code = c.division_code AND hist.month = c.month AND hist.day_of_week = m.day_of_week"""),
    "dash_month_bars": q(TABLES, JOINED + """
, own AS (SELECT * FROM joined WHERE division_code = 14)
SELECT date_trunc('month', date)::DATE::VARCHAR AS month, sum(sales_amt)::DOUBLE / count(*) AS avg_daily_sales
FROM own WHERE date >= (SELECT max(date) FROM own) - 365 GROUP BY 1"""),
    "dash_mape_heatmap": q(TABLES, LOOKUP + "\nSELECT event_flag, " + ", ".join(
        f"max(mean_mape) FILTER (day_of_week = '{d}') AS \"{d}\"" for d in DAYS) + " FROM lookup GROUP BY 1"),
    "dash_ci_series": q(TABLES, LOG + """
, known AS (SELECT * FROM log WHERE actual_sales IS NOT NULL)
SELECT target_date::VARCHAR AS target_date, sum(actual_sales)::DOUBLE AS actual, sum(predicted_sales)::DOUBLE AS predicted,
       sum(lower_bound)::DOUBLE AS lower, sum(upper_bound)::DOUBLE AS upper
FROM known WHERE known.target_date >= (SELECT max(target_date) FROM known) - 90 GROUP BY known.target_date"""),
    "dash_top_flags": q(TABLES, BIAS + """
SELECT * EXCLUDE (latest), printf('Heads up: %d consecutive weeks %s %s sales in %s by ~%.1f%%.',
  consecutive_flagged_periods, direction, day_of_week, division_name, round(abs(latest), 1)) AS alert
FROM flags """ + BY_SIZE + " LIMIT 6"),
    "dash_flag_kpis": q(TABLES, BIAS + f"""
SELECT count(*) AS num_flags, count(*) FILTER (direction = 'underestimating') AS num_under,
       count(*) FILTER (direction = 'overestimating') AS num_over, max(abs(latest_rolling_bias_pct)) AS worst_bias_pct,
       (SELECT division_name FROM flags {BY_SIZE} LIMIT 1) AS worst_bias_division,
       max(consecutive_flagged_periods) AS longest_streak,
       (SELECT division_name FROM flags ORDER BY consecutive_flagged_periods DESC, division_code, day_of_week LIMIT 1)
         AS longest_streak_division
FROM flags"""),
    "dash_division_list": q(TABLES, LOG + "\nSELECT DISTINCT division_code, division_name FROM log"),
    "dash_bias_by_division": q(TABLES, KNOWN_BIAS + """
, own AS (SELECT * FROM known_bias WHERE division_code = 14 AND b IS NOT NULL)
SELECT target_date::VARCHAR AS target_date, division_code, day_of_week, se::DOUBLE AS signed_error_pct, b AS rolling_6w_bias
FROM own WHERE own.target_date >= (SELECT max(target_date) FROM own) - 365"""),
    "dash_bias_table": q(TABLES, BIAS + """
SELECT division_name AS "Division", day_of_week AS "Day", consecutive_flagged_periods AS "Consecutive Weeks Flagged",
       latest_rolling_bias_pct AS "Latest Bias %", direction AS "Direction" FROM flags"""),
}
